"""Regex helpers with whole-string semantics.

Java's ``$`` also matches before a trailing newline, so a "full match" is
spelled ``\\A(?:p)\\z``. ``\\d``/``\\s`` are ASCII classes in Java's default
mode, which is what we define (it also agrees with RE2).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def full_match_pattern(pattern: str) -> str:
    return r"\A(?:" + pattern + r")\z"


def full_match(col: Column | str, pattern: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(full_match_pattern(pattern))


def search(col: Column | str, pattern: str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike(pattern)
