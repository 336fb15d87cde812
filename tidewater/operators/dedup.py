"""Duplicate finders (A5) and union helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def find_duplicates(df: DataFrame, keys: list[str], count_col: str = "n") -> DataFrame:
    """Key groups that occur more than once, with their multiplicity."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def union_by_name(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)
