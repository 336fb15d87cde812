"""Projection of nested records.

``explode`` turns one record with an array into one row per element;
empty/NULL arrays vanish (``outer=True`` keeps them as one NULL row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_array(
    df: DataFrame,
    array_col: str,
    keep: list[str],
    fields: dict[str, str],
    outer: bool = False,
) -> DataFrame:
    """``keep`` parent columns plus ``fields`` (element field -> output name)."""
    gen = F.explode_outer if outer else F.explode
    exploded = df.select(*keep, gen(array_col).alias("_elem"))
    return exploded.select(*keep, *[F.col(f"_elem.{f}").alias(o) for f, o in fields.items()])
