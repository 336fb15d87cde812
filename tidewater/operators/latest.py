"""Latest row per key (W1), ordered de-duplication (U3) and idempotent
delivery de-duplication (U4).

The pick is expressed as ``max(struct(order..., tie..., rest...))`` grouped by
the key. That is an ordinary aggregate, so Spark combines map-side before the
shuffle: a key holding a third of all rows costs one partial row per input
partition, never a group sorted in one task. Struct ordering puts NULL first,
so ``max`` equals ``ORDER BY ... DESC NULLS LAST`` with a full tie-break on the
remaining columns (deterministic, unlike ``dropDuplicates``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def latest_per_key(
    df: DataFrame,
    keys: str | list[str],
    order_cols: str | list[str],
    tie_breakers: str | list[str] | None = None,
    earliest: bool = False,
) -> DataFrame:
    """One row per key: the greatest (order_cols, tie_breakers, rest) tuple.

    ``earliest=True`` picks the smallest tuple instead.
    """
    keys, order_cols, ties = _as_list(keys), _as_list(order_cols), _as_list(tie_breakers)
    ranked = order_cols + [c for c in ties if c not in order_cols]
    rest = [c for c in df.columns if c not in keys and c not in ranked]
    fields = ranked + rest
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    pick = F.min(packed) if earliest else F.max(packed)
    agg = df.groupBy(*keys).agg(pick.alias("_pick"))
    out = agg.select(*keys, *[F.col(f"_pick.f{i}").alias(c) for i, c in enumerate(fields)])
    return out.select(*df.columns)


def dedupe_ordered(df: DataFrame, keys: str | list[str], order_cols=None) -> DataFrame:
    """Drop duplicates on ``keys`` keeping a deterministic row.

    Without ``order_cols`` the survivor is the row greatest over all other
    columns, so exact re-runs always keep the same row.
    """
    keys = _as_list(keys)
    order_cols = _as_list(order_cols) or [c for c in df.columns if c not in keys]
    return latest_per_key(df, keys, order_cols)
