"""Point-in-time (as-of interval) join to a versioned dimension.

``fact.key = dim.key AND dim.valid_from <= fact.ts < coalesce(dim.valid_to,
9999-12-31)``. Spark plans the equality as the join key (hash/sort-merge or a
broadcast when AQE sees a small side) and the interval as a residual filter.

Hot keys: AQE's skew-join split handles a large key on the fact side; the
explicit ``salt_buckets`` variant spreads each key over N buckets (fact rows
pick a bucket by row hash, dimension versions are replicated N times — a
dimension key has few versions, so the copy is small) and gives identical
rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.time import OPEN_END


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    fact_ts: str,
    dim_key: str,
    take: dict[str, str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "left",
    salt_buckets: int = 1,
) -> DataFrame:
    """Attach ``take`` (dim column -> output name) as of ``fact_ts``.

    Spark broadcasts a dimension whose bytes are under its threshold (they are
    known for staged tables): the fact is then never shuffled, so a hot key
    costs nothing extra. Otherwise a shuffle join on the key (AQE splits
    skewed partitions; ``salt_buckets`` spreads hot keys explicitly).
    """
    d = dim.select(
        F.col(dim_key).alias("_pit_key"),
        F.col(valid_from).alias("_pit_from"),
        F.coalesce(F.col(valid_to), F.lit(OPEN_END).cast(dim.schema[valid_from].dataType)).alias(
            "_pit_to"
        ),
        *[F.col(src).alias(dst) for src, dst in take.items()],
    )
    f = fact
    cond = (
        (F.col(fact_key) == F.col("_pit_key"))
        & (F.col(fact_ts) >= F.col("_pit_from"))
        & (F.col(fact_ts) < F.col("_pit_to"))
    )
    if salt_buckets > 1:
        f = f.withColumn(
            "_pit_salt", F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(salt_buckets))
        )
        d = d.withColumn("_pit_dsalt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        cond = cond & (F.col("_pit_salt") == F.col("_pit_dsalt"))
    return f.join(d, cond, how).select(*fact.columns, *take.values())
