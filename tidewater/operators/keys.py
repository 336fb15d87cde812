"""Stable surrogate keys (C2) without a global window.

Rows are range-partitioned and sorted by the business order, tagged with
their partition id and position, and staged as Parquet in the shared
checkpoint folder (so the numbering is replay-safe after an executor loss),
then numbered as ``start + rows in earlier partitions + position in own
partition``. The only values brought to the driver are one count per
partition.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.session import stage


def assign_surrogate_keys(
    df: DataFrame,
    order_cols: list[str],
    sk_col: str,
    start: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    others = [c for c in df.columns if c != sk_col]
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = stage(
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_sk_pid", F.spark_partition_id())
        .withColumn("_sk_mid", F.monotonically_increasing_id()),
        "surrogate-keys",
    )
    counts = {r["_sk_pid"]: r["count"] for r in staged.groupBy("_sk_pid").count().collect()}
    pids = sorted(counts)
    before = [0] + list(accumulate(counts[p] for p in pids))[:-1]
    # one row per partition
    offsets = F.broadcast(spark.createDataFrame(list(zip(pids, before)), "_sk_pid int, _sk_before long"))
    local_pos = F.col("_sk_mid") - F.shiftleft(F.col("_sk_pid").cast("long"), 33)
    sk = (F.lit(start).cast("long") + F.col("_sk_before") + local_pos + 1).alias(sk_col)
    return staged.join(offsets, "_sk_pid").select(sk, *others)


def max_key(df: DataFrame, sk_col: str) -> int:
    """Current maximum key (0 for an empty table) — a one-row aggregate."""
    row = df.agg(F.max(sk_col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0
