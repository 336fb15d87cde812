"""Keyed upsert (J6), CDC apply (S16) and partition-scoped table upsert.

Plain Parquet has no MERGE, so an upsert is ``target LEFT ANTI source-keys``
plus ``source``; keys compare null-safe (marts carry NULL keys). A duplicate
key in the source makes the result ambiguous and raises.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.latest import latest_per_key
from tidewater.session import stage


class DuplicateKeyError(ValueError):
    pass


def _key_condition(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool):
    parts = [
        left[k].eqNullSafe(right[k]) if null_safe else (left[k] == right[k]) for k in keys
    ]
    return reduce(lambda a, b: a & b, parts)


def _unmatched(target: DataFrame, source: DataFrame, keys: list[str], null_safe: bool) -> DataFrame:
    t, s = target.alias("_t"), source.select(*keys).alias("_s")
    return t.join(s, _key_condition(t, s, keys, null_safe), "left_anti")


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate key in upsert source: {dup[0].asDict()}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    null_safe: bool = True,
    check_unique: bool = True,
) -> DataFrame:
    """Matched keys take the source row, unmatched source rows are inserted.

    A source that is the outcome of a long plan should be staged by the caller:
    it is read for the check, the anti join and the union, and a staged table's
    size tells Spark whether to broadcast its keys."""
    if check_unique:
        assert_unique(source, keys)
    return _unmatched(target, source, keys, null_safe).unionByName(source, allowMissingColumns=True)


def cdc_apply(
    target: DataFrame,
    changes: DataFrame,
    keys: list[str],
    op_col: str = "op",
    ts_col: str = "change_ts",
    delete_ops: tuple[str, ...] = ("D",),
    tie_breakers: list[str] | None = None,
) -> DataFrame:
    """Apply a change feed ``(op, key..., ts, payload...)``.

    The latest change per key wins; deletes remove the key, inserts and
    updates replace or add the row. Payload columns are the target's columns.
    """
    latest = stage(latest_per_key(changes, keys, [ts_col], tie_breakers), "cdc-latest")
    t = target.alias("_t")
    touched = latest.select(*keys).alias("_c")
    kept = t.join(touched, _key_condition(t, touched, keys, True), "left_anti")
    upserts = latest.where(~F.col(op_col).isin(*delete_ops)).select(*target.columns)
    return kept.unionByName(upserts)


def upsert_partitioned_table(
    spark,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition_col: str,
    staging_path: str,
) -> None:
    """Upsert ``source`` into a Parquet table partitioned by ``partition_col``.

    Only partitions the source touches are read and rewritten: the source is
    staged once, its distinct partition values (no more than the table has
    partitions) become literals of the target's scan. The target rows that stay
    are staged first (the target path is being overwritten, so its lineage must
    be cut), then written with the staged source by dynamic partition overwrite.
    """
    target = spark.read.parquet(path)
    source = stage(source, "upsert-source")
    touched = [r[0] for r in source.select(partition_col).distinct().collect()]
    known = [v for v in touched if v is not None]
    here = F.col(partition_col).isin(known) if known else F.lit(False)
    affected = target.where(here | F.col(partition_col).isNull() if None in touched else here)
    assert_unique(source, keys)
    _unmatched(affected, source, keys, True).write.mode("overwrite").parquet(staging_path)
    (
        spark.read.schema(target.schema).parquet(staging_path)
        .unionByName(source, allowMissingColumns=True)
        .hint("rebalance", partition_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )
