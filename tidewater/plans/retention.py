"""Retention of a table partitioned by day or month.

Partitions are told from their directory names: those wholly behind the edge are
deleted unread, those wholly before it are not touched, and only the one that the
edge cuts is read and rewritten. Rows without a time lie in the default partition
and are kept, dropped or moved to another table, as asked.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import delete, list_dirs, scratch_path

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
PERIODS = {"day": lambda d: d + dt.timedelta(days=1),
           "month": lambda d: (d.replace(day=1) + dt.timedelta(days=32)).replace(day=1)}
REPORT = "partition string, action string"


def plan_retention(names: list[str], partition_col: str, edge: dt.datetime, period: str, nulls: str) -> list[tuple[str, str]]:
    """(directory, action) of every partition: ``drop``, ``cut``, ``keep`` or
    ``route``. A directory that is no partition of the column raises."""
    if period not in PERIODS:
        raise ValueError(f"a partition is a day or a month, not {period!r}")
    if nulls not in ("keep", "drop", "route"):
        raise ValueError(f"nulls are kept, dropped or routed, not {nulls!r}")
    out = []
    for name in names:
        if name.startswith(("_", ".")):
            continue
        column, _, value = name.partition("=")
        if column != partition_col:
            raise ValueError(f"{name!r} is no partition by {partition_col}")
        if value == DEFAULT_PARTITION:
            out.append((name, nulls))
            continue
        start = dt.date.fromisoformat(value)
        first = dt.datetime.combine(start, dt.time())
        after = dt.datetime.combine(PERIODS[period](start), dt.time())
        out.append((name, "drop" if after <= edge else "keep" if first >= edge else "cut"))
    return out


def rows_to_keep(spark: SparkSession, directory: str, ts_col: str, edge: dt.datetime) -> DataFrame:
    """What stays of the partition that the edge cuts; reads this directory only."""
    return spark.read.parquet(directory).where((F.col(ts_col) >= F.lit(edge).cast("timestamp_ntz")) | F.col(ts_col).isNull())


def retain_table(spark: SparkSession, path: str, partition_col: str, ts_col: str, retention_days: int, as_of: dt.datetime,
                 period: str = "day", nulls: str = "keep", route_path: str | None = None) -> DataFrame:
    """Trim the Parquet table at ``path`` to rows of the last ``retention_days``
    before ``as_of``; returns ``partition, action``. The partition column must be
    the day (or first of the month) of ``ts_col``. With ``nulls="route"`` rows
    without a time move to ``route_path``. A repeated run changes nothing more: the
    cut partition is staged before it is replaced."""
    path, edge = path.rstrip("/"), as_of - dt.timedelta(days=int(retention_days))
    if nulls == "route" and not route_path:
        raise ValueError("routing needs a route_path")
    actions = plan_retention(list_dirs(spark, path), partition_col, edge, period, nulls)
    for name, action in actions:
        where = f"{path}/{name}"
        if action == "cut":
            staged = scratch_path(spark, "retain")
            rows_to_keep(spark, where, ts_col, edge).write.parquet(staged)
            spark.read.parquet(staged).write.mode("overwrite").parquet(where)
        elif action == "route":
            spark.read.parquet(where).write.mode("overwrite").parquet(f"{route_path.rstrip('/')}/{as_of:%Y%m%dT%H%M%S}")
            delete(spark, where)
        elif action == "drop":
            delete(spark, where)
    return spark.createDataFrame([(n.partition("=")[2], a) for n, a in actions], REPORT)
