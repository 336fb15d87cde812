"""Registered queries over the driver's tables and their DuckDB oracle SQL.

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables. Every
computed column carries the same alias as in the oracle SQL. Money is summed
as DECIMAL (exact in both engines); timestamps leave as TIMESTAMP_NTZ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a table. Filters and projections reach the scan; how many splits it
    has is up to ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Tables:
    """Lazy table loader bound to one directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return load(self.spark, self.sf_dir, name)


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, t: Tables)`` as ``queries()[name]``."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, Tables(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return wrap


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_modules()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load_modules()
    return dict(ORACLE)


def _load_modules() -> None:
    from tidewater.plans import (  # noqa: F401
        q_governance,
        q_io,
        q_quality,
        q_telemetry,
        q_warehouse,
    )
