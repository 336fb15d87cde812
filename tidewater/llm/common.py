"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch. Texts may be long, so a batch holds few of them.
ARROW_ROWS = 500
#: Bytes of one Arrow batch, so that long texts do not add up in a worker.
ARROW_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id's decimal text modulo ``buckets``; a null id counts as
    the empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return (F.crc32(text) % buckets).cast("int")


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with batches of at most ``ARROW_ROWS`` rows, and of about
    ``ARROW_BYTES`` or one row. The settings are read when the job is planned,
    so they stay set on the session."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > ARROW_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.mapInArrow(fn, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The batch's texts; a null is the empty text."""
    return [x or "" for x in batch.column(name).to_pylist()]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once. A plain column alias may be
    put back in place of its name by the optimizer, also inside a lambda, where
    it would be computed for each element; a lambda's variable is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


class BoundedCache(dict):
    """``cache[key]`` is ``make(key)``, remembered. It keeps two generations of
    at most ``limit`` entries: when the young one is full it becomes the old one,
    whose entries come back when asked for, so frequent keys stay and memory is
    bounded. No result depends on what was asked before. Long keys are not
    kept."""

    def __init__(self, make: Callable, limit: int = 250_000, max_key: int = 64):
        super().__init__()
        self.make, self.limit, self.max_key, self.old = make, limit, max_key, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(key) <= self.max_key:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
