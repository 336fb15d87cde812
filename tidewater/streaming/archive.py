"""The cold path: rows by event date and hour, with their source coordinates, a
digest of every window and the offsets received (S12, S17, T5).

Each micro-batch writes three slices, all of them named by its batch id, so a
repeated batch replaces its own:

    {path}/rows/event_date=/event_hour=/batch=     the rows
    {path}/digests/event_date=/batch=              per window: events and digest
    {path}/ranges/batch=                           per topic and partition: runs of offsets

A reader of a date and hour opens these directories alone, and what changed
since a table was built is told by the digests, without reading rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.plans.kpi_state import event_digest
from tidewater.plans.telemetry import NO_GEOFENCE
from tidewater.session import read_if_there

SOURCE = ["topic", "partition"]
#: Offsets of one window when runs are sought, so that no topic partition is one task.
OFFSET_BLOCK = 1 << 16


class Archive:
    """``foreachBatch`` sink and reader. ``to_telemetry`` maps rows to telemetry
    (for the digests); rows with ``topic, partition, offset`` are audited."""

    def __init__(self, spark: SparkSession, path: str, to_telemetry, ts_col: str = "event_ts"):
        self.spark, self.path, self.to_telemetry, self.ts_col = spark, path.rstrip("/"), to_telemetry, ts_col

    # -- writing --------------------------------------------------------------
    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        t = F.col(self.ts_col).cast("timestamp")
        rows = (batch.withColumn("event_date", F.to_date(t)).withColumn("event_hour", F.hour(t))
                .withColumn("batch", F.lit(batch_id))).persist()
        try:
            self._write(rows, "rows", "event_date", "event_hour", "batch")
            self._write(window_digests(self.to_telemetry(rows)).withColumn("batch", F.lit(batch_id)), "digests", "event_date", "batch")
            if {*SOURCE, "offset"} <= set(rows.columns):
                offset_runs(rows).write.mode("overwrite").parquet(f"{self.path}/ranges/batch={batch_id}")
        finally:
            rows.unpersist()

    def _write(self, df: DataFrame, name: str, *parts: str) -> None:
        (df.hint("rebalance", *parts).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*parts).parquet(f"{self.path}/{name}"))

    # -- reading --------------------------------------------------------------
    def rows(self, dates: list | None = None, hours: list[int] | None = None) -> DataFrame:
        """Archived rows, of the given dates and hours only: only these dates'
        directories are listed, and both are literals on partition columns."""
        root = f"{self.path}/rows"
        if dates is None:
            out = self.spark.read.parquet(root)
        else:
            out = self.spark.read.option("basePath", root).parquet(*[f"{root}/event_date={d}" for d in dates])
            out = out.where(F.col("event_date").isin([F.lit(d).cast("date") for d in dates]))
        if hours is not None:
            out = out.where(F.col("event_hour").isin([int(h) for h in hours]))
        return out.drop("batch")

    def digests(self) -> DataFrame:
        """``event_date, event_hour, window_start, geofence_id, events, digest``
        over all batches."""
        keys = ["event_date", "event_hour", "window_start", "geofence_id"]
        return (self.spark.read.parquet(f"{self.path}/digests").groupBy(*keys)
                .agg(F.sum("events").alias("events"), F.sum("digest").alias("digest")))

    def ranges(self) -> DataFrame:
        """The runs of offsets of every batch."""
        found = read_if_there(self.spark, f"{self.path}/ranges")
        return self.spark.createDataFrame([], RUNS) if found is None else found.drop("batch")


def window_digests(telemetry: DataFrame, width: str = "1 minute", ts_col: str = "event_ts") -> DataFrame:
    """Events and digest of each window, and the archive partition it lies in (a
    window must not span two hours)."""
    start = F.col("_w.start")
    out = (telemetry.withColumn("geofence_id", F.coalesce(F.col("geofence_id"), F.lit(NO_GEOFENCE)))
           .groupBy(F.window(ts_col, width).alias("_w"), "geofence_id")
           .agg(F.count(F.lit(1)).alias("events"), F.sum(event_digest()).alias("digest")))
    at = start.cast("timestamp")
    return out.select(F.to_date(at).alias("event_date"), F.hour(at).alias("event_hour"), start.alias("window_start"), "geofence_id",
                      "events", "digest")


# --------------------------------------------------------------------------
# Offset intervals
# --------------------------------------------------------------------------

RUNS = "topic string, partition int, start long, end long, copies long"


def offset_runs(records: DataFrame) -> DataFrame:
    """``topic, partition, start, end, copies``: maximal runs of consecutive
    offsets inside blocks of ``OFFSET_BLOCK``; ``copies`` counts records beyond
    the first of an offset."""
    once = records.groupBy(*SOURCE, "offset").agg((F.count(F.lit(1)) - 1).alias("again"))
    block = F.floor(F.col("offset") / OFFSET_BLOCK)
    place = F.row_number().over(Window.partitionBy(*SOURCE, "_block").orderBy("offset"))
    runs = once.withColumn("_block", block).withColumn("_run", F.col("offset") - place)
    return (runs.groupBy(*SOURCE, "_block", "_run").agg(F.min("offset").alias("start"), F.max("offset").alias("end"),
                                                      F.sum("again").alias("copies"))
            .select(*SOURCE, "start", "end", "copies"))


def _with_reach(ranges: DataFrame) -> DataFrame:
    """Each range with the furthest end of those before it."""
    before = Window.partitionBy(*SOURCE).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumn("_reach", F.max("end").over(before))


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """Touching and overlapping ranges become one: what was received at all."""
    starts = _with_reach(ranges).withColumn("_new", (F.col("_reach").isNull() | (F.col("start") > F.col("_reach") + 1)).cast("int"))
    so_far = Window.partitionBy(*SOURCE).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    return (starts.withColumn("_group", F.sum("_new").over(so_far)).groupBy(*SOURCE, "_group")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("copies").alias("copies"))
            .select(*SOURCE, "start", "end", "copies"))


def gaps(ranges: DataFrame, first: Column | None = None) -> DataFrame:
    """``topic, partition, gap_start, gap_end, missing``: offsets between the
    first and the last received that never came. ``first``, an expression, is the
    offset from which all were expected."""
    reach = F.col("_reach") if first is None else F.coalesce(F.col("_reach"), first - 1)
    holes = _with_reach(ranges).withColumn("_reach", reach).where(F.col("start") > F.col("_reach") + 1)
    return holes.select(*SOURCE, (F.col("_reach") + 1).alias("gap_start"), (F.col("start") - 1).alias("gap_end"),
                        (F.col("start") - F.col("_reach") - 1).alias("missing"))


def overlaps(ranges: DataFrame) -> DataFrame:
    """``topic, partition, start, end``: offsets that more than one range holds
    (a batch that came twice), merged."""
    twice = _with_reach(ranges).where(F.col("start") <= F.col("_reach"))
    return merge_ranges(twice.withColumn("end", F.least("end", "_reach")).drop("_reach")).drop("copies")
