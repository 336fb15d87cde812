"""Streaming wrappers around the batch operators.

Sources: any streaming DataFrame works; for replay and tests we stage events
as Parquet files and read them with the file source (``maxFilesPerTrigger``
is the back-pressure cap, like ``maxOffsetsPerTrigger`` for Kafka). The Kafka
source is used when its connector is on the classpath.

Event time: watermarks refuse TIMESTAMP_NTZ, so ``event_ts`` is cast to a
session-zone (UTC) timestamp before ``withWatermark`` and outputs are cast
back to TIMESTAMP_NTZ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidewater.operators.latest import dedupe_ordered
from tidewater.plans import kpi_state as ks
from tidewater.plans import telemetry as tm
from tidewater.session import delete, read_if_there
from tidewater.sources import wire
from tidewater.streaming.seen import SeenKeys
from tidewater.streaming.versioned import VersionedTable

WATERMARK = "30 seconds"


# --------------------------------------------------------------------------
# Sources
# --------------------------------------------------------------------------


def stage_files(df: DataFrame, path: str, num_files: int, order_col: str | None = None) -> str:
    """Write ``df`` as ``num_files`` Parquet files (time-ordered if asked)."""
    out = df.repartitionByRange(num_files, order_col) if order_col else df.repartition(num_files)
    out.write.mode("overwrite").parquet(path)
    return path


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_offsets_per_trigger: int = 500_000, fail_on_data_loss: bool = True) -> DataFrame:
    """Kafka source (needs the spark-sql-kafka connector)."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .load()
    )


def with_event_time(telemetry: DataFrame, delay: str = WATERMARK) -> DataFrame:
    return telemetry.withColumn("event_ts", F.col("event_ts").cast("timestamp")).withWatermark(
        "event_ts", delay
    )


def run_available_now(writer):
    """Process everything available, then stop (batch replay / tests)."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


class DroppedRows(StreamingQueryListener):
    """Late rows that stateful operators discarded, summed over every
    progress report while the listener is on (a query itself keeps only its last
    reports). ``by_query`` has the sums by the run's id. Counted after partial
    aggregation, as Spark reports."""

    def __init__(self):
        super().__init__()
        self.by_query: dict[str, int] = {}

    def onQueryStarted(self, event):
        self.by_query.setdefault(str(event.runId), 0)

    def onQueryProgress(self, event):
        run = str(event.progress.runId)
        dropped = sum(int(op.numRowsDroppedByWatermark or 0) for op in event.progress.stateOperators)
        self.by_query[run] = self.by_query.get(run, 0) + dropped

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def rows_dropped_by_watermark(query) -> int:
    """The same from the reports that a query still holds; for a stream
    longer than ``spark.sql.streaming.numRecentProgressUpdates`` batches add a
    ``DroppedRows`` listener before it starts."""
    total = 0
    for p in query.recentProgress:
        for op in p.get("stateOperators", []) if isinstance(p, dict) else getattr(p, "stateOperators", []):
            v = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else getattr(op, "numRowsDroppedByWatermark", 0)
            total += int(v or 0)
    return total


def _ntz(df: DataFrame, cols: list[str]) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


# --------------------------------------------------------------------------
# Jobs
# --------------------------------------------------------------------------


def kpi_stream(telemetry_stream: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Warm path: minute KPIs, emitted once the watermark passes the window."""
    kpis = tm.minute_kpis(with_event_time(telemetry_stream, delay), exact_distinct=False)
    return _ntz(kpis, ["window_start", "window_end"])


def state_stream(telemetry_stream: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """The same as mergeable states (see ``plans/kpi_state.py``)."""
    return _ntz(ks.minute_states(with_event_time(telemetry_stream, delay)), ["window_start", "window_end"])


def alert_stream(telemetry_stream: DataFrame) -> DataFrame:
    """Hot path: keyed alert messages (stateless; no watermark needed)."""
    return tm.alert_messages(tm.detect_alerts(telemetry_stream))


def archive_frame(df: DataFrame, ts_col: str = "event_ts") -> DataFrame:
    """Cold path columns: event date and hour partitions (UTC)."""
    t = F.col(ts_col).cast("timestamp")
    return df.withColumn("event_date", F.to_date(t)).withColumn("event_hour", F.hour(t))


def write_parquet(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                  mode: str = "append"):
    w = df.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint
    ).outputMode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w


def dedupe_events(stream: DataFrame, keys: list[str], delay: str = WATERMARK) -> DataFrame:
    """U4: drop re-delivered events; state is bounded by the watermark."""
    s = stream.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    out = s.withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(keys)
    return _ntz(out, ["event_ts"])


# --------------------------------------------------------------------------
# foreachBatch sinks
# --------------------------------------------------------------------------


class KeyedUpsertSink:
    """``foreachBatch`` sink into a ``VersionedTable`` (S11, T9): a batch rewrites
    the partitions that it touches, a repeated one changes nothing."""

    def __init__(self, path: str, keys: list[str], partition: Column | None = None, keep: int = 16):
        self.table = VersionedTable(path, keys, partition, keep, lambda spark, where: read_if_there(spark, where))

    def current(self, spark: SparkSession) -> DataFrame | None:
        return self.table.read(spark)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.table.commit(batch, batch_id)


class DeadLetterRouter:
    """Decode framed messages; good rows and dead letters go to two tables."""

    def __init__(self, good_path: str, bad_path: str, schema: T.StructType, required: list[str]):
        self.good_path, self.bad_path = good_path, bad_path
        self.schema, self.required = schema, required

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        decoded = wire.decode(batch, self.schema, keep=["offset"]).withColumn("batch_id", F.lit(batch_id))
        decoded = decoded.persist()
        try:
            good, bad = wire.split_dead_letters(decoded, self.required)
            # overwrite this batch's slice only: replays of a batch id are no-ops
            good.write.mode("overwrite").parquet(f"{self.good_path}/batch={batch_id}")
            bad.write.mode("overwrite").parquet(f"{self.bad_path}/batch={batch_id}")
        finally:
            decoded.unpersist()


class LateRowTagger:
    """Side output for rows already behind the watermark (T4).

    Each batch's event-time maximum is recorded; a row is late when its event
    time is below (max of earlier batches - delay), which is the watermark the
    windowed aggregation applies to the same batch.
    """

    def __init__(self, late_path: str, progress_path: str, delay_seconds: int = 30,
                 ts_col: str = "event_ts"):
        self.late_path, self.progress_path = late_path, progress_path
        self.delay, self.ts_col = delay_seconds, ts_col

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prior = read_if_there(spark, self.progress_path)
        wm = None if prior is None else prior.where(F.col("batch_id") < batch_id).agg(F.max("max_ts").alias("m")).first()["m"]
        batch = batch.persist()
        try:
            if wm is not None:
                edge = F.lit(wm).cast("timestamp_ntz") - F.expr(f"INTERVAL {self.delay} SECONDS")
                late = batch.where(F.col(self.ts_col).cast("timestamp_ntz") < edge)
                late.write.mode("overwrite").parquet(f"{self.late_path}/batch={batch_id}")
            top = batch.agg(F.max(F.col(self.ts_col).cast("timestamp_ntz")).alias("max_ts"))
            if prior is not None:  # the furthest so far, so that one row tells it and older ones can go
                top = top.unionByName(prior.where(F.col("batch_id") < batch_id).select("max_ts")).agg(F.max("max_ts").alias("max_ts"))
            top = spark.createDataFrame(top.collect(), "max_ts timestamp_ntz")
            top.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{self.progress_path}/b={batch_id}")
            delete(spark, f"{self.progress_path}/b={batch_id - 2}")  # the one before is for a repeated batch
        finally:
            batch.unpersist()


class BatchDedupeSink:
    """Exactly-once de-duplication across micro-batches, safe for hot keys (U4).

    ``dropDuplicatesWithinWatermark`` routes every copy of a key to one state
    partition; when one group of copies holds a large share of the stream,
    that task does all the work. Here each micro-batch is first de-duplicated
    by an aggregate (copies collapse map-side before any shuffle), then its keys
    are looked up in a ``SeenKeys`` store: bitmaps first, key files only for keys
    whose bit is set, and only dates within ``horizon_days`` of the batch. The new
    rows are written as this batch's slice and their keys are remembered. A
    replayed batch id starts from the same store and overwrites its own slices.
    """

    def __init__(self, out_path: str, seen_path: str, keys: list[str], ts_col: str,
                 horizon_days: int = 1):
        self.out_path, self.keys, self.ts_col = out_path.rstrip("/"), keys, ts_col
        self.seen = SeenKeys(seen_path, keys, horizon_days)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        date = F.to_date(F.col(self.ts_col))
        fresh = self.seen.hashed(dedupe_ordered(batch, self.keys), date).persist()
        try:
            states = self.seen.states(spark)
            prior = max((b for b in states if b < batch_id), default=None)
            state = states[prior] if prior is not None else {}
            earliest = fresh.agg(F.min(date).alias("d")).first()["d"]
            new = self.seen.unseen(fresh, state, self.seen.near(state, earliest)).drop("_date", "_h", "_b")
            out = f"{self.out_path}/batch={batch_id}"
            new.write.mode("overwrite").parquet(out)
            # what was written is what is remembered, so the lookup runs once
            written = spark.read.schema(new.schema).parquet(out)
            self.seen.add(self.seen.hashed(written, date), batch_id, states, prior)
        finally:
            fresh.unpersist()
