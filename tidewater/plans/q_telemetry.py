"""Telemetry queries (batch and streaming) with their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators.dedup import find_duplicates
from tidewater.operators.geo import tag_points
from tidewater.plans import kpi_state as ks
from tidewater.plans import telemetry as tm
from tidewater.registry import query
from tidewater.session import read_if_there, scratch_path
from tidewater.sources import wire
from tidewater.streaming import jobs
from tidewater.streaming.archive import Archive, gaps, merge_ranges
from tidewater.streaming.runner import ALERT_INTERVAL, ARCHIVE_INTERVAL, KPI_INTERVAL, Job, JobRunner, Sink
from tidewater.streaming.versioned import VersionedTable

TELEMETRY_SQL = """
t AS (
  SELECT event_id, user_id AS vehicle_id, ts AS event_ts, nullif(event_type, 'view') AS geofence_id,
         value AS speed_kph, event_type = 'error' AS harsh_braking,
         CAST(json_extract(props, '$.k') AS DOUBLE) / 10.0 AS acceleration_ms2,
         'D' || CAST(user_id % 97 AS VARCHAR) AS driver_id, CAST(user_id % 90 AS DOUBLE) AS latitude,
         CAST(event_id % 180 AS DOUBLE) AS longitude
  FROM events
)"""

ALERTS_SQL = f"""WITH {TELEMETRY_SQL},
alerts AS (
  SELECT event_id, vehicle_id, event_ts, 'HARSH_BRAKING' AS alert_type, acceleration_ms2, speed_kph,
         driver_id, latitude, longitude
  FROM t WHERE harsh_braking
  UNION ALL
  SELECT event_id, vehicle_id, event_ts, 'GEOFENCE_SPEED' AS alert_type, acceleration_ms2, speed_kph,
         driver_id, latitude, longitude
  FROM t WHERE geofence_id IS NOT NULL AND speed_kph > 50
)"""

KPI_SELECT = f"""
SELECT time_bucket(INTERVAL 1 MINUTE, event_ts) AS window_start,
       time_bucket(INTERVAL 1 MINUTE, event_ts) + INTERVAL 1 MINUTE AS window_end,
       coalesce(geofence_id, '__none__') AS geofence_id,
       count(DISTINCT vehicle_id) AS active_vehicles,
       round(avg(speed_kph), 6) AS avg_speed_kph,
       max(speed_kph) AS max_speed_kph,
       CAST(sum(CAST(harsh_braking AS INTEGER)) AS BIGINT) AS harsh_braking_events,
       count(*) AS total_events
FROM t GROUP BY 1, 2, 3"""

KPI_SQL = f"WITH {TELEMETRY_SQL}\n{KPI_SELECT}"

# windows a 30 s watermark has closed once everything was read
CLOSED_KPI_SQL = f"""WITH {TELEMETRY_SQL}, k AS ({KPI_SELECT})
SELECT * FROM k WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 30 SECOND"""


def _rounded(kpis):
    """Averages of doubles depend on the order of the sum; compare 6 digits."""
    return kpis.withColumn("avg_speed_kph", F.round("avg_speed_kph", 6))


def _telemetry(t):
    return tm.telemetry_from_events(t.events)


@query("alerts_union", f"{ALERTS_SQL}\nSELECT * FROM alerts")
def q_alerts_union(spark, t):
    """Harsh braking and geofence speeding alerts (UNION ALL semantics)."""
    return tm.detect_alerts(_telemetry(t))


@query(
    "alert_keys",
    f"""{ALERTS_SQL}
SELECT CAST(vehicle_id AS VARCHAR) || '|' || alert_type || '|' || CAST(event_id AS VARCHAR) AS key,
       event_id, alert_type FROM alerts""",
)
def q_alert_keys(spark, t):
    """Sink keys ``vehicle|alert_type|event``."""
    msgs = tm.alert_messages(tm.detect_alerts(_telemetry(t)))
    return msgs.select(
        "key",
        F.split_part("key", F.lit("|"), F.lit(3)).cast("long").alias("event_id"),
        F.split_part("key", F.lit("|"), F.lit(2)).alias("alert_type"),
    )


@query(
    "alert_messages",
    f"""{ALERTS_SQL}
SELECT CAST(vehicle_id AS VARCHAR) || '|' || alert_type || '|' || CAST(event_id AS VARCHAR) AS key,
       '{{"event_id":' || CAST(event_id AS VARCHAR) || ',"vehicle_id":' || CAST(vehicle_id AS VARCHAR)
       || ',"driver_id":"' || driver_id || '","event_ts":"' || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || '","alert_type":"' || alert_type
       || '","acceleration_ms2":' || CAST(acceleration_ms2 AS VARCHAR)
       || ',"speed_kph":' || CAST(speed_kph AS VARCHAR) || ',"latitude":' || CAST(latitude AS VARCHAR)
       || ',"longitude":' || CAST(longitude AS VARCHAR) || '}}' AS value
FROM alerts""",
)
def q_alert_messages(spark, t):
    """Keyed JSON alert messages (the whole row as JSON)."""
    return tm.alert_messages(tm.detect_alerts(_telemetry(t)))


@query(
    "alert_duplicates",
    f"""{ALERTS_SQL}
SELECT event_id, alert_type, count(*) AS n FROM alerts GROUP BY 1, 2 HAVING count(*) > 1""",
)
def q_alert_duplicates(spark, t):
    """No (event_id, alert_type) pair appears twice."""
    return find_duplicates(tm.detect_alerts(_telemetry(t)), ["event_id", "alert_type"])


@query("kpi_minute", KPI_SQL)
def q_kpi_minute(spark, t):
    """One-minute KPIs per geofence (exact distinct vehicles)."""
    return _rounded(tm.minute_kpis(_telemetry(t)))


@query("kpi_minute_approx")
def q_kpi_minute_approx(spark, t):
    """A3: the same with approx_count_distinct (5 % relative error)."""
    return _rounded(tm.minute_kpis(_telemetry(t), exact_distinct=False))


@query(
    "kpi_last_24h",
    f"""WITH {TELEMETRY_SQL}, k AS ({KPI_SELECT})
SELECT * FROM k WHERE window_start >= (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""",
)
def q_kpi_last_24h(spark, t):
    """KPIs of the 24 hours before the newest event."""
    tel = _telemetry(t)
    as_of = tm.max_event_time(tel, "event_ts")
    return _rounded(tm.recent_minute_kpis(tel, F.lit(as_of).cast("timestamp_ntz")))


@query(
    "throughput_minute",
    "SELECT time_bucket(INTERVAL 1 MINUTE, ts) AS window_start, count(*) AS events FROM events GROUP BY 1",
)
def q_throughput_minute(spark, t):
    """Events per minute."""
    return tm.events_per_minute(_telemetry(t))


@query(
    "alerts_per_minute",
    f"""{ALERTS_SQL}
SELECT time_bucket(INTERVAL 1 MINUTE, event_ts) AS window_start, alert_type, count(*) AS alerts
FROM alerts GROUP BY 1, 2""",
)
def q_alerts_per_minute(spark, t):
    """Alerts per minute and type."""
    return tm.alerts_per_minute(tm.detect_alerts(_telemetry(t)))


@query(
    "decode_payload",
    """
SELECT CAST(user_id AS VARCHAR) AS msg_key, 'events' AS topic, event_id AS "offset",
       event_id, ts, user_id, event_type, value, props FROM events""",
)
def q_decode_payload(spark, t):
    """Events as bus records (key, 5-byte framed JSON value, topic,
    partition, offset, broker time), decoded and flattened."""
    ev = t.events
    records = wire.as_bus_records(ev, "user_id", "event_id", ts_col="ts")
    good, _ = wire.split_dead_letters(wire.decode_bus_records(records, ev.schema), ["event_id"])
    return good.drop("partition", "kafka_ts")


@query(
    "decode_vehicles",
    """
SELECT CAST(event_id AS VARCHAR) AS event_id, 'V' || CAST(user_id AS VARCHAR) AS vehicle_id, CAST(NULL AS VARCHAR) AS driver_id,
       date_trunc('milliseconds', ts) AS event_ts, nullif(event_type, 'view') AS geofence_id,
       event_type = 'error' AS harsh_braking FROM events""",
)
def q_decode_vehicles(spark, t):
    """Framed vehicle payloads decoded; epoch millis become event times."""
    zero = lambda name, kind: F.lit(0).cast(kind).alias(name)
    payload = t.events.select(
        F.col("event_id").cast("string").alias("event_id"), F.concat(F.lit("V"), F.col("user_id").cast("string")).alias("vehicle_id"),
        F.lit(None).cast("string").alias("driver_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("event_ts_ms"),
        zero("latitude", "double"), zero("longitude", "double"), F.col("value").cast("float").alias("speed_kph"), zero("heading_deg", "float"),
        zero("acceleration_ms2", "float"), zero("engine_rpm", "int"), zero("fuel_level_pct", "float"), zero("odometer_km", "double"),
        (F.col("event_type") == "error").alias("harsh_braking"), F.nullif("event_type", F.lit("view")).alias("geofence_id"), F.lit(1).alias("schema_version"))
    records = wire.as_bus_records(payload, "vehicle_id", "event_ts_ms")
    good, _ = wire.split_dead_letters(wire.decode_bus_records(records, tm.VEHICLE_SCHEMA), ["event_id", "event_ts_ms"])
    tel = tm.telemetry_from_vehicles(good)
    return tel.select("event_id", "vehicle_id", "driver_id", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"), "geofence_id", "harsh_braking")


ZONES = [
    # zone_id, min_lat, max_lat, min_lon, max_lon  (a parameter of the query)
    ("Z1", 0.0, 20.0, 0.0, 5.0),
    ("Z2", 10.0, 40.0, 3.0, 12.0),
    ("Z3", 50.0, 100.0, 10.0, 24.0),
]


@query(
    "geofence_tag",
    """
WITH zones(zone_id, min_lat, max_lat, min_lon, max_lon) AS (
  VALUES ('Z1', 0.0::DOUBLE, 20.0::DOUBLE, 0.0::DOUBLE, 5.0::DOUBLE),
         ('Z2', 10.0, 40.0, 3.0, 12.0), ('Z3', 50.0, 100.0, 10.0, 24.0)),
p AS (SELECT c_custkey, c_acctbal / 100.0 AS lat, CAST(c_nationkey AS DOUBLE) AS lon FROM customer)
SELECT p.c_custkey, p.lat, p.lon, z.zone_id
FROM p LEFT JOIN zones z ON p.lat BETWEEN z.min_lat AND z.max_lat AND p.lon BETWEEN z.min_lon AND z.max_lon""",
)
def q_geofence_tag(spark, t):
    """Points tagged with every zone box containing them."""
    pts = t.customer.select(
        "c_custkey", (F.col("c_acctbal") / 100.0).alias("lat"), F.col("c_nationkey").cast("double").alias("lon")
    )
    zones = spark.createDataFrame(ZONES, "zone_id string, min_lat double, max_lat double, min_lon double, max_lon double")
    return tag_points(pts, zones, "lat", "lon")


@query(
    "geofence_tag_sizes",
    """
WITH p AS (SELECT c_custkey, c_acctbal AS lat, CAST(c_custkey AS DOUBLE) / 10.0 AS lon FROM customer),
zones AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS zone_id, s_acctbal AS min_lat, s_acctbal + 0.25 * (1 + s_nationkey) AS max_lat,
         CAST(s_suppkey AS DOUBLE) AS min_lon, CAST(s_suppkey AS DOUBLE) + 20.0 AS max_lon FROM supplier
  UNION ALL SELECT 'R' || CAST(r_regionkey AS VARCHAR), -1000.0 * r_regionkey, 250000.0 * r_regionkey, 0.0, 1000000.0 FROM region)
SELECT p.c_custkey, p.lat, p.lon, z.zone_id
FROM p LEFT JOIN zones z ON p.lat BETWEEN z.min_lat AND z.max_lat AND p.lon BETWEEN z.min_lon AND z.max_lon""",
)
def q_geofence_tag_sizes(spark, t):
    """Zones from a quarter of a unit to a million units wide, each at most
    nine cells of the grids that suit it."""
    pts = t.customer.select("c_custkey", F.col("c_acctbal").alias("lat"), (F.col("c_custkey").cast("double") / 10.0).alias("lon"))
    side = F.lit(0.25) * (F.lit(1) + F.col("s_nationkey"))
    key = F.col("s_suppkey").cast("double")
    small = t.supplier.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("zone_id"), F.col("s_acctbal").alias("min_lat"),
                              (F.col("s_acctbal") + side).alias("max_lat"), key.alias("min_lon"), (key + 20.0).alias("max_lon"))
    r = F.col("r_regionkey")
    large = t.region.select(F.concat(F.lit("R"), r.cast("string")).alias("zone_id"), (r * F.lit(-1000.0)).alias("min_lat"),
                            (r * F.lit(250000.0)).alias("max_lat"), F.lit(0.0).alias("min_lon"), F.lit(1000000.0).alias("max_lon"))
    return tag_points(pts, small.unionByName(large), "lat", "lon", cell_size=0.25)


# --------------------------------------------------------------------------
# Streaming (file source, availableNow)
# --------------------------------------------------------------------------


def _staged_events(spark, t, label, frame=None, num_files=4):
    ev = frame if frame is not None else t.events
    path = scratch_path(spark, f"{label}-src")
    jobs.stage_files(ev, path, num_files, "ts" if "ts" in ev.columns else None)
    return path, ev.schema


def _telemetry_stream(spark, t, label, frame=None):
    path, schema = _staged_events(spark, t, label, frame)
    return tm.telemetry_from_events(jobs.file_stream(spark, path, schema))


@query("kpi_stream", CLOSED_KPI_SQL)
def q_kpi_stream(spark, t):
    """Streaming KPIs in append mode; open windows are withheld."""
    stream = _telemetry_stream(spark, t, "kpi")
    out, ckpt = scratch_path(spark, "kpi-out"), scratch_path(spark, "kpi-ckpt")
    jobs.run_available_now(jobs.write_parquet(jobs.kpi_stream(stream), out, ckpt))
    return _rounded(spark.read.parquet(out))


@query("kpi_sink_upsert", KPI_SQL)
def q_kpi_sink_upsert(spark, t):
    """KPIs in update mode into a keyed, versioned table: a batch
    rewrites the dates it touches."""
    stream = _telemetry_stream(spark, t, "kpiu")
    sink = jobs.KeyedUpsertSink(scratch_path(spark, "kpiu-table"), tm.KPI_KEYS, F.to_date("window_start"))
    w = (
        jobs.kpi_stream(stream).writeStream.outputMode("update")
        .option("checkpointLocation", scratch_path(spark, "kpiu-ckpt")).foreachBatch(sink)
    )
    jobs.run_available_now(w)
    return _rounded(sink.current(spark))


@query("dedup_stream", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_dedup_stream(spark, t):
    """U4: re-delivered events (every click twice) dropped within the watermark."""
    ev = t.events
    redelivered = ev.unionByName(ev.where(F.col("event_type") == "click"))
    path, schema = _staged_events(spark, t, "dedup", redelivered)
    stream = jobs.file_stream(spark, path, schema).withColumnRenamed("ts", "event_ts")
    out = jobs.dedupe_events(stream, ["event_id"]).withColumnRenamed("event_ts", "ts")
    sink, ckpt = scratch_path(spark, "dedup-out"), scratch_path(spark, "dedup-ckpt")
    jobs.run_available_now(jobs.write_parquet(out, sink, ckpt))
    return spark.read.parquet(sink)


@query("dedup_stream_batches", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_dedup_stream_batches(spark, t):
    """U4 (hot-key safe): re-delivered events, including a large group of
    copies, removed across several micro-batches by the foreachBatch dedupe."""
    ev = t.events
    hot = ev.where(F.col("event_type") == "click")
    redelivered = ev.unionByName(hot).unionByName(hot).unionByName(ev.where(F.col("event_type") == "error"))
    path, schema = _staged_events(spark, t, "bdedup", redelivered, num_files=6)
    out_p, seen_p = scratch_path(spark, "bdedup-out"), scratch_path(spark, "bdedup-seen")
    sink = jobs.BatchDedupeSink(out_p, seen_p, ["event_id"], "ts", horizon_days=31)
    w = (
        jobs.file_stream(spark, path, schema, max_files_per_trigger=2).writeStream
        .option("checkpointLocation", scratch_path(spark, "bdedup-ckpt")).foreachBatch(sink)
    )
    jobs.run_available_now(w)
    return spark.read.parquet(out_p).drop("batch")


ARCHIVE_SQL = """
SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS event_date,
       CAST(hour(ts) AS INTEGER) AS event_hour FROM events"""


def _archive(spark, t):
    path, schema = _staged_events(spark, t, "arch")
    stream = jobs.archive_frame(jobs.file_stream(spark, path, schema), "ts")
    out, ckpt = scratch_path(spark, "arch-out"), scratch_path(spark, "arch-ckpt")
    jobs.run_available_now(jobs.write_parquet(stream, out, ckpt, ["event_date", "event_hour"]))
    return spark.read.parquet(out)


@query("archive_stream", ARCHIVE_SQL)
def q_archive_stream(spark, t):
    """Cold archive partitioned by event date and hour."""
    return _archive(spark, t)


@query("archive_replay", KPI_SQL)
def q_archive_replay(spark, t):
    """Warm-path KPIs rebuilt in batch from the archive."""
    arch = _archive(spark, t).drop("event_date", "event_hour")
    return _rounded(tm.minute_kpis(tm.telemetry_from_events(arch)))


def _telemetry_rows(rows):
    """Archived events as telemetry."""
    return tm.telemetry_from_events(rows)


def _state_table(spark, t, label, frame=None):
    """A versioned table of KPI states, filled by a stream (append mode)."""
    stream = _telemetry_stream(spark, t, label, frame)
    sink = jobs.KeyedUpsertSink(scratch_path(spark, f"{label}-table"), tm.KPI_KEYS, F.to_date("window_start"))
    jobs.run_available_now(
        jobs.state_stream(stream).writeStream.outputMode("append")
        .option("checkpointLocation", scratch_path(spark, f"{label}-ckpt")).foreachBatch(sink))
    return sink.table


def _record_archive(spark, t, label):
    """Bus records streamed through the decoder into the archive, with the
    coordinates they came with."""
    ev = t.events
    records = wire.as_bus_records(ev, "user_id", "event_id", ts_col="ts", partition=F.col("user_id") % 8)
    path, schema = _staged_events(spark, t, label, records)
    archive = Archive(spark, scratch_path(spark, f"{label}-archive"), _telemetry_rows, "ts")
    good, _ = wire.split_dead_letters(wire.decode_bus_records(jobs.file_stream(spark, path, schema), ev.schema),
                                      ["event_id"])
    jobs.run_available_now(
        good.writeStream.option("checkpointLocation", scratch_path(spark, f"{label}-ckpt")).foreachBatch(archive))
    return archive


@query(
    "archive_records",
    """
SELECT CAST(user_id AS VARCHAR) AS msg_key, 'events' AS topic, CAST(user_id % 8 AS INTEGER) AS "partition", event_id AS "offset",
       ts AS kafka_ts, event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS event_date,
       CAST(hour(ts) AS INTEGER) AS event_hour FROM events""",
)
def q_archive_records(spark, t):
    """Decoded bus records archived with topic, partition, offset and
    broker time."""
    return _record_archive(spark, t, "arec").rows().withColumn("kafka_ts", F.col("kafka_ts").cast("timestamp_ntz"))


@query(
    "archive_gaps",
    """
WITH o AS (SELECT user_id % 8 AS p, event_id AS o, lag(event_id) OVER (PARTITION BY user_id % 8 ORDER BY event_id) AS before FROM events)
SELECT 'events' AS topic, CAST(p AS INTEGER) AS "partition", before + 1 AS gap_start, o - 1 AS gap_end, o - before - 1 AS missing
FROM o WHERE o > before + 1""",
)
def q_archive_gaps(spark, t):
    """Offsets between the first and last of each topic partition that the
    archive never received, from the batches' runs of offsets."""
    return gaps(merge_ranges(_record_archive(spark, t, "agap").ranges()))


@query("kpi_reconciled", KPI_SQL)
def q_kpi_reconciled(spark, t):
    """Windows whose archived events differ from the streamed states are
    recomputed from their archive partitions and upserted by date."""
    table = _state_table(spark, t, "rec")
    archive = _record_archive(spark, t, "recarch")
    ks.reconcile(table, archive, _telemetry_rows, run_id=1)
    return _rounded(ks.kpis(table.read(spark)))


@query(
    "kpi_hourly",
    f"""WITH {TELEMETRY_SQL}
SELECT time_bucket(INTERVAL 1 HOUR, event_ts) AS window_start, coalesce(geofence_id, '__none__') AS geofence_id,
       round(avg(speed_kph), 6) AS avg_speed_kph, max(speed_kph) AS max_speed_kph,
       CAST(sum(CAST(harsh_braking AS INTEGER)) AS BIGINT) AS harsh_braking_events, count(*) AS total_events,
       count(DISTINCT vehicle_id) AS exact_vehicles, TRUE AS within_bound
FROM t GROUP BY 1, 2""",
)
def q_kpi_hourly(spark, t):
    """A3: hours rolled up from the stored minute states, late half of the month
    merged in; the sketch's estimate against the exact count of each hour."""
    ev = t.events
    late = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    table = VersionedTable(scratch_path(spark, "hourly"), tm.KPI_KEYS, F.to_date("window_start"))
    table.commit(ks.minute_states(tm.telemetry_from_events(ev.where(~late | (F.col("event_id") % 3 == 0)))), 0)
    ks.add_late(table, tm.telemetry_from_events(ev.where(late & (F.col("event_id") % 3 != 0))), 1)
    hours = ks.kpis(ks.roll_up(table.read(spark), "1 hour"))
    exact = (_telemetry(t).groupBy(F.window("event_ts", "1 hour").start.alias("window_start"),
                                   F.coalesce("geofence_id", F.lit(tm.NO_GEOFENCE)).alias("geofence_id"))
             .agg(F.count_distinct("vehicle_id").alias("exact_vehicles")))
    both = _rounded(hours).join(exact, tm.KPI_KEYS)
    return both.select(*tm.KPI_KEYS, "avg_speed_kph", "max_speed_kph", "harsh_braking_events", "total_events", "exact_vehicles",
                       ks.within_bound(F.col("active_vehicles"), F.col("exact_vehicles")).alias("within_bound"))


def _paths_of(spark, label, src, schema, intervals=(ALERT_INTERVAL, KPI_INTERVAL, ARCHIVE_INTERVAL)):
    """The three paths over one landing zone: alerts, KPI states, archive."""
    records = jobs.file_stream(spark, src, schema)
    telemetry = tm.telemetry_from_events(records)
    at = {name: scratch_path(spark, f"{label}-{name}") for name in ("alerts", "states", "archive", "root")}
    states = jobs.KeyedUpsertSink(at["states"], tm.KPI_KEYS, F.to_date("window_start"))
    archive = Archive(spark, at["archive"], _telemetry_rows, "ts")

    def runner():
        return (JobRunner(spark, at["root"])
                .add(Job("alerts", jobs.alert_stream(telemetry), Sink("parquet", at["alerts"]), intervals[0]))
                .add(Job("kpis", jobs.state_stream(telemetry), Sink("batches", batches=states), intervals[1]))
                .add(Job("archive", records, Sink("batches", batches=archive), intervals[2])))

    return runner, at


@query(
    "alert_stream_restarted",
    f"""{ALERTS_SQL}
SELECT CAST(vehicle_id AS VARCHAR) || '|' || alert_type || '|' || CAST(event_id AS VARCHAR) AS key FROM alerts""",
)
def q_alert_stream_restarted(spark, t):
    """Alerts, KPIs and archive run together on processing-time triggers
    (short ones: draining waits for a trigger without data), are stopped after the first half of the month and started again for the rest."""
    ev, src = t.events, scratch_path(spark, "jobs-src")
    runner, at = _paths_of(spark, "jobs", f"{src}/*", ev.schema, ("1 second",) * 3)
    early = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    for part, rows in (("a", ev.where(early)), ("b", ev.where(~early | F.col("ts").isNull()))):
        rows.write.parquet(f"{src}/{part}")
        with runner() as running:
            running.drain()
    return spark.read.parquet(at["alerts"]).select("key")


@query(
    "dlq_stream",
    """
SELECT event_id AS offset, CASE WHEN event_id % 50 = 0 THEN 'dead_letter' ELSE 'ok' END AS route
FROM events""",
)
def q_dlq_stream(spark, t):
    """Undecodable messages (every 50th payload truncated) go to a dead-letter table."""
    ev = t.events
    payload = F.to_json(F.struct(*[F.col(c) for c in ev.columns]), wire.JSON_TIME_OPTIONS)
    broken = F.when(F.col("event_id") % 50 == 0, F.substring(payload, 1, 12)).otherwise(payload)
    frames = ev.select(F.col("event_id").alias("offset"), wire.frame(broken).alias("value"))
    path = scratch_path(spark, "dlq-src")
    jobs.stage_files(frames, path, 4, "offset")
    good_p, bad_p = scratch_path(spark, "dlq-good"), scratch_path(spark, "dlq-bad")
    router = jobs.DeadLetterRouter(good_p, bad_p, ev.schema, ["event_id", "ts"])
    w = (
        jobs.file_stream(spark, path, frames.schema).writeStream
        .option("checkpointLocation", scratch_path(spark, "dlq-ckpt")).foreachBatch(router)
    )
    jobs.run_available_now(w)
    good = spark.read.parquet(good_p).select("offset", F.lit("ok").alias("route"))
    bad = spark.read.parquet(bad_p).select("offset", F.lit("dead_letter").alias("route"))
    return good.unionByName(bad)


@query(
    "late_side_output",
    """
SELECT event_id FROM events
WHERE ts < TIMESTAMP '2024-01-15 00:00:00'
  AND ts < (SELECT max(ts) FROM events WHERE ts >= TIMESTAMP '2024-01-15 00:00:00') - INTERVAL 30 SECOND""",
)
def q_late_side_output(spark, t):
    """T4: the second half of the month arrives first; the earlier half is tagged late."""
    ev = t.events
    split = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    src = scratch_path(spark, "late-src")
    late_p, prog_p = scratch_path(spark, "late-out"), scratch_path(spark, "late-prog")
    ckpt = scratch_path(spark, "late-ckpt")
    tagger = jobs.LateRowTagger(late_p, prog_p, 30, "ts")
    for part, cond in (("a", F.col("ts") >= split), ("b", F.col("ts") < split)):
        ev.where(cond).write.mode("overwrite").parquet(f"{src}/{part}")
        stream = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(src)
        jobs.run_available_now(
            stream.writeStream.option("checkpointLocation", ckpt).foreachBatch(tagger)
        )
    late = read_if_there(spark, late_p)
    return (ev.where(F.lit(False)) if late is None else late).select("event_id")
