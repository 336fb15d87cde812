"""Streams give the batch answer; replays are no-ops; late data is handled."""

from pyspark.sql import functions as F

from tidewater.plans import telemetry as tm
from tidewater.session import scratch_path
from tidewater.streaming import jobs


def test_stream_equals_batch_on_closed_windows(spark, tables):
    ev = tables.events
    src = scratch_path(spark, "t-src")
    jobs.stage_files(ev, src, 3, "ts")
    stream = tm.telemetry_from_events(jobs.file_stream(spark, src, ev.schema))
    out, ckpt = scratch_path(spark, "t-out"), scratch_path(spark, "t-ckpt")
    jobs.run_available_now(jobs.write_parquet(jobs.kpi_stream(stream), out, ckpt))
    got = spark.read.parquet(out)
    edge = ev.agg(F.max("ts")).first()[0]
    batch = tm.minute_kpis(tm.telemetry_from_events(ev), exact_distinct=False).where(
        F.col("window_end") <= F.lit(edge).cast("timestamp_ntz") - F.expr("INTERVAL 30 SECONDS"))
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    # restart with nothing new: nothing is re-emitted
    jobs.run_available_now(jobs.write_parquet(jobs.kpi_stream(stream), out, ckpt))
    assert spark.read.parquet(out).count() == got.count()


def test_late_file_is_dropped_then_reconciled(spark, tables):
    ev = tables.events
    split = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    src, out, ckpt = scratch_path(spark, "l-src"), scratch_path(spark, "l-out"), scratch_path(spark, "l-ckpt")
    for part, cond in (("a", F.col("ts") >= split), ("b", F.col("ts") < split)):
        ev.where(cond).write.parquet(f"{src}/{part}")
        stream = tm.telemetry_from_events(
            spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(src))
        q = jobs.run_available_now(jobs.write_parquet(jobs.kpi_stream(stream), out, ckpt))
    assert jobs.rows_dropped_by_watermark(q) > 0                           # T3 reported
    emitted = spark.read.parquet(out)
    assert emitted.where(F.col("window_start") < split).count() == 0      # late rows dropped
    fixed = tm.reconcile_kpis(emitted, tm.telemetry_from_events(ev))
    full = tm.minute_kpis(tm.telemetry_from_events(ev))
    assert fixed.exceptAll(full).count() == 0 and full.exceptAll(fixed).count() == 0
    late = tm.late_rows(tm.telemetry_from_events(ev), emitted)
    assert late.where(F.col("event_ts") >= split).count() <= late.count()
    assert late.where(F.col("event_ts") < split).count() == ev.where(F.col("ts") < split).count()


def test_upsert_sink_replay_is_noop(spark):
    sink = jobs.KeyedUpsertSink(scratch_path(spark, "u-sink"), ["k"])
    b0 = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b1 = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    sink(b0, 0)
    sink(b1, 1)
    first = sorted(tuple(r) for r in sink.current(spark).collect())
    sink(b1, 1)  # re-delivered batch
    again = sorted(tuple(r) for r in sink.current(spark).collect())
    assert first == again == [(1, "a"), (2, "B"), (3, "c")]
    b2 = spark.createDataFrame([(1, "A")], "k int, v string")
    sink(b2, 2)
    sink(b2, 2)
    assert sorted(tuple(r) for r in sink.current(spark).collect()) == [(1, "A"), (2, "B"), (3, "c")]


def test_bus_records_round_trip_and_dead_letters(spark, tables):
    from tidewater.sources import wire

    ev = tables.events
    rec = wire.as_bus_records(ev, "user_id", "event_id", ts_col="ts")
    broken = rec.withColumn("value", F.when(F.col("offset") % 7 == 0, F.substring("value", 1, 9)).otherwise(F.col("value")))
    good, bad = wire.split_dead_letters(wire.decode_bus_records(broken, ev.schema), ["event_id"])
    assert good.count() + bad.count() == ev.count()
    assert bad.count() == ev.where(F.col("event_id") % 7 == 0).count()
    assert good.drop(*wire.TRANSPORT_COLUMNS).exceptAll(ev.where(F.col("event_id") % 7 != 0)).count() == 0


def test_batch_dedupe_replay_and_hot_copies(spark):
    out_p, seen_p = scratch_path(spark, "bd-out"), scratch_path(spark, "bd-seen")
    sink = jobs.BatchDedupeSink(out_p, seen_p, ["k"], "ts", horizon_days=2)
    mk = lambda rows: spark.createDataFrame(rows, "k int, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    hot = [(1, "2024-01-01 00:00:00")] * 300
    sink(mk(hot + [(2, "2024-01-01 00:00:01")]), 0)
    b1 = mk(hot + [(3, "2024-01-01 00:00:02")])
    sink(b1, 1)
    sink(b1, 1)                                    # replayed batch
    got = sorted(r.k for r in spark.read.parquet(out_p).collect())
    assert got == [1, 2, 3]


def test_reconcile_is_idempotent(spark, tables):
    tel = tm.telemetry_from_events(tables.events)
    full = tm.minute_kpis(tel)
    emitted = full.where(F.col("geofence_id") != "click")          # a stream that lost some windows
    once = tm.reconcile_kpis(emitted, tel)
    twice = tm.reconcile_kpis(once, tel)
    assert once.exceptAll(full).count() == 0 and full.exceptAll(once).count() == 0
    assert twice.exceptAll(once).count() == 0 and once.exceptAll(twice).count() == 0


def test_vehicle_payloads_through_the_wire(spark):
    from tidewater.sources import wire

    rows = [
        ("e1", "V1", None, 1704067200123, 40.7, -74.0, 60.0, 90.0, -7.5, 2100, 55.0, 1000.0, True, None, 1),
        ("e2", "V2", "D2", 1704067201456, 40.7, -74.0, 70.0, 90.0, 0.3, 2500, 45.0, 2000.0, False, "manhattan", 1),
        ("e3", "V3", None, 1704067202789, 40.7, -74.0, 50.0, 90.0, 0.1, 1800, 35.0, 3000.0, False, "manhattan", 1),
    ]
    payload = spark.createDataFrame(rows, tm.VEHICLE_SCHEMA)
    records = wire.as_bus_records(payload, "vehicle_id", "engine_rpm")
    decoded, bad = wire.split_dead_letters(wire.decode_bus_records(records, tm.VEHICLE_SCHEMA), ["event_id"])
    assert bad.count() == 0 and {r.msg_key for r in decoded.collect()} == {"V1", "V2", "V3"}
    tel = tm.telemetry_from_vehicles(decoded)
    ts = {r.event_id: r.event_ts for r in tel.collect()}
    assert ts["e1"].microsecond == 123000                      # millis kept exactly
    alerts = {(r.event_id, r.alert_type, round(r.acceleration_ms2, 4)) for r in tm.detect_alerts(tel).collect()}
    assert alerts == {("e1", "HARSH_BRAKING", -7.5), ("e2", "GEOFENCE_SPEED", 0.3)}
    kpis = tm.minute_kpis(tel).collect()
    assert sum(r.total_events for r in kpis) == 3


def test_alert_stream_equals_batch_messages(spark, tables):
    ev = tables.events
    src = scratch_path(spark, "a-src")
    jobs.stage_files(ev, src, 4, "ts")
    stream = tm.telemetry_from_events(jobs.file_stream(spark, src, ev.schema, max_files_per_trigger=1))
    out, ckpt = scratch_path(spark, "a-out"), scratch_path(spark, "a-ckpt")
    q = jobs.run_available_now(jobs.write_parquet(jobs.alert_stream(stream), out, ckpt))
    assert len([p for p in q.recentProgress if p.get("numInputRows")]) >= 2     # several micro-batches
    got = spark.read.parquet(out)
    batch = tm.alert_messages(tm.detect_alerts(tm.telemetry_from_events(ev)))
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
