"""Jobs started together, on triggers, restarted without loss or doubles."""

import pytest
from pyspark.sql import functions as F

from tidewater.plans import telemetry as tm
from tidewater.session import scratch_path
from tidewater.streaming import jobs
from tidewater.streaming.runner import Job, JobRunner, Sink


def test_parquet_and_memory_sinks_across_a_restart(spark, tables):
    ev = tables.events
    src, out, root = (scratch_path(spark, x) for x in ("rs", "ro", "rr"))
    want = sorted(r.key for r in tm.alert_messages(tm.detect_alerts(tm.telemetry_from_events(ev))).collect())
    batches = []

    def runner():
        alerts = jobs.alert_stream(tm.telemetry_from_events(jobs.file_stream(spark, f"{src}/*", ev.schema, max_files_per_trigger=1)))
        return (JobRunner(spark, root).add(Job("to_files", alerts, Sink("parquet", out), "1 second"))
                .add(Job("to_memory", alerts, Sink("memory"), "1 second"))
                .add(Job("to_batches", alerts, Sink("batches", batches=lambda df, i: batches.append((i, df.count()))), "1 second"))
                .add(Job("once", alerts, Sink("noop"))))

    for k in range(3):
        ev.where(F.col("event_id") % 3 == k).repartition(2).write.parquet(f"{src}/{k}")
        with runner() as running:
            running.drain()
            in_memory = sorted(r.key for r in spark.table("to_memory").collect())
        so_far = sorted(r.key for r in spark.read.parquet(out).collect())
        assert so_far == in_memory and len(set(so_far)) == len(so_far)
    assert so_far == want
    assert len({i for i, _ in batches}) == len(batches) == 6 and sum(n for _, n in batches) == len(want)


def test_a_failed_job_is_reported_and_a_bad_one_stops_the_rest(spark, tables):
    ev = tables.events
    src = jobs.stage_files(ev, scratch_path(spark, "fs"), 1)
    frame = jobs.file_stream(spark, src, ev.schema)

    def broken(df, i):
        raise RuntimeError("the warehouse is away")

    with JobRunner(spark, scratch_path(spark, "fr")).add(Job("bad", frame, Sink("batches", batches=broken), "1 second")) as running:
        with pytest.raises(Exception, match="away"):
            running.drain()
    assert "away" in running.failures()["bad"]
    runner = JobRunner(spark, scratch_path(spark, "fr")).add(Job("good", frame, Sink("noop"), "1 second"))
    runner.add(Job("worse", frame, Sink("parquet", scratch_path(spark, "fo")), "1 second", mode="complete"))
    with pytest.raises(Exception):
        runner.start()
    assert not runner.queries["good"].isActive


def test_sinks_state_what_they_need(spark):
    for bad in (dict(format="batches"), dict(format="parquet"), dict(format="kafka", options={"topic": "t"}), dict(format="tape")):
        with pytest.raises(ValueError):
            Sink(**bad)
    Sink("kafka", options={"kafka.bootstrap.servers": "h:9092", "topic": "t"})
    with pytest.raises(ValueError, match="named"):
        JobRunner(spark, "x").add(Job("a", None, Sink("noop"))).add(Job("a", None, Sink("noop")))
