"""The versioned keyed table: constant cost per batch, pinned readers, replays."""

import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators.upsert import DuplicateKeyError
from tidewater.session import scratch_path
from tidewater.streaming import versioned
from tidewater.streaming.jobs import KeyedUpsertSink
from tidewater.streaming.versioned import VersionedTable

SCHEMA = "day date, k int, v string"


def table_at(spark, **kw):
    return VersionedTable(scratch_path(spark, "vt"), ["day", "k"], F.col("day"), **kw)


def rows(df):
    return sorted(tuple(r) for r in df.select("k", "v").collect())


def batch(spark, *rows):
    return spark.createDataFrame([(d, k, v) for d, k, v in rows], "day string, k int, v string").withColumn("day", F.col("day").cast("date"))


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path.removeprefix("file:")) for f in fs)


def test_upserts_insert_and_replace_and_replays_change_nothing(spark):
    t = table_at(spark)
    assert t.read(spark) is None
    assert t.commit(batch(spark, ("2024-01-01", 1, "a"), ("2024-01-02", 2, "b"), (None, 9, "n")), 5) == 0
    second = batch(spark, ("2024-01-02", 2, "B"), ("2024-01-03", 3, "c"), (None, 9, "N"))
    assert t.commit(second, 6) == 1 and t.commit(second, 6) == 1
    assert rows(t.read(spark)) == [(1, "a"), (2, "B"), (3, "c"), (9, "N")]
    assert rows(t.read(spark, 0)) == [(1, "a"), (2, "b"), (9, "n")]
    assert rows(t.read(spark, parts=["2024-01-03", "2030-01-01"])) == [(3, "c")]
    assert t.commit(batch(spark), 7) == 2 and rows(t.read(spark)) == rows(t.read(spark, 1))
    with pytest.raises(ValueError, match="not kept"):
        t.read(spark, 44)


def test_only_touched_partitions_are_rewritten(spark):
    t = table_at(spark)
    t.commit(batch(spark, ("2024-01-01", 1, "a"), ("2024-01-02", 2, "b")), 0)
    before = t.snapshot(spark).parts
    t.commit(batch(spark, ("2024-01-02", 5, "x")), 1)
    after = t.snapshot(spark).parts
    assert after["2024-01-01"] == before["2024-01-01"] and after["2024-01-02"] != before["2024-01-02"]


def test_bytes_of_a_batch_do_not_grow_with_history_and_old_readers_live(spark):
    t = table_at(spark, keep=40)
    t.commit(batch(spark, ("2023-12-31", 0, "first")), 0)
    pinned, want = t.read(spark, 0), [(0, "first")]
    written = []
    for b in range(1, 12):
        day = f"2024-01-{b:02d}"
        seen = size(t.path)
        t.commit(batch(spark, *((day, k, f"{b}") for k in range(200))), b)
        written.append(size(t.path) - seen)
    assert max(written) < 1.6 * min(written)
    assert rows(pinned) == want and rows(t.read(spark, 0)) == want
    assert t.read(spark).count() == 1 + 11 * 200


def test_old_versions_are_retired_and_the_rest_stays_readable(spark, monkeypatch):
    monkeypatch.setattr(versioned, "FULL_EVERY", 4)
    t = table_at(spark, keep=3)
    for b in range(11):
        t.commit(batch(spark, ("2024-01-01", b % 2, f"{b}"), ("2024-02-01", 7, f"{b}") if b < 2 else ("2024-01-01", 5, "z")), b)
    t.retire(spark)
    versions = sorted(t._snapshots(t._log(spark)))
    assert len(t._log(spark)) <= 3 + versioned.FULL_EVERY
    dirs = os.listdir(f"{t.path.removeprefix('file:')}/data")
    assert len(dirs) < 8
    assert rows(t.read(spark)) == [(0, "10"), (1, "9"), (5, "z"), (7, "1")]
    assert rows(t.read(spark, versions[-3])) == [(0, "8"), (1, "7"), (5, "z"), (7, "1")]


def test_a_crash_before_the_log_row_leaves_the_old_version(spark, monkeypatch):
    t = table_at(spark)
    t.commit(batch(spark, ("2024-01-01", 1, "a")), 0)
    monkeypatch.setattr(versioned, "LOG_SCHEMA", "broken")
    with pytest.raises(Exception):  # noqa: B017 - whatever stops the writer
        t.commit(batch(spark, ("2024-01-01", 1, "b")), 1)
    monkeypatch.undo()
    assert rows(t.read(spark)) == [(1, "a")]
    t.commit(batch(spark, ("2024-01-01", 1, "b")), 1)
    assert rows(t.read(spark)) == [(1, "b")]


def test_bad_batches_and_partitions_raise(spark):
    t = table_at(spark)
    with pytest.raises(DuplicateKeyError):
        t.commit(batch(spark, ("2024-01-01", 1, "a"), ("2024-01-01", 1, "b")), 0)
    with pytest.raises(TypeError, match="date"):
        VersionedTable(scratch_path(spark, "vt"), ["k"], F.lit("x/y")).commit(batch(spark, ("2024-01-01", 1, "a")), 0)
    with pytest.raises(ValueError):
        table_at(spark, keep=0)


def test_sink_over_several_batches(spark):
    sink = KeyedUpsertSink(scratch_path(spark, "vs"), ["k"])
    sink(batch(spark), 0)
    assert sink.current(spark).count() == 0
    for b in range(1, 7):
        sink(batch(spark, ("2024-01-01", b % 5, f"{b}")), b)
    assert rows(sink.current(spark)) == [(0, "5"), (1, "6"), (2, "2"), (3, "3"), (4, "4")]
