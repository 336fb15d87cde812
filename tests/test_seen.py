"""The bounded store of seen keys."""

import os
import random

from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.streaming import jobs, seen
from tidewater.streaming.seen import SeenKeys


def batch(spark, rows):
    """rows: (key, day of January 2024 or None)."""
    df = spark.createDataFrame([(k, None if d is None else f"2024-01-{d:02d} 10:00:00") for k, d in rows], "k int, ts string")
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def sink_at(spark, horizon=31, **kw):
    s = jobs.BatchDedupeSink(scratch_path(spark, "so"), scratch_path(spark, "ss"), ["k"], "ts", horizon)
    s.seen = SeenKeys(s.seen.path, ["k"], horizon, **kw)
    return s


def out(spark, sink):
    return sorted((r.k is not None, r.k or 0) for r in spark.read.parquet(sink.out_path).collect())


def test_each_key_once_whatever_the_bitmap_says(spark):
    rng = random.Random(3)
    batches = [[(rng.choice([None, *range(40)]), rng.choice([None, 1, 2, 3])) for _ in range(30)] for _ in range(5)]
    for bits in (64, 1 << 20):        # the first collides all the time
        sink = sink_at(spark, bits=bits, buckets=2)
        for i, b in enumerate(batches):
            sink(batch(spark, b), i)
            if i == 2:
                sink(batch(spark, b), i)      # delivered again
        assert out(spark, sink) == sorted({(k is not None, k or 0) for b in batches for k, _ in b})


def test_only_keys_whose_bit_is_set_open_key_files(spark):
    sink = sink_at(spark)
    sink(batch(spark, [(k, 1) for k in range(50)]), 0)
    sink(batch(spark, [(k, 1) for k in range(50, 100)]), 1)
    sink(batch(spark, [(7, 1), (200, 1)]), 2)
    assert sink.seen.opened == [0, 1, 4]      # bitmaps of one segment; then of two, and their key files
    assert len(out(spark, sink)) == 101


def test_directories_of_a_batch_stay_bounded(spark, monkeypatch):
    monkeypatch.setattr(seen, "FANOUT", 3)
    sink = sink_at(spark, buckets=1)
    for i in range(18):
        sink(batch(spark, [(k, 1) for k in range(i * 4, i * 4 + 6)]), i)
    assert len(out(spark, sink)) == 17 * 4 + 6
    assert max(sink.seen.opened) <= 2 * 2 * 3          # two segments a level, three levels, bitmaps and keys
    root = sink.seen.path.removeprefix("file:")
    assert len(os.listdir(f"{root}/_log")) <= 3
    assert len([d for d in os.listdir(f"{root}/keys") if d.startswith("g=")]) <= 10


def test_dates_beyond_the_horizon_are_dropped(spark):
    sink = sink_at(spark, horizon=2)
    for i, day in enumerate((1, 2, 3, 6, 7)):
        sink(batch(spark, [(i, day)]), i)
    states = sink.seen.states(spark)
    assert sorted(states[max(states)]) == ["2024-01-06", "2024-01-07"]
    root = f"{sink.seen.path.removeprefix('file:')}/keys"
    assert sorted(d for d in os.listdir(root) if d.startswith("g=")) == ["g=3", "g=4"] or len(os.listdir(root)) <= 4
    sink(batch(spark, [(3, 6), (9, None)]), 5)
    assert out(spark, sink) == [(True, k) for k in (0, 1, 2, 3, 4, 9)]


def test_an_empty_batch_changes_nothing(spark):
    sink = sink_at(spark)
    sink(batch(spark, []), 0)
    sink(batch(spark, [(1, 1)]), 1)
    sink(batch(spark, []), 2)
    sink(batch(spark, [(1, 1)]), 3)
    assert out(spark, sink) == [(True, 1)]
