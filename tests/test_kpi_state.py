"""Mergeable KPI states, the archive's digests and offsets, and reconciliation."""

import os
import random

from pyspark.sql import functions as F

from tidewater.plans import kpi_state as ks
from tidewater.plans import telemetry as tm
from tidewater.session import scratch_path
from tidewater.streaming import archive as ar
from tidewater.streaming.archive import Archive
from tidewater.streaming.versioned import VersionedTable


def telemetry(spark, rows):
    """rows: (event_id, vehicle_id, seconds after midnight, geofence, speed)."""
    df = spark.createDataFrame(rows, "event_id long, vehicle_id long, s long, geofence_id string, speed_kph double")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_interval(secs=F.col("s"))
    return df.select("event_id", "vehicle_id", at.alias("event_ts"), "geofence_id", "speed_kph", (F.col("event_id") % 3 == 0).alias("harsh_braking"))


def table(spark):
    return VersionedTable(scratch_path(spark, "kt"), tm.KPI_KEYS, F.to_date("window_start"))


def key(df):
    return sorted((str(r.window_start), r.geofence_id, r.active_vehicles, r.total_events, r.harsh_braking_events, r.max_speed_kph,
                   None if r.avg_speed_kph is None else round(r.avg_speed_kph, 9)) for r in df.collect())


def random_rows(seed, n, days=3):
    rng = random.Random(seed)
    return [(i, rng.randint(0, 9), rng.randint(0, 86400 * days - 1) // 40 * 40, rng.choice(["a", "b", None]), rng.choice([1.5, 60.0, None]))
            for i in range(n)]


def test_merged_parts_equal_the_whole(spark):
    rows = random_rows(1, 600)
    whole = ks.minute_states(telemetry(spark, rows))
    parts = ks.minute_states(telemetry(spark, rows[:200])).unionByName(ks.minute_states(telemetry(spark, rows[200:])))
    assert key(ks.kpis(ks.roll_up(parts))) == key(ks.kpis(whole))
    exact = tm.minute_kpis(telemetry(spark, rows))
    assert key(ks.kpis(whole)) == key(exact)
    hours = ks.kpis(ks.roll_up(whole, "1 hour"))
    assert hours.agg(F.sum("total_events")).first()[0] == 600
    assert key(hours) == key(tm.minute_kpis(telemetry(spark, rows), width="1 hour"))


def test_estimates_of_many_vehicles_stay_in_their_bound(spark):
    many = spark.range(0, 60_000).select(
        F.col("id").alias("event_id"), (F.col("id") % 20_000).alias("vehicle_id"),
        F.timestamp_seconds(F.col("id") % 7200).cast("timestamp_ntz").alias("event_ts"), F.lit("z").alias("geofence_id"),
        F.lit(1.0).alias("speed_kph"), F.lit(False).alias("harsh_braking"))
    hours = ks.kpis(ks.roll_up(ks.minute_states(many), "1 hour")).select(F.col("active_vehicles").alias("e"), "window_start")
    exact = many.groupBy(F.window("event_ts", "1 hour").start.alias("window_start")).agg(F.count_distinct("vehicle_id").alias("x"))
    got = hours.join(exact, "window_start").select(ks.within_bound(F.col("e"), F.col("x")).alias("ok"), "e", "x").collect()
    assert len(got) == 2 and all(r.ok for r in got)
    assert not spark.range(1).select(ks.within_bound(F.lit(1100), F.lit(1000)).alias("ok")).first().ok


def test_late_rows_merge_without_a_recount(spark):
    rows = random_rows(2, 500)
    t = table(spark)
    t.commit(ks.minute_states(telemetry(spark, rows[:400])), 0)
    before = t.snapshot(spark).parts
    late = [r for r in rows[400:] if r[2] < 86400]
    ks.add_late(t, telemetry(spark, late), 7)
    ks.add_late(t, telemetry(spark, late), 7)      # the same delivery again
    assert key(ks.kpis(t.read(spark))) == key(tm.minute_kpis(telemetry(spark, rows[:400] + late)))
    after = t.snapshot(spark).parts
    assert {p for p in before if before[p] != after[p]} == {"2024-01-01"}


def _archive(spark, batches):
    archive = Archive(spark, scratch_path(spark, "ka"), lambda rows: rows)
    for i, rows in enumerate(batches):
        archive(telemetry(spark, rows), i)
    return archive


def test_reconcile_reads_only_partitions_that_differ(spark):
    rows = random_rows(3, 900)
    archive = _archive(spark, [rows[:500], rows[500:]])
    archive(telemetry(spark, rows[500:]), 1)         # a repeated batch replaces its slices
    lost = {r[0] for r in rows if 86400 <= r[2] < 86400 + 7200 and r[0] % 4 == 0}
    t = table(spark)
    t.commit(ks.minute_states(telemetry(spark, [r for r in rows if r[0] not in lost])), 0)
    before = t.snapshot(spark).parts
    # the rows of the days that agree become unreadable
    root = f"{archive.path.removeprefix('file:')}/rows"
    for d, _, names in os.walk(root):
        if "event_date=2024-01-02/" not in d:
            for n in names:
                if n.endswith(".parquet"):
                    open(os.path.join(d, n), "wb").write(b"no parquet")
                    os.path.exists(os.path.join(d, f".{n}.crc")) and os.remove(os.path.join(d, f".{n}.crc"))
    differing = ks.reconcile(t, archive, lambda x: x, run_id=20240102)
    assert {(str(r.event_date), r.event_hour) for r in differing.collect()} == {("2024-01-02", 0), ("2024-01-02", 1)}
    assert key(ks.kpis(t.read(spark))) == key(tm.minute_kpis(telemetry(spark, rows)))
    after = t.snapshot(spark).parts
    assert {p for p in before if before[p] != after[p]} == {"2024-01-02"}
    assert ks.reconcile(t, archive, lambda x: x, run_id=20240103).count() == 0


def test_the_recomputation_prunes_by_literals(spark):
    archive = _archive(spark, [random_rows(4, 200)])
    t = table(spark)
    t.commit(ks.minute_states(telemetry(spark, [r for r in random_rows(4, 200) if not 3600 <= r[2] < 7200])), 0)
    differing = ks.differing_windows(archive.digests(), t.read(spark))
    fixes = ks.recomputed(archive, differing, lambda x: x)
    plan = fixes._jdf.queryExecution().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line and "/rows" in line]
    assert filters and all("event_date" in f.split("PartitionFilters")[1] and "event_hour" in f.split("PartitionFilters")[1] for f in filters)


def test_equal_counts_of_other_events_differ(spark):
    archive = _archive(spark, [[(1, 1, 5, "a", 1.0), (2, 2, 6, "a", 1.0)]])
    t = table(spark)
    t.commit(ks.minute_states(telemetry(spark, [(1, 1, 5, "a", 1.0), (1, 1, 5, "a", 1.0)])), 0)
    ks.reconcile(t, archive, lambda x: x, 1)
    assert [r.active_vehicles for r in ks.kpis(t.read(spark)).collect()] == [2]


def test_reconcile_fills_an_empty_table(spark):
    rows = random_rows(5, 100, days=1)
    t = table(spark)
    ks.reconcile(t, _archive(spark, [rows]), lambda x: x, 1)
    assert key(ks.kpis(t.read(spark))) == key(tm.minute_kpis(telemetry(spark, rows)))


# -- offsets ------------------------------------------------------------------


def records(spark, offsets):
    return spark.createDataFrame([("t", p, o) for p, o in offsets], "topic string, partition int, offset long")


def test_runs_gaps_and_overlaps_equal_sets(spark, monkeypatch):
    monkeypatch.setattr(ar, "OFFSET_BLOCK", 16)
    rng = random.Random(8)
    batches = [[(p, o) for p in (0, 1) for o in rng.sample(range(100), 60)] for _ in range(3)]
    ranges = None
    for b in batches:
        runs = ar.offset_runs(records(spark, b + b[:5]))
        assert sum(r.copies for r in runs.collect()) == 5
        ranges = runs if ranges is None else ranges.unionByName(runs)
    seen = {p: sorted({o for b in batches for q, o in b if q == p}) for p in (0, 1)}
    merged = {p: [] for p in seen}
    for r in ar.merge_ranges(ranges).orderBy("partition", "start").collect():
        merged[r.partition] += range(r.start, r.end + 1)
    assert merged == seen
    missing = {p: [] for p in seen}
    for r in ar.gaps(ranges).orderBy("partition", "gap_start").collect():
        assert r.missing == r.gap_end - r.gap_start + 1
        missing[r.partition] += range(r.gap_start, r.gap_end + 1)
    assert missing == {p: sorted(set(range(s[0], s[-1])) - set(s)) for p, s in seen.items()}
    twice = {p: [] for p in seen}
    for r in ar.overlaps(ranges).collect():
        twice[r.partition] += range(r.start, r.end + 1)
    counts = {p: [o for o in seen[p] if sum((p, o) in b for b in batches) > 1] for p in seen}
    assert {p: sorted(v) for p, v in twice.items()} == counts


def test_gaps_from_an_expected_first_offset(spark):
    runs = ar.offset_runs(records(spark, [(0, 5), (0, 6), (0, 9)]))
    got = [(r.gap_start, r.gap_end) for r in ar.gaps(runs, F.lit(2)).orderBy("gap_start").collect()]
    assert got == [(2, 4), (7, 8)]
    assert ar.gaps(runs.limit(0)).count() == 0
