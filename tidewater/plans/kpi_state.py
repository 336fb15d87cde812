"""Minute KPIs as mergeable states (A2, A3, T5).

A state holds sums, counts and a HyperLogLog sketch instead of averages and
distinct counts, so states of the same window can be merged: minutes roll up to
hours, late rows are added without reading the others again, and every distinct
count of a table comes from a sketch of the same kind. ``digest`` sums 32 bits
of each event's hash: with ``total_events`` it tells whether two states saw the
same events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.plans.telemetry import KPI_KEYS, NO_GEOFENCE

#: 2**12 registers: a standard error of 1.6 %; three of them bound an estimate.
SKETCH_K = 12
SKETCH_ERROR = 3 * 1.04 / (2**SKETCH_K) ** 0.5
STATE_COLUMNS = ["window_start", "window_end", "geofence_id", "vehicles", "speed_sum", "speed_count", "max_speed_kph",
                 "harsh_braking_events", "total_events", "digest"]


def event_digest() -> Column:
    """32 bits of a hash of the event, so that sums stay far from overflow."""
    return F.xxhash64("event_id", "vehicle_id", "speed_kph").bitwiseAND(F.lit(0xFFFFFFFF))


def _windowed(df: DataFrame, ts_col: str, width: str, *aggregates: Column) -> DataFrame:
    return (df.groupBy(F.window(ts_col, width).alias("_w"), "geofence_id").agg(*aggregates)
            .withColumn("window_start", F.col("_w.start")).withColumn("window_end", F.col("_w.end")).select(*STATE_COLUMNS))


def minute_states(telemetry: DataFrame, width: str = "1 minute", ts_col: str = "event_ts") -> DataFrame:
    """One state per (tumbling window, geofence); on a batch or a stream."""
    named = telemetry.withColumn("geofence_id", F.coalesce(F.col("geofence_id"), F.lit(NO_GEOFENCE)))
    return _windowed(
        named, ts_col, width,
        F.hll_sketch_agg("vehicle_id", F.lit(SKETCH_K)).alias("vehicles"),
        F.sum("speed_kph").alias("speed_sum"), F.count("speed_kph").alias("speed_count"), F.max("speed_kph").alias("max_speed_kph"),
        F.sum(F.col("harsh_braking").cast("int")).cast("long").alias("harsh_braking_events"),
        F.count(F.lit(1)).alias("total_events"), F.sum(event_digest()).alias("digest"))


def roll_up(states: DataFrame, width: str = "1 minute") -> DataFrame:
    """Merge states into windows of ``width`` (a multiple of theirs); with their
    own width, states of the same window become one."""
    return _windowed(
        states, "window_start", width,
        F.hll_union_agg("vehicles").alias("vehicles"),
        F.sum("speed_sum").alias("speed_sum"), F.sum("speed_count").alias("speed_count"), F.max("max_speed_kph").alias("max_speed_kph"),
        F.sum("harsh_braking_events").alias("harsh_braking_events"), F.sum("total_events").alias("total_events"),
        F.sum("digest").alias("digest"))


def kpis(states: DataFrame) -> DataFrame:
    """The KPI columns; ``active_vehicles`` is the sketch's estimate."""
    return states.select(
        "window_start", "window_end", "geofence_id", F.hll_sketch_estimate("vehicles").alias("active_vehicles"),
        (F.col("speed_sum") / F.nullif(F.col("speed_count"), F.lit(0))).alias("avg_speed_kph"), "max_speed_kph",
        "harsh_braking_events", "total_events")


def within_bound(estimate: Column, exact: Column) -> Column:
    """Whether a sketch's estimate is as near as its size promises."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * SKETCH_ERROR)


def add_late(table, late: DataFrame, batch_id: int) -> int:
    """Merge late rows into a ``VersionedTable`` of states: their states are
    united with those of the same windows, read from the dates they touch; no
    event is counted again. Returns the version."""
    spark = late.sparkSession
    fresh = minute_states(late)
    dates = [str(r[0]) for r in late.select(F.to_date("event_ts").alias("d")).distinct().collect()]  # days, not rows
    held = table.read(spark, parts=dates)
    if held is not None:
        fresh = roll_up(held.join(fresh.select(*KPI_KEYS), KPI_KEYS, "left_semi").unionByName(fresh))
    return table.commit(fresh, batch_id, "late")


# --------------------------------------------------------------------------
# Reconciliation from the archive
# --------------------------------------------------------------------------


def differing_windows(digests: DataFrame, emitted: DataFrame) -> DataFrame:
    """``event_date, event_hour`` and keys of the archive's windows that a table
    of states lacks or that it built from other events."""
    held = emitted.select(*KPI_KEYS, F.col("total_events").alias("_n"), F.col("digest").alias("_d"))
    both = digests.join(held, KPI_KEYS, "left")
    same = F.col("_n").eqNullSafe(F.col("events")) & F.col("_d").eqNullSafe(F.col("digest"))
    return both.where(~same).select("event_date", "event_hour", *KPI_KEYS)


def reconcile(table, archive, to_telemetry, run_id: int) -> DataFrame:
    """Recompute what the stream lost and upsert it; returns the differing
    windows (staged).

    The archive's digests are compared with the table's states; only archive
    partitions that hold a differing window are read, by literal dates and hours,
    and only these windows' states are written. Windows that the archive does not
    hold stay as they are. ``run_id`` names the run: a repeated one changes
    nothing."""
    from tidewater.session import stage

    spark = archive.spark
    emitted = table.read(spark)
    digests = archive.digests()
    if emitted is None:
        differing = digests.select("event_date", "event_hour", *KPI_KEYS)
    else:
        differing = differing_windows(digests, emitted)
    differing = stage(differing, "reconcile-windows")
    fixes = recomputed(archive, differing, to_telemetry)
    if fixes is not None:
        table.commit(fixes, run_id, "reconcile")
    return differing


def recomputed(archive, differing: DataFrame, to_telemetry) -> DataFrame | None:
    """States of the differing windows from the archive partitions they lie in."""
    hours = differing.select("event_date", "event_hour").distinct().collect()  # archive partitions, not rows
    if not hours:
        return None
    rows = archive.rows(sorted({r["event_date"] for r in hours}), sorted({r["event_hour"] for r in hours}))
    return minute_states(to_telemetry(rows)).join(differing.select(*KPI_KEYS), KPI_KEYS, "left_semi")
