"""Event telemetry: alerts (P5-P7, U1), minute KPIs (A2-A4, P8, A9), recent
range (P9), late-data reconciliation (T4, T5). The same functions run on a
batch DataFrame and on a streaming one.

Stand-in mapping on the driver's ``events`` table (FIXTURES.md part C):
user_id -> vehicle_id, event_type -> geofence (``view`` means outside any
zone), value -> speed, ``error`` -> harsh braking, props.k / 10 ->
acceleration.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.time import epoch_millis_to_ts
from tidewater.sources.wire import JSON_TIME_OPTIONS

from tidewater.operators.upsert import upsert
from tidewater.session import stage

SPEED_LIMIT_KPH = 50.0
NO_GEOFENCE = "__none__"
HARSH_BRAKING = "HARSH_BRAKING"
GEOFENCE_SPEED = "GEOFENCE_SPEED"
KPI_KEYS = ["window_start", "geofence_id"]


# Vehicle telemetry payload (the wire schema of the event stream).
VEHICLE_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("vehicle_id", T.StringType(), False),
    T.StructField("driver_id", T.StringType(), True),
    T.StructField("event_ts_ms", T.LongType(), False),
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
    T.StructField("speed_kph", T.FloatType(), False),
    T.StructField("heading_deg", T.FloatType(), False),
    T.StructField("acceleration_ms2", T.FloatType(), False),
    T.StructField("engine_rpm", T.IntegerType(), False),
    T.StructField("fuel_level_pct", T.FloatType(), False),
    T.StructField("odometer_km", T.DoubleType(), False),
    T.StructField("harsh_braking", T.BooleanType(), False),
    T.StructField("geofence_id", T.StringType(), True),
    T.StructField("schema_version", T.IntegerType(), False),
])


def telemetry_from_vehicles(decoded: DataFrame) -> DataFrame:
    """Decoded vehicle payloads -> telemetry columns; epoch millis become an
    event timestamp without a floating-point step."""
    return decoded.select(
        "event_id", "vehicle_id", "driver_id",
        epoch_millis_to_ts("event_ts_ms").alias("event_ts"),
        "geofence_id",
        F.col("speed_kph").cast("double").alias("speed_kph"),
        "harsh_braking",
        F.col("acceleration_ms2").cast("double").alias("acceleration_ms2"),
        "latitude", "longitude",
    )


def telemetry_from_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id"),
        F.col("user_id").alias("vehicle_id"),
        F.col("ts").alias("event_ts"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("geofence_id"),
        F.col("value").alias("speed_kph"),
        (F.col("event_type") == "error").alias("harsh_braking"),
        (F.get_json_object("props", "$.k").cast("double") / 10.0).alias("acceleration_ms2"),
        F.concat(F.lit("D"), (F.col("user_id") % 97).cast("string")).alias("driver_id"),
        (F.col("user_id") % 90).cast("double").alias("latitude"),
        (F.col("event_id") % 180).cast("double").alias("longitude"),
    )


# --------------------------------------------------------------------------
# Alerts
# --------------------------------------------------------------------------

ALERT_COLUMNS = ["event_id", "vehicle_id", "driver_id", "event_ts", "alert_type", "acceleration_ms2", "speed_kph",
                 "latitude", "longitude"]


def detect_alerts(telemetry: DataFrame, speed_limit: float = SPEED_LIMIT_KPH) -> DataFrame:
    """Both rules in one scan: an event may raise both alert types.

    Equivalent to the union of the two filtered branches (UNION ALL), but the
    source is read once. Rules are NULL-safe: an unknown flag or speed raises
    nothing; the speed rule is strict (> limit).
    """
    braking = F.when(F.col("harsh_braking"), F.lit(HARSH_BRAKING))
    speeding = F.when(
        F.col("geofence_id").isNotNull() & (F.col("speed_kph") > F.lit(speed_limit)), F.lit(GEOFENCE_SPEED)
    )
    fired = telemetry.withColumn("alert_type", F.explode(F.array_compact(F.array(braking, speeding))))
    return fired.select(*ALERT_COLUMNS)


def alert_messages(alerts: DataFrame) -> DataFrame:
    """Keyed sink records: key ``vehicle|type|event`` and the JSON row
    (timestamps with full microsecond precision)."""
    return alerts.select(
        F.concat_ws("|", F.col("vehicle_id").cast("string"), F.col("alert_type"), F.col("event_id").cast("string")).alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in alerts.columns]), JSON_TIME_OPTIONS).alias("value"),
    )


# --------------------------------------------------------------------------
# Minute KPIs
# --------------------------------------------------------------------------


def minute_kpis(telemetry: DataFrame, exact_distinct: bool = True, width: str = "1 minute",
                ts_col: str = "event_ts") -> DataFrame:
    """KPIs per (tumbling window, geofence); NULL geofence grouped as ``__none__``."""
    distinct = (
        F.count_distinct("vehicle_id") if exact_distinct else F.approx_count_distinct("vehicle_id")
    )
    return (
        telemetry.withColumn("geofence_id", F.coalesce(F.col("geofence_id"), F.lit(NO_GEOFENCE)))
        .groupBy(F.window(ts_col, width).alias("window"), "geofence_id")
        .agg(
            distinct.alias("active_vehicles"),
            F.avg("speed_kph").alias("avg_speed_kph"),
            F.max("speed_kph").alias("max_speed_kph"),
            F.sum(F.col("harsh_braking").cast("int")).cast("long").alias("harsh_braking_events"),
            F.count(F.lit(1)).alias("total_events"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "geofence_id", "active_vehicles", "avg_speed_kph", "max_speed_kph",
            "harsh_braking_events", "total_events",
        )
    )


def recent_kpis(kpis: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """KPIs of the last ``hours`` before ``as_of`` (a literal or a column)."""
    edge = (as_of if isinstance(as_of, Column) else F.lit(as_of)) - F.expr(f"INTERVAL {hours} HOURS")
    return kpis.where(F.col("window_start") >= edge)


def recent_minute_kpis(telemetry: DataFrame, as_of, hours: int = 24, ts_col: str = "event_ts",
                       exact_distinct: bool = True) -> DataFrame:
    """P9 over raw events: ``window_start >= edge`` implies ``ts >= edge``, so
    that bound is applied to the events first (pushed into the scan, old
    row groups and partitions are skipped), then the exact window filter."""
    lit = as_of if isinstance(as_of, Column) else F.lit(as_of)
    edge = lit - F.expr(f"INTERVAL {hours} HOURS")
    recent = telemetry.where(F.col(ts_col) >= edge)
    return recent_kpis(minute_kpis(recent, exact_distinct, ts_col=ts_col), as_of, hours)


def max_event_time(df: DataFrame, ts_col: str):
    return df.agg(F.max(ts_col).alias("m")).first()["m"]


def events_per_minute(telemetry: DataFrame, ts_col: str = "event_ts") -> DataFrame:
    return telemetry.groupBy(F.window(ts_col, "1 minute").alias("w")).agg(
        F.count(F.lit(1)).alias("events")
    ).select(F.col("w.start").alias("window_start"), "events")


def alerts_per_minute(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy(F.window("event_ts", "1 minute").alias("w"), "alert_type").agg(
        F.count(F.lit(1)).alias("alerts")
    ).select(F.col("w.start").alias("window_start"), "alert_type", "alerts")


# --------------------------------------------------------------------------
# Late data and reconciliation
# --------------------------------------------------------------------------


def affected_windows(archive_kpis: DataFrame, emitted: DataFrame) -> DataFrame:
    """Windows whose event count in the archive differs from what was emitted
    (late rows dropped by the watermark, windows never closed)."""
    e = emitted.select(*KPI_KEYS, F.col("total_events").alias("_emitted"))
    joined = archive_kpis.select(*KPI_KEYS, "total_events").join(e, KPI_KEYS, "left")
    return joined.where(~F.col("_emitted").eqNullSafe(F.col("total_events"))).select(*KPI_KEYS)


def reconcile_kpis(emitted: DataFrame, archive_telemetry: DataFrame) -> DataFrame:
    """Recompute the affected windows from the archive and upsert them. This
    reads all of the archive once; ``plans/kpi_state.py`` reconciles a stored
    table from the archive partitions that differ."""
    archive_kpis = stage(minute_kpis(archive_telemetry), "reconcile-kpis")
    fixes = archive_kpis.join(affected_windows(archive_kpis, emitted), KPI_KEYS, "left_semi")
    return upsert(emitted, fixes, KPI_KEYS, null_safe=True, check_unique=False)


def late_rows(archive_telemetry: DataFrame, emitted: DataFrame, ts_col: str = "event_ts") -> DataFrame:
    """Archive rows that fall in windows the stream emitted with fewer events."""
    cols = archive_telemetry.columns
    wins = archive_telemetry.select(
        *cols,
        F.window(ts_col, "1 minute").start.alias("_w"),
        F.coalesce(F.col("geofence_id"), F.lit(NO_GEOFENCE)).alias("_g"),
    )
    short = affected_windows(minute_kpis(archive_telemetry), emitted).select(
        F.col("window_start").alias("_w"), F.col("geofence_id").alias("_g")
    )
    return wins.join(short, ["_w", "_g"], "left_semi").select(*cols)
