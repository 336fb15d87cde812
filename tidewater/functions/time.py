"""Time helpers. Sessions run in UTC (see ``tidewater.session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_millis_to_ts(col: Column | str) -> Column:
    """Epoch milliseconds -> timestamp without a floating-point step."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_millis(c.cast("long"))


def to_event_time(col: Column | str) -> Column:
    """Session-zone timestamp (watermarks refuse TIMESTAMP_NTZ)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp")


def to_ntz(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp_ntz")


def ntz_literal(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


OPEN_END = "9999-12-31 00:00:00"
