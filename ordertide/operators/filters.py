"""Time filters. Bounds fold to literals, so they reach the scan when the column is stored."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.functions.scalars import DEFAULT_TZ, HOUR_MS, day_bounds, now_millis, ntz_literal


def paid_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("order_status") == "paid")


def today(
    df: DataFrame, as_of: int | None = None, tz: str = DEFAULT_TZ, event_time: str = "event_time"
) -> DataFrame:
    """Rows whose event time (ms) lies in the current local day; the day moves with the clock."""
    start, end = day_bounds(now_millis(as_of), tz)
    return df.where((F.col(event_time) >= start) & (F.col(event_time) < end))


def in_interval(df: DataFrame, start, end, column: str) -> DataFrame:
    """Rows with ``start <= column < end``; datetimes without zone are UTC wall-clock values."""
    start, end = (ntz_literal(b) if isinstance(b, datetime) else b for b in (start, end))
    return df.where((F.col(column) >= start) & (F.col(column) < end))


def reject_late(
    df: DataFrame, as_of: int | None = None, period_ms: int = HOUR_MS, event_time: str = "event_time"
) -> DataFrame:
    """Leave out rows older than ``period_ms`` before the clock."""
    return df.where(F.col(event_time) >= now_millis(as_of) - F.lit(period_ms))
