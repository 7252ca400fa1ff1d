"""Event-time and processing-time columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.functions.scalars import second_to_millisecond, timestamp_from_millis

JOB_DELAY = "1440 minutes"
ROWTIME_DELAY = "60 minutes"


def with_event_time(df: DataFrame, column: str, delay: str | None, out: str = "event_ts") -> DataFrame:
    """Add the TIMESTAMP of ``column`` (seconds or ms) and, with a delay, the watermark on it."""
    df = df.withColumn(out, timestamp_from_millis(second_to_millisecond(column)))
    return df.withWatermark(out, delay) if delay else df


def with_time_attributes(df: DataFrame, event_time: str | None = None, delay: str | None = None) -> DataFrame:
    """Add ``proctime`` and, when an event-time column is named, ``<column>_rowtime``."""
    df = df.withColumn("proctime", F.current_timestamp())
    return with_event_time(df, event_time, delay, f"{event_time}_rowtime") if event_time else df
