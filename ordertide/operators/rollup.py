"""Roll up by minute and country, and answer coarser questions from the roll-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.functions.scalars import (
    MINUTE_MS,
    is_calendar_time,
    ntz_from_millis,
    ntz_literal,
    timestamp_from_millis,
    truncate_millis,
    truncate_ntz_hour,
)
from ordertide.operators.filters import in_interval

TXN_METRICS = ("gmv", "gmv_usd")


def rollup_minute(
    df: DataFrame,
    metrics: Sequence[str] = TXN_METRICS,
    dimensions: Sequence[str] = ("country",),
    event_time: str = "event_time",
    delay: str = "1 hour",
) -> DataFrame:
    """``count`` and the sum of each metric per (minute, dimensions); ``minute_ts`` is UTC.

    On a stream the minute is a tumbling window that is emitted once the watermark has passed it.
    Rows whose time has no calendar date are left out in both modes; ``far_times`` gives them.
    """
    df = df.where(F.coalesce(is_calendar_time(event_time), F.lit(True)))
    aggs = [F.count(F.lit(1)).alias("count"), *[F.sum(m).alias(m) for m in metrics]]
    if df.isStreaming:
        df = df.withColumn("__ts", timestamp_from_millis(event_time)).withWatermark("__ts", delay)
        grouped = df.groupBy(F.window("__ts", "1 minute").alias("__w"), *dimensions).agg(*aggs)
        minute = F.unix_millis(F.col("__w.start"))
    else:
        grouped = df.groupBy(truncate_millis(event_time, MINUTE_MS).alias("__w"), *dimensions).agg(*aggs)
        minute = F.col("__w")
    return grouped.select(ntz_from_millis(minute).alias("minute_ts"), *dimensions, "count", *metrics)


def far_times(df: DataFrame, event_time: str = "event_time") -> DataFrame:
    """The rows that a roll-up leaves out: their time is outside the years 1 to 9999."""
    return df.where(~is_calendar_time(event_time))


def with_hour(rollup: DataFrame) -> DataFrame:
    """Add the partition column of the stored roll-up: its hour."""
    return rollup.withColumn("hour", truncate_ntz_hour("minute_ts"))


def hourly_totals(
    rollup: DataFrame,
    start,
    end,
    metrics: Sequence[str] = TXN_METRICS,
    dimensions: Sequence[str] = ("country",),
) -> DataFrame:
    """Totals per (hour, dimensions) of the roll-up rows in ``[start, end)``.

    Stored partial counts are summed as doubles, like every other metric. ``start`` and ``end`` are
    UTC wall-clock values. On a roll-up stored by hour they also prune partitions.
    """
    rows = in_interval(rollup, start, end, "minute_ts")
    if "hour" in rollup.columns:
        rows = rows.where(
            F.col("hour").between(
                truncate_ntz_hour(ntz_literal(start)),
                truncate_ntz_hour(ntz_literal(end)),
            )
        )
    hour = truncate_ntz_hour("minute_ts").alias("hour_ts")
    return rows.groupBy(hour, *dimensions).agg(
        F.sum("count").cast("double").alias("count"), *[F.sum(m).alias(m) for m in metrics]
    )


def country_totals(rollup: DataFrame) -> DataFrame:
    """Order totals per country."""
    return rollup.groupBy("country").agg(
        F.sum("gmv").alias("gmv_sum"),
        F.sum("gmv_usd").alias("gmv_usd_sum"),
        F.sum("count").alias("order_count"),
    )


def country_user_totals(rollup: DataFrame) -> DataFrame:
    """User totals per country."""
    return rollup.groupBy("country").agg(F.sum("count").alias("user_count"))


def reaggregate(
    rollup: DataFrame, keys: Sequence, metrics: Sequence[str] = TXN_METRICS
) -> DataFrame:
    """Roll a roll-up up further: partial counts and sums are summed, rows are never counted again."""
    return rollup.groupBy(*keys).agg(
        F.sum("count").alias("count"), *[F.sum(m).alias(m) for m in metrics]
    )
