"""The three order jobs, each one plan for tables and for streams.

records -> decode -> project -> today -> first per key -> rates -> output columns.
Only the de-duplication and the sink differ between a table and a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ordertide.functions.scalars import (
    DEFAULT_TZ,
    business_key,
    currency_to_country,
    event_date,
    processing_millis,
    second_to_millisecond,
)
from ordertide.functions.sql import register_functions
from ordertide.operators.decode import decode_orders, encode_json
from ordertide.operators.dedup import first_per_key
from ordertide.operators.filters import paid_only, today
from ordertide.operators.rates import enrich_usd, prepare_rates
from ordertide.sinks.streams import Sink, folder_sink, sink_from, to_sink
from ordertide.streaming import dedup as stream_dedup
from ordertide.streaming.event_time import JOB_DELAY, ROWTIME_DELAY, with_event_time
from ordertide.streaming.rates import RateSnapshot
from ordertide.streaming.seen_keys import SeenKeys, to_sink_once

TXN_COLUMNS = ("gmv", "order_id", "user_id", "country", "event_time", "processing_time", "gmv_usd")
USER_COLUMNS = ("user_id", "country", "event_time", "processing_time", "event_date")
ORDER_VIEW = "order_tab"


def txn_projection(orders: DataFrame, tz: str = DEFAULT_TZ, keep: Sequence[str] = ()) -> DataFrame:
    """Paid orders with their country and their event time in milliseconds."""
    return paid_only(orders).select(
        "gmv",
        "order_id",
        "user_id",
        currency_to_country("currency").alias("country"),
        second_to_millisecond(F.coalesce("create_time", F.lit(0))).alias("event_time"),
        *keep,
    )


def user_projection(orders: DataFrame, tz: str = DEFAULT_TZ, keep: Sequence[str] = ()) -> DataFrame:
    """Paid orders as visits: user, country, event time and local day."""
    txn = txn_projection(orders, tz, keep)
    return txn.select(
        "user_id", "country", "event_time", event_date("event_time", tz).alias("event_date"), *keep
    )


def publish(df: DataFrame, name: str = ORDER_VIEW, fields: Sequence[str] | None = None) -> DataFrame:
    """Expose a DataFrame (or some of its columns) to SQL under ``name``."""
    df = df.select(*fields) if fields else df
    df.createOrReplaceTempView(name)
    return df


@dataclass(frozen=True)
class Job:
    """What one job does with decoded orders; how it runs is up to ``batch`` and ``stream``."""

    name: str
    projection: Callable[..., DataFrame]
    keys: tuple[str, ...]
    columns: tuple[str, ...]
    on_error: str = "fallback"
    enrich: bool = False
    dedup: str = "forever"
    ttl_ms: int = stream_dedup.DAY_MS
    watermark: str | None = None
    order_by: tuple[str, ...] = ("event_time",)
    parse: Callable[[DataFrame], DataFrame] | None = None

    def prepare(
        self,
        records: DataFrame,
        as_of: int | None,
        tz: str,
        keep: Sequence[str] = (),
        time_filter: bool = True,
        watermark: bool = True,
        observe=None,
    ) -> DataFrame:
        """Decode, project and cut to the day: everything that needs no other row.

        The watermark only tracks the event time of orders. The projection leaves its column out, so
        de-duplication drops no late row. ``observe`` counts records and malformed ones (``decode_orders``).
        """
        if self.parse:
            orders = self.parse(records)
        else:
            orders = decode_orders(records, self.on_error, keep=keep, observe=observe)
        if orders.isStreaming and self.watermark and watermark:
            orders = with_event_time(orders, "create_time", self.watermark)
        rows = self.projection(orders, tz, keep)
        return today(rows, as_of, tz) if time_filter else rows

    def finish(
        self,
        rows: DataFrame,
        rates: DataFrame | RateSnapshot | None,
        as_of: int | None,
        tz: str,
        rate_date: str = "processing",
    ) -> DataFrame:
        """Add rates and processing time to the rows that are left, and order the columns."""
        if self.enrich:
            snapshot = isinstance(rates, RateSnapshot)
            rates = rates.current() if snapshot else rates
            rows = enrich_usd(rows, rates, rate_date, as_of, tz, prepared=snapshot)
        return rows.withColumn("processing_time", processing_millis(as_of)).select(*self.columns)

    def batch(
        self,
        records: DataFrame,
        rates: DataFrame | None = None,
        as_of: int | None = None,
        tz: str = DEFAULT_TZ,
        rate_date: str = "processing",
        arrival: Sequence[str] = (),
        time_filter: bool = True,
    ) -> DataFrame:
        """Run on a bounded table. The first row of a key is the least by ``arrival`` (columns of
        ``records``), or by event time and then by the other columns when none is given."""
        rows = self.prepare(records, as_of, tz, arrival, time_filter)
        order = list(arrival) or [*self.order_by]
        return self.finish(first_per_key(rows, self.keys, order), rates, as_of, tz, rate_date)

    def stream(
        self,
        records: DataFrame,
        as_of: int | None = None,
        tz: str = DEFAULT_TZ,
        time_filter: bool = True,
        collapse: bool = True,
        watermark: bool = True,
        observe: str | None = None,
    ) -> DataFrame:
        """The stream up to and including the de-duplication; ``write`` adds rates per micro-batch.

        A stream can have one watermark: pass ``watermark=False`` when a roll-up follows, which sets
        its own.
        """
        rows = self.prepare(records, as_of, tz, time_filter=time_filter, watermark=watermark, observe=observe)
        if self.dedup == "ttl":
            return stream_dedup.with_ttl(rows, self.keys, self.ttl_ms, collapse=collapse)
        return stream_dedup.forever(rows, self.keys, collapse=collapse)

    def write(
        self,
        records: DataFrame,
        path: str | None = None,
        checkpoint: str = "",
        rates: RateSnapshot | None = None,
        trigger: str | None = None,
        as_of: int | None = None,
        tz: str = DEFAULT_TZ,
        rate_date: str = "processing",
        time_filter: bool = True,
        fmt: str = "parquet",
        sink: Sink | dict[str, str] | None = None,
        seen: SeenKeys | None = None,
        arrival: Sequence[str] = (),
        observe: str | None = None,
    ) -> DataStreamWriter:
        """The whole stream job into ``sink``, or into replay-safe micro-batch folders below ``path``.

        A sink may be given by its options (``sink_from``). With ``seen`` the job de-duplicates for ever
        against that table and keeps no state; the first row of a key in a batch is then the least by
        ``arrival``. ``observe`` names the counts of malformed records (``BatchMetrics``).
        """
        if (path is None) == (sink is None):
            raise ValueError("a job writes either to a path or to a sink")
        if isinstance(sink, dict):
            sink = sink_from(sink, self.keys)
        sink = sink or folder_sink(path, fmt)

        def finish(batch: DataFrame) -> DataFrame:
            return self.finish(batch, rates, as_of, tz, rate_date)

        if seen:
            rows = self.prepare(records, as_of, tz, arrival, time_filter, watermark=False, observe=observe)
            return to_sink_once(rows, checkpoint, seen, list(arrival) or self.order_by, sink, trigger, finish)
        rows = self.stream(records, as_of, tz, time_filter, observe=observe)
        return to_sink(rows, checkpoint, sink, trigger, finish)


TXN = Job(
    name="txn",
    projection=txn_projection,
    keys=("country", "order_id"),
    columns=TXN_COLUMNS,
    on_error="fallback",
    enrich=True,
    watermark=JOB_DELAY,
    order_by=("event_time", "user_id", "gmv"),
)
TXN_USER = Job(
    name="txn_user",
    projection=user_projection,
    keys=("country", "user_id", "event_date"),
    columns=USER_COLUMNS,
    on_error="drop",
)
TXN_TTL = Job(
    name="txn_ttl",
    projection=txn_projection,
    keys=("country", "order_id"),
    columns=TXN_COLUMNS,
    on_error="fail",
    enrich=True,
    dedup="ttl",
    watermark=ROWTIME_DELAY,
    order_by=("event_time", "user_id", "gmv"),
)
JOBS = {job.name: job for job in (TXN, TXN_USER, TXN_TTL)}


def run_job(name: str, records: DataFrame, **options) -> DataFrame | DataStreamWriter:
    """Run a job by name: on a table it gives the result, on a stream the unstarted writer."""
    job = JOBS[name]
    return job.write(records, **options) if records.isStreaming else job.batch(records, **options)


def output_records(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Result rows as output records: event time, JSON value (nulls kept) and business key."""
    return encode_json(
        rows.withColumn("rowkey", business_key(*keys)),
        *rows.columns,
        keep_nulls=True,
        keep=("event_time", "rowkey"),
    )


def run_sql(
    spark: SparkSession,
    sql: str,
    orders: DataFrame,
    rates: DataFrame | None = None,
    view: str = ORDER_VIEW,
    tz: str = DEFAULT_TZ,
    tolerance_days: int = 1,
) -> DataFrame:
    """A job written as SQL text over the decoded orders, published as ``view``.

    The scalar functions are registered, and with ``rates`` also
    ``get_exchange_rate(country, date)``.
    """
    publish(orders, view)
    rates_view = None
    if rates is not None:
        rates_view = f"{view}_rates"
        publish(prepare_rates(rates, tolerance_days), rates_view)
    register_functions(spark, tz, rates_view)
    return spark.sql(sql)
