"""One query per operator, each a function (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.functions import (
    business_key,
    currency_to_country,
    date_shift,
    event_date,
    format_millis,
    ntz_from_millis,
    register_functions,
    salted_key,
    second_to_millisecond,
    truncate_millis,
)
from ordertide.functions.scalars import HOUR_MS, MINUTE_MS
from ordertide.operators import keyed_table as kv
from ordertide.operators import ordered_requests as ordered
from ordertide.operators.decode import decode_fields, decode_orders, encode_json
from ordertide.operators.dedup import first_per_key, first_unseen
from ordertide.operators.filters import in_interval, paid_only, reject_late, today
from ordertide.operators.rates import effective_rates, enrich_usd, lookup_asof, rate_day
from ordertide.operators.rollup import reaggregate, with_hour
from ordertide.operators.routing import route, tag_routes, union_sources
from ordertide.plans import reports
from ordertide.plans.jobs import (
    TXN,
    TXN_TTL,
    TXN_USER,
    output_records,
    publish,
    run_job,
    run_sql,
    txn_projection,
    user_projection,
)
from ordertide.session import scratch_path, streaming_session
from ordertide.sinks.tables import write_rollup
from ordertide.sources import record_log as log
from ordertide.sources.files import read_table, stream_table
from ordertide.streaming import dedup as stream_dedup
from ordertide.streaming.event_time import with_event_time, with_time_attributes
from ordertide.streaming.rates import RateSnapshot
from ordertide.streaming.run import drain_to_table
from registry import feed

# 2024-01-16 12:00 in Singapore.
AS_OF = 1705377600000
# One local day, as UTC wall-clock values.
DAY_START = datetime(2024, 1, 15, 16)
DAY_END = datetime(2024, 1, 16, 16)
# 2024-01-15 00:00 UTC, in seconds.
SEEK_TIME = 1705276800
# 2024-01-02 00:00 UTC.
SEEN_MS = 1704153600000


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events")


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return feed.orders_from_events(_events(spark, sf))


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return feed.as_records(_orders(spark, sf))


def _dirty(spark: SparkSession, sf: str) -> DataFrame:
    return feed.as_dirty_records(_orders(spark, sf))


def _rates(spark: SparkSession, sf: str) -> DataFrame:
    return feed.rates_from_events(_events(spark, sf))


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf).where("database = 'order'")


def _txn(spark: SparkSession, sf: str) -> DataFrame:
    """Projected paid orders with their offset, without the JSON step."""
    return txn_projection(_routed(spark, sf), keep=("offset",))


def _all_days(spark: SparkSession, sf: str) -> DataFrame:
    """The transaction job over every day, with the rates of the event days."""
    return TXN.batch(
        _records(spark, sf), _rates(spark, sf), AS_OF, rate_date="event", arrival=("offset",), time_filter=False
    )


def _all_visits(spark: SparkSession, sf: str) -> DataFrame:
    return TXN_USER.batch(_records(spark, sf), as_of=AS_OF, time_filter=False)


# --- scalar functions ---------------------------------------------------------------------------


def fn_currency_to_country(spark, sf):
    return _orders(spark, sf).select("offset", currency_to_country("currency").alias("country"))


def fn_second_to_millisecond(spark, sf):
    return _orders(spark, sf).select(
        "offset",
        second_to_millisecond("create_time").alias("ms"),
        second_to_millisecond(F.col("create_time") - 1705000000).alias("shifted_ms"),
        second_to_millisecond(F.col("create_time") + 2590000000).alias("edge_ms"),
    )


def _rate_keys(spark, sf):
    country = currency_to_country("currency")
    day = event_date(F.col("timestamp"))
    return _orders(spark, sf).select("offset", business_key(country, day).alias("key"))


def fn_salted_key(spark, sf):
    return _rate_keys(spark, sf).select("offset", salted_key("key").alias("rowkey"))


def fn_salted_key_n(spark, sf):
    return _rate_keys(spark, sf).select("offset", salted_key("key", 5).alias("rowkey"))


def fn_date_shift(spark, sf):
    day = F.date_format("ts", "yyyy-MM-dd")
    return _events(spark, sf).select(
        "event_id", date_shift(day, -1).alias("day_before"), date_shift(day, 31).alias("month_later")
    )


def fn_event_date(spark, sf):
    return _orders(spark, sf).select(
        "offset",
        event_date(F.col("timestamp")).alias("local_day"),
        event_date(F.col("timestamp"), "UTC").alias("utc_day"),
    )


def fn_business_key(spark, sf):
    return _txn(spark, sf).select("offset", business_key("country", "order_id").alias("rowkey"))


def fn_format_millis(spark, sf):
    return _orders(spark, sf).select("offset", format_millis(F.col("timestamp")).alias("local_time"))


def fn_truncate_time(spark, sf):
    return _orders(spark, sf).select(
        "offset",
        truncate_millis("timestamp", MINUTE_MS).alias("minute_ms"),
        ntz_from_millis(truncate_millis("timestamp", HOUR_MS)).alias("hour_ts"),
    )


def fn_sql_functions(spark, sf):
    session = spark.newSession()
    register_functions(session)
    publish(_orders(session, sf), "order_tab")
    return session.sql(
        """
        SELECT offset,
               currency_to_country(currency) AS country,
               second_to_millisecond(create_time) AS event_time,
               salted_key(currency_to_country(currency)) AS salted,
               salted_key_n(currency, 3) AS salted_n,
               date_shift(event_day(second_to_millisecond(create_time)), -1) AS day_before
        FROM order_tab
        """
    )


# --- decode, route, filter, project ---------------------------------------------------------------


def parse_fallback(spark, sf):
    return decode_orders(_dirty(spark, sf), "fallback", keep=("offset",))


def parse_drop(spark, sf):
    return decode_orders(_dirty(spark, sf), "drop", keep=("offset",))


def parse_fail(spark, sf):
    return decode_orders(_records(spark, sf), "fail", keep=("offset",))


def parse_bad_counts(spark, sf):
    flagged = decode_orders(_dirty(spark, sf), "flag", keep=("topic",))
    return flagged.groupBy("topic").agg(
        F.count(F.lit(1)).alias("records"), F.count_if("is_bad").alias("malformed")
    )


def route_by_database(spark, sf):
    routes = {
        "order": F.col("database") == "order",
        "user": F.col("database") == "user",
        "paid_order": (F.col("database") == "order") & (F.col("order_status") == "paid"),
    }
    return tag_routes(_orders(spark, sf), routes).select("offset", "route")


def route_outputs(spark, sf):
    outputs = route(_orders(spark, sf), {"order": F.col("database") == "order", "user": F.col("database") == "user"})
    whole = [o.select(F.lit(name).alias("output"), "offset", "user_id", "order_status") for name, o in outputs.items()]
    return union_sources(*whole)


def union_topics(spark, sf):
    events = _events(spark, sf)
    topics = route(events, {t: F.col("event_type") == t for t in ("purchase", "view", "click")})
    return union_sources(*topics.values()).select("event_id", "event_type", "value")


def filter_paid(spark, sf):
    return paid_only(_routed(spark, sf)).select("offset", "order_id", "user_id", "gmv")


def txn_project(spark, sf):
    return txn_projection(decode_orders(_records(spark, sf), "drop", keep=("offset",)), keep=("offset",))


def txn_user_project(spark, sf):
    return user_projection(decode_orders(_records(spark, sf), "drop", keep=("offset",)), keep=("offset",))


def _stored_orders(spark, sf):
    return feed.orders_from_orders(read_table(spark, sf, "orders"), read_table(spark, sf, "customer"))


def txn_project_orders(spark, sf):
    return txn_projection(_stored_orders(spark, sf))


def txn_user_project_orders(spark, sf):
    return user_projection(_stored_orders(spark, sf))


def view_fields(spark, sf):
    session = spark.newSession()
    orders = with_time_attributes(_routed(session, sf), "create_time", None)
    publish(orders, "order_tab", ["create_time", "order_id", "create_time_rowtime"])
    return session.sql(
        "SELECT order_id, create_time, unix_millis(create_time_rowtime) AS rowtime_ms FROM order_tab"
    )


# --- rates ----------------------------------------------------------------------------------------


def _enriched(spark, sf, tolerance_days):
    return lookup_asof(
        _txn(spark, sf), _rates(spark, sf), rate_day("event"), tolerance_days
    ).select("offset", "country", "rate", (F.col("gmv") * F.col("rate")).alias("gmv_usd"))


def enrich_rate_same_day(spark, sf):
    return _enriched(spark, sf, 0)


def enrich_rate_fallback(spark, sf):
    return _enriched(spark, sf, 1)


def enrich_rate_asof(spark, sf):
    return _enriched(spark, sf, 3)


def enrich_rate_missing(spark, sf):
    day = event_date("event_time")
    rows = lookup_asof(_txn(spark, sf), _rates(spark, sf), rate_day("event")).where("rate = 0.0")
    return rows.groupBy("country", day.alias("event_date")).agg(F.count(F.lit(1)).alias("n"))


def enrich_rate_processing_day(spark, sf):
    return enrich_usd(_txn(spark, sf), _rates(spark, sf), "processing", AS_OF).select("offset", "gmv_usd")


def enrich_rate_salted(spark, sf):
    """The path for a rate table beyond the broadcast bound, here forced by a bound of zero rows."""
    return lookup_asof(
        _txn(spark, sf), _rates(spark, sf), rate_day("event"), broadcast_rows=0, salts=4
    ).select("offset", "rate")


def effective_rate_table(spark, sf):
    return effective_rates(_rates(spark, sf), 1)


# --- time filters -----------------------------------------------------------------------------------


def today_filter(spark, sf):
    return today(_txn(spark, sf), AS_OF).select("offset", "order_id", "event_time")


def interval_filter(spark, sf):
    return in_interval(_events(spark, sf), DAY_START, DAY_END, "ts").select("event_id", "user_id")


def late_reject(spark, sf):
    return reject_late(_txn(spark, sf), AS_OF).select("offset", "event_time")


# --- de-duplication -----------------------------------------------------------------------------------


def dedup_order(spark, sf):
    return first_per_key(_txn(spark, sf), ["country", "order_id"], ["offset"])


def dedup_user_day(spark, sf):
    return first_per_key(
        user_projection(_routed(spark, sf)), ["country", "user_id", "event_date"], ["event_time"]
    )


def dedup_seen(spark, sf):
    """Users of the first day count as seen; later rows are judged against them."""
    txn = _txn(spark, sf)
    bound = F.lit(SEEN_MS)
    seen = txn.where(F.col("event_time") < bound).select("country", "user_id")
    rows = txn.where(F.col("event_time") >= bound)
    fresh, _ = first_unseen(rows, seen, ["country", "user_id"], ["offset"])
    return fresh.select("offset", "country", "user_id")


# --- whole jobs ------------------------------------------------------------------------------------------


def txn_job(spark, sf):
    return run_job("txn", _dirty(spark, sf), rates=_rates(spark, sf), as_of=AS_OF, arrival=("offset",))


def txn_user_job(spark, sf):
    return run_job("txn_user", _dirty(spark, sf), as_of=AS_OF)


def txn_ttl_job(spark, sf):
    return run_job("txn_ttl", _records(spark, sf), rates=_rates(spark, sf), as_of=AS_OF, arrival=("offset",))


def txn_job_all_days(spark, sf):
    return _all_days(spark, sf)


def txn_user_job_all_days(spark, sf):
    return _all_visits(spark, sf)


def txn_sql_job(spark, sf):
    """The transaction projection as SQL text, with the rate as a function of country and event day."""
    session = spark.newSession()
    orders = decode_orders(_records(session, sf), "drop", keep=("offset",))
    text = """
        WITH paid AS (
          SELECT offset, gmv, currency_to_country(currency) AS country,
                 event_day(second_to_millisecond(create_time)) AS day
          FROM order_tab
          WHERE order_status = 'paid'
        )
        SELECT offset, country, gmv * get_exchange_rate(country, day) AS gmv_usd FROM paid
    """
    return run_sql(session, text, orders, _rates(session, sf))


# --- roll-ups and reports ------------------------------------------------------------------------------------


def _money(df, *columns):
    """Sums of doubles depend on their order in the last digits, so they are compared in steps of
    0.000001. The steps begin off the decimal grid, where no sum of the data's decimals lies."""
    return df.withColumns({c: F.floor(F.col(c) * 1000000 + 0.123456789) / 1000000 for c in columns})


def rollup_minute_txn(spark, sf):
    return _money(reports.txn_rollup(_all_days(spark, sf)), "gmv", "gmv_usd")


def rollup_minute_user(spark, sf):
    return reports.user_rollup(_all_visits(spark, sf))


def rollup_late_rejected(spark, sf):
    rollup = reports.txn_rollup(_all_days(spark, sf), AS_OF, reject=True)
    return _money(rollup, "gmv", "gmv_usd")


def hourly_country_txn(spark, sf):
    rollup = reports.txn_rollup(_all_days(spark, sf))
    return _money(reports.hourly_txn(rollup, DAY_START, DAY_END), "gmv", "gmv_usd")


def hourly_country_user(spark, sf):
    return reports.hourly_users(reports.user_rollup(_all_visits(spark, sf)), DAY_START, DAY_END)


def hourly_from_stored_rollup(spark, sf):
    """The hourly question asked of a roll-up stored by hour."""
    path = scratch_path(spark, "rollup")
    write_rollup(reports.txn_rollup(_all_days(spark, sf)), path)
    stored = spark.read.parquet(path)
    stored = stored.withColumn("hour", F.col("hour").cast("timestamp_ntz"))
    return _money(reports.hourly_txn(stored, DAY_START, DAY_END), "gmv", "gmv_usd")


def total_country_txn(spark, sf):
    return _money(reports.totals_txn(reports.txn_rollup(_all_days(spark, sf))), "gmv_sum", "gmv_usd_sum")


def total_country_user(spark, sf):
    return reports.totals_users(reports.user_rollup(_all_visits(spark, sf)))


def rollup_hour_country(spark, sf):
    hourly = reaggregate(with_hour(reports.txn_rollup(_all_days(spark, sf))), ["hour", "country"])
    return _money(hourly, "gmv", "gmv_usd")


# --- encoding -----------------------------------------------------------------------------------------------


def encode_json_rows(spark, sf):
    return encode_json(_all_visits(spark, sf))


def encode_output_records(spark, sf):
    return output_records(_all_visits(spark, sf), TXN_USER.keys)


def encode_round_trip(spark, sf):
    fields = {
        "gmv": ("double", 0.0), "order_id": ("bigint", 0), "user_id": ("bigint", 0),
        "country": ("string", ""), "event_time": ("bigint", 0), "gmv_usd": ("double", 0.0),
    }
    encoded = output_records(_all_days(spark, sf), TXN.keys)
    return decode_fields(encoded, fields, keep=("rowkey",))


# --- record log ---------------------------------------------------------------------------------------------


def _log(spark, sf):
    return _orders(spark, sf).select("topic", "partition", "offset", "timestamp", F.col("order_id").alias("value"))


def log_offsets_for_time(spark, sf):
    return log.offsets_for_time(_log(spark, sf), SEEK_TIME)


def log_offsets_json(spark, sf):
    return log.offsets_json(log.offsets_for_time(_log(spark, sf), SEEK_TIME))


def log_seek(spark, sf):
    return log.seek(_log(spark, sf), [500, None, 900])


def log_seek_to_beginning(spark, sf):
    return log.seek_to_beginning(_log(spark, sf))


def log_seek_from_time(spark, sf):
    return log.seek_from_time(_log(spark, sf), SEEK_TIME)


def log_last_offset(spark, sf):
    return log.last_offsets(_log(spark, sf))


def _commits(spark, sf):
    """Each topic but one has committed up to the seek time."""
    done = _log(spark, sf).where((F.col("timestamp") < SEEK_TIME * 1000) & (F.col("topic") != "error"))
    return done.select("topic", "partition", (F.col("offset") + 1).alias("offset"))


def log_committed_offset(spark, sf):
    return log.committed_offsets(_commits(spark, sf))


def log_lag(spark, sf):
    return log.offset_lag(log.last_offsets(_log(spark, sf)), log.committed_offsets(_commits(spark, sf)))


# --- keyed table --------------------------------------------------------------------------------------------


def _table(spark, sf):
    """Customers as a keyed table; a negative balance is an absent cell."""
    return read_table(spark, sf, "customer").select(
        salted_key("c_custkey").alias("rowkey"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )


def _requests(spark, sf):
    """One request per stored order. Every second order asks for a key the table lacks."""
    new = F.concat(F.lit("n"), F.col("o_custkey"))
    key = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey").cast("string")).otherwise(new)
    return read_table(spark, sf, "orders").select(
        salted_key(key).alias("rowkey"),
        F.col("o_totalprice").alias("balance"),
        "o_orderdate", "o_orderkey", "o_orderstatus",
    )


def kv_scan(spark, sf):
    return kv.scan(_table(spark, sf), "balance")


def kv_get(spark, sf):
    keys = _requests(spark, sf).select("o_orderkey", "rowkey")
    return kv.get(keys, _table(spark, sf), "balance")


def kv_put(spark, sf):
    puts = _requests(spark, sf).select("rowkey", "balance", "o_orderdate", "o_orderkey")
    return kv.put(_table(spark, sf), puts, "balance", ["o_orderdate", "o_orderkey"])


def kv_delete_row(spark, sf):
    return kv.delete_rows(_table(spark, sf), _requests(spark, sf).where("o_orderstatus = 'F'"))


def kv_delete_column(spark, sf):
    return kv.delete_cells(_table(spark, sf), _requests(spark, sf).where("o_orderstatus = 'F'"), "balance")


def kv_put_if_absent(spark, sf):
    _, results = kv.put_if_absent(_table(spark, sf), _requests(spark, sf), "balance", ["o_orderdate", "o_orderkey"])
    return results.select("o_orderkey", "rowkey", "applied")


def kv_put_if_absent_table(spark, sf):
    table, _ = kv.put_if_absent(_table(spark, sf), _requests(spark, sf), "balance", ["o_orderdate", "o_orderkey"])
    return table


def _conditional(spark, sf):
    """One request per customer: every third expects the true balance, the others expect zero."""
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    return read_table(spark, sf, "customer").select(
        salted_key("c_custkey").alias("rowkey"),
        F.when(F.col("c_custkey") % 3 == 0, balance).otherwise(F.lit(0.0)).alias("expected"),
        (F.col("c_acctbal") + 1).alias("value"),
    )


def kv_check_put(spark, sf):
    return kv.check_and_put(_table(spark, sf), _conditional(spark, sf), "balance")[1]


def kv_check_put_table(spark, sf):
    return kv.check_and_put(_table(spark, sf), _conditional(spark, sf), "balance")[0]


def kv_check_delete(spark, sf):
    requests = _conditional(spark, sf).select("rowkey", "expected")
    return kv.check_and_delete(_table(spark, sf), requests, "balance")[1]


def kv_check_delete_table(spark, sf):
    requests = _conditional(spark, sf).select("rowkey", "expected")
    return kv.check_and_delete(_table(spark, sf), requests, "balance")[0]


def _graded(spark, sf):
    """Customers with a grade of 0 to 2; every fourth has none."""
    return read_table(spark, sf, "customer").select(
        salted_key("c_custkey").alias("rowkey"), F.col("c_name").alias("name"),
        F.nullif(F.pmod("c_custkey", F.lit(4)), F.lit(3)).alias("grade"),
    )


def _grade_requests(spark, sf):
    """A request for each stored order; one customer gets every fifth of them."""
    asked = F.when(F.pmod("o_custkey", F.lit(5)) == 0, F.lit(5)).otherwise(F.col("o_custkey"))
    number = F.floor(F.col("o_orderkey") / 4)
    return read_table(spark, sf, "orders").select(
        salted_key(asked).alias("rowkey"), "o_orderdate", "o_orderkey",
        F.nullif(F.pmod(number, F.lit(4)), F.lit(3)).alias("expected"),
        F.nullif(F.pmod(F.floor(number / 4), F.lit(4)), F.lit(3)).alias("value"),
    )


_TURN = ["o_orderdate", "o_orderkey"]


def kv_check_put_sequence(spark, sf):
    results = ordered.check_and_put_in_order(_graded(spark, sf), _grade_requests(spark, sf), "grade", _TURN)[1]
    return results.select("o_orderkey", "rowkey", "applied")


def kv_check_put_sequence_table(spark, sf):
    return ordered.check_and_put_in_order(_graded(spark, sf), _grade_requests(spark, sf), "grade", _TURN)[0]


def kv_check_delete_sequence(spark, sf):
    requests = _grade_requests(spark, sf).drop("value")
    results = ordered.check_and_delete_in_order(_graded(spark, sf), requests, "grade", _TURN)[1]
    return results.select("o_orderkey", "rowkey", "applied")


def kv_check_delete_sequence_table(spark, sf):
    requests = _grade_requests(spark, sf).drop("value")
    return ordered.check_and_delete_in_order(_graded(spark, sf), requests, "grade", _TURN)[0]


# --- streams --------------------------------------------------------------------------------------------------


def _stream_orders(session, sf):
    return feed.orders_from_events(stream_table(session, sf, "events"))


def _stream_txn(session, sf):
    return txn_projection(_stream_orders(session, sf).where("database = 'order'"), keep=("offset",))


def stream_dedup_forever(spark, sf):
    rows = _stream_txn(streaming_session(spark), sf).select("country", "order_id", "user_id")
    return drain_to_table(stream_dedup.forever(rows, ["country", "order_id"], collapse=True), "dedup")


def stream_dedup_ttl(spark, sf):
    rows = _stream_txn(streaming_session(spark, idle_batches=False), sf)
    return drain_to_table(stream_dedup.with_ttl(rows, ["country", "order_id"], order_by="offset"), "dedup-ttl")


def stream_dedup_watermark(spark, sf):
    rows = _stream_txn(streaming_session(spark), sf).select("country", "order_id", "event_time")
    rows = with_event_time(rows, "event_time", None).select("country", "order_id", "event_ts")
    kept = stream_dedup.within_watermark(rows, ["country", "order_id"], "event_ts", "40 days")
    return drain_to_table(kept.select("country", "order_id"), "dedup-watermark")


def stream_rollup_minute(spark, sf):
    """De-duplication and roll-up chained in one stream; minutes that are still open do not appear."""
    session = streaming_session(spark)
    visits = TXN_USER.stream(feed.as_records(_stream_orders(session, sf)), AS_OF, time_filter=False)
    return drain_to_table(reports.user_rollup(visits), "rollup")


def stream_rollup_txn(spark, sf):
    """De-duplication, rates and roll-up chained in one stream."""
    session = streaming_session(spark)
    records = feed.as_records(_stream_orders(session, sf))
    txn = TXN.stream(records, AS_OF, time_filter=False, watermark=False)
    rollup = reports.txn_rollup(enrich_usd(txn, _rates(session, sf), "event"))
    return _money(drain_to_table(rollup, "rollup-txn"), "gmv", "gmv_usd")


def stream_txn_job(spark, sf):
    session = streaming_session(spark)
    records = feed.as_dirty_records(_stream_orders(session, sf))
    rates = RateSnapshot(lambda: _rates(session, sf))

    def finish(batch):
        return TXN.finish(batch, rates, AS_OF, "Asia/Singapore")

    return drain_to_table(TXN.stream(records, AS_OF), "txn", finish)


def stream_txn_user_job(spark, sf):
    session = streaming_session(spark)
    records = feed.as_dirty_records(_stream_orders(session, sf))

    def finish(batch):
        return TXN_USER.finish(batch, None, AS_OF, "Asia/Singapore")

    return drain_to_table(TXN_USER.stream(records, AS_OF), "txn-user", finish)


def stream_txn_ttl_job(spark, sf):
    session = streaming_session(spark, idle_batches=False)
    records = feed.as_records(_stream_orders(session, sf))
    rates = RateSnapshot(lambda: _rates(session, sf))

    def finish(batch):
        return TXN_TTL.finish(batch, rates, AS_OF, "Asia/Singapore")

    return drain_to_table(TXN_TTL.stream(records, AS_OF), "txn-ttl", finish)


QUERIES = {
    f.__name__: f
    for f in (
        fn_currency_to_country, fn_second_to_millisecond, fn_salted_key, fn_salted_key_n, fn_date_shift,
        fn_event_date, fn_business_key, fn_format_millis, fn_truncate_time, fn_sql_functions,
        parse_fallback, parse_drop, parse_fail, parse_bad_counts,
        route_by_database, route_outputs, union_topics, filter_paid,
        txn_project, txn_user_project, txn_project_orders, txn_user_project_orders, view_fields,
        enrich_rate_same_day, enrich_rate_fallback, enrich_rate_asof, enrich_rate_missing,
        enrich_rate_processing_day, enrich_rate_salted, effective_rate_table,
        today_filter, interval_filter, late_reject,
        dedup_order, dedup_user_day, dedup_seen,
        txn_job, txn_user_job, txn_ttl_job, txn_job_all_days, txn_user_job_all_days, txn_sql_job,
        rollup_minute_txn, rollup_minute_user, rollup_late_rejected, hourly_country_txn,
        hourly_country_user, hourly_from_stored_rollup, total_country_txn, total_country_user,
        rollup_hour_country,
        encode_json_rows, encode_output_records, encode_round_trip,
        log_offsets_for_time, log_offsets_json, log_seek, log_seek_to_beginning, log_seek_from_time,
        log_last_offset, log_committed_offset, log_lag,
        kv_scan, kv_get, kv_put, kv_delete_row, kv_delete_column, kv_put_if_absent,
        kv_put_if_absent_table, kv_check_put, kv_check_put_table, kv_check_delete, kv_check_delete_table,
        kv_check_put_sequence, kv_check_put_sequence_table, kv_check_delete_sequence, kv_check_delete_sequence_table,
        stream_dedup_forever, stream_dedup_ttl, stream_dedup_watermark, stream_rollup_minute,
        stream_rollup_txn, stream_txn_job, stream_txn_user_job, stream_txn_ttl_job,
    )
}
