"""Order events derived from the stored tables, so that every job runs on their rows.

``events`` and ``orders`` become order columns or, with ``as_records``, JSON records as they would
arrive from a topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.functions.scalars import ntz_to_millis

# Currency by number (the fifth is unmapped on purpose), daily base rates by country, and the
# days of the month without a quote.
CURRENCIES = ("IDR", "PHP", "MYR", "SGD", "USD")
BASE_RATES = {"ID": 0.00007, "MY": 0.24, "SG": 0.74, "PH": 0.02}
MISSING_DAYS = {"ID": (5,), "MY": (15, 16), "SG": (20,), "PH": (10,)}

ORDER_COLUMNS = ("create_time", "currency", "order_status", "user_id", "order_id", "gmv")


def _currency(number):
    return F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]), (F.pmod(number, F.lit(5)) + 1).cast("int"))


def _seconds_or_millis(ms, odd_key):
    """Producers send seconds or milliseconds; here odd keys send milliseconds."""
    return F.when(F.pmod(odd_key, F.lit(2)) == 1, F.floor(ms / 1000) * 1000).otherwise(F.floor(ms / 1000))


def orders_from_events(events: DataFrame) -> DataFrame:
    """Order columns plus transport columns (``topic, partition, offset, timestamp``).

    An order is known by its user and day, so a user's later purchases of a day repeat its id.
    """
    ms = ntz_to_millis("ts")
    status = (
        F.when(F.col("event_type") == "purchase", "paid")
        .when(F.col("event_type").isin("view", "click"), "processing")
        .otherwise("failed")
    )
    return events.select(
        _seconds_or_millis(ms, F.col("event_id")).cast("bigint").alias("create_time"),
        _currency(F.col("user_id")).alias("currency"),
        status.alias("order_status"),
        "user_id",
        (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("order_id"),
        F.col("value").alias("gmv"),
        F.when(F.col("event_type") == "signup", "user").otherwise("order").alias("database"),
        F.col("event_type").alias("topic"),
        F.pmod("user_id", F.lit(3)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        ms.alias("timestamp"),
    )


def orders_from_orders(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Order columns from stored orders; the currency is that of the customer's nation."""
    ms = ntz_to_millis("o_orderdate")
    status = (
        F.when(F.col("o_orderstatus") == "P", "paid")
        .when(F.col("o_orderstatus") == "O", "processing")
        .otherwise("failed")
    )
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        _seconds_or_millis(ms, F.col("o_orderkey")).cast("bigint").alias("create_time"),
        _currency(F.col("c_nationkey")).alias("currency"),
        status.alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("gmv"),
    )


def as_records(orders: DataFrame) -> DataFrame:
    """Orders with a ``database`` column as JSON records ``value`` with their transport columns."""
    body = F.struct(*ORDER_COLUMNS, F.struct("database").alias("event"))
    return orders.select(
        F.to_json(body).alias("value"), "topic", "partition", "offset",
        F.floor(F.col("timestamp") / 1000).alias("timestamp"),
    )


def as_dirty_records(orders: DataFrame) -> DataFrame:
    """``as_records`` with the faults that real producers make, at fixed offsets of every 97 records."""
    slot = F.pmod("offset", F.lit(97))
    event = F.struct("database").alias("event")
    as_text = F.struct(
        *[F.col(c).cast("string").alias(c) for c in ("create_time", "user_id", "order_id", "gmv")],
        "currency", "order_status", event,
    )
    bad_gmv = F.struct(
        "create_time", "currency", "order_status", "user_id", "order_id", F.lit("abc").alias("gmv"), event
    )
    other_bad_gmv = F.struct(
        "create_time", F.lit("abc").alias("gmv"), F.struct(F.lit("user").alias("database")).alias("event")
    )
    partial = F.struct(
        "create_time", "currency", "order_status", "order_id", F.lit("x").alias("note"), event
    )
    fraction = F.struct(
        F.concat(F.col("create_time").cast("string"), F.lit(".9")).alias("create_time"),
        "currency", "order_status", "user_id", "order_id", "gmv", event,
    )
    clean = F.to_json(F.struct(*ORDER_COLUMNS, event))
    value = (
        F.when(slot == 0, F.lit('{"create_time": 17'))
        .when(slot == 1, F.lit(None).cast("string"))
        .when(slot == 2, F.lit(""))
        .when(slot == 3, F.lit("plain text"))
        .when(slot == 4, F.lit("[1, 2]"))
        .when(slot == 5, F.to_json(bad_gmv))
        .when(slot == 6, F.to_json(other_bad_gmv))
        .when(slot == 7, F.to_json(as_text))
        .when(slot == 8, F.to_json(partial))
        .when(slot == 9, F.to_json(F.struct(*ORDER_COLUMNS)))
        .when(slot == 10, F.to_json(fraction))
        .otherwise(clean)
    )
    return orders.select(
        value.alias("value"), "topic", "partition", "offset",
        F.floor(F.col("timestamp") / 1000).alias("timestamp"),
    )


def rates_from_events(events: DataFrame) -> DataFrame:
    """One quote per country and day of ``events``, except on the country's missing days."""
    days = events.select(F.col("ts").cast("date").alias("rate_date")).distinct()
    quotes = F.array(*[
        F.struct(
            F.lit(c).alias("country"),
            F.lit(r).alias("base"),
            F.array(*[F.lit(d) for d in MISSING_DAYS[c]]).alias("missing"),
        )
        for c, r in BASE_RATES.items()
    ])
    day = F.dayofmonth("rate_date")
    return (
        days.select("rate_date", F.explode(quotes).alias("q"))
        .where(~F.array_contains("q.missing", day))
        .select(
            F.col("q.country").alias("country"),
            "rate_date",
            (F.col("q.base") * (F.lit(100) + day) / F.lit(100.0)).alias("rate"),
        )
    )
