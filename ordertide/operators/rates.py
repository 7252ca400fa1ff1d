"""Exchange-rate enrichment: a dated lookup with a bounded look-back, as one left join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordertide.functions.scalars import DEFAULT_TZ, event_date, now_millis
from ordertide.session import fits, settle

BROADCAST_ROWS = 500_000


def effective_rates(rates: DataFrame, tolerance_days: int = 1, version: str | None = None) -> DataFrame:
    """The rate in force per (country, rate_date): its own, else the one up to ``tolerance_days`` old.

    ``rates`` holds ``country, rate_date, rate``. Each rate is offered to its own day and to the
    following ``tolerance_days`` days, and every day takes the youngest offer. So the big side is
    probed once whatever the tolerance. Repeated keys are resolved here (highest ``version``, or
    the highest rate without one): the lookup must never multiply rows.
    """
    order = F.struct(F.col(version) if version else F.col("rate"), F.col("rate"))
    keyed = rates.where(F.col("rate").isNotNull()).groupBy("country", "rate_date").agg(
        F.max_by("rate", order).alias("rate")
    )
    offers = keyed.select(
        "country", "rate_date", "rate", F.explode(F.sequence(F.lit(0), F.lit(tolerance_days))).alias("age")
    )
    return (
        offers.select("country", F.date_add("rate_date", F.col("age")).alias("rate_date"), "rate", "age")
        .groupBy("country", "rate_date")
        .agg(F.min_by("rate", "age").alias("rate"))
    )


def lookup(
    df: DataFrame,
    table: DataFrame,
    keys: dict[str, str],
    values: list[str],
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = 64,
) -> DataFrame:
    """Left join ``df`` to a table with one row per key; ``keys`` maps columns of ``df`` to the table's.

    A table of at most ``broadcast_rows`` rows (counted, never assumed) is broadcast. A larger one is
    joined by shuffle with the rows of ``df`` spread over ``salts`` copies of each key, so that a key
    with a large share of all rows is not one task's work.
    """
    small = fits(table, broadcast_rows)
    right = table.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys.values())], *values
    )
    condition = [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)]
    if small:
        right = F.broadcast(right)
    else:
        df = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
        right = right.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        condition.append(F.col("__salt") == F.col("__copy"))
    joined = df.join(right, condition, "left")
    return joined.drop("__salt", "__copy", *[f"__k{i}" for i in range(len(keys))])


def prepare_rates(rates: DataFrame, tolerance_days: int = 1, version: str | None = None) -> DataFrame:
    """Effective rates, computed once into the shared folder (see ``settle``)."""
    return settle(effective_rates(rates, tolerance_days, version), "rates")


def lookup_asof(
    df: DataFrame,
    rates: DataFrame,
    day: Column,
    tolerance_days: int = 1,
    default: float = 0.0,
    out: str = "rate",
    country: str = "country",
    version: str | None = None,
    prepared: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = 64,
) -> DataFrame:
    """Add the rate in force for (country, ``day``), or ``default`` when there is none.

    With ``prepared``, ``rates`` is already the result of ``prepare_rates``.
    """
    table = rates if prepared else prepare_rates(rates, tolerance_days, version)
    table = table.withColumnRenamed("rate", "__rate")
    df = df.withColumn("__day", day.cast("date"))
    df = lookup(df, table, {country: "country", "__day": "rate_date"}, ["__rate"], broadcast_rows, salts)
    return df.withColumn(out, F.coalesce("__rate", F.lit(default))).drop("__day", "__rate")


def rate_day(rate_date: str = "processing", as_of: int | None = None, tz: str = DEFAULT_TZ) -> Column:
    """The day whose rate applies: that of the clock (``processing``) or of the event (``event``)."""
    if rate_date == "processing":
        return event_date(now_millis(as_of), tz).try_cast("date")
    if rate_date == "event":
        return event_date("event_time", tz).try_cast("date")
    raise ValueError("rate_date must be 'processing' or 'event'")


def enrich_usd(
    df: DataFrame,
    rates: DataFrame | None,
    rate_date: str = "processing",
    as_of: int | None = None,
    tz: str = DEFAULT_TZ,
    amount: str = "gmv",
    out: str = "gmv_usd",
    **options,
) -> DataFrame:
    """Add ``out = amount * rate``; without rates, or without a match, the rate is 0.0."""
    if rates is None:
        return df.withColumn(out, F.col(amount) * F.lit(0.0))
    df = lookup_asof(df, rates, rate_day(rate_date, as_of, tz), out="__r", **options)
    return df.withColumn(out, F.col(amount) * F.col("__r")).drop("__r")
