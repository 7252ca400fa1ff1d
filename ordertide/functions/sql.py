"""The scalar functions under SQL names, as SQL-bodied temporary functions that Catalyst inlines."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ordertide.functions.scalars import (
    _MAX_MS,
    _MIN_MS,
    COUNTRY_BY_CURRENCY,
    DEFAULT_TZ,
    MAX_EPOCH_SECONDS,
)


def _define(spark: SparkSession, signature: str, returns: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS {returns} RETURN {body}")


def register_functions(
    spark: SparkSession, tz: str = DEFAULT_TZ, rates_view: str | None = None
) -> None:
    """Register the functions for ``spark.sql``.

    ``rates_view`` names a view of effective rates (``operators.rates.effective_rates``). With it,
    ``get_exchange_rate(country, date)`` is registered as a correlated lookup, which Catalyst turns
    into one left join; Spark broadcasts the view when its size allows and shuffles otherwise.
    """
    cases = " ".join(f"WHEN '{c}' THEN '{k}'" for c, k in COUNTRY_BY_CURRENCY.items())
    _define(spark, "currency_to_country(currency STRING)", "STRING", f"CASE currency {cases} ELSE '' END")
    _define(
        spark,
        "second_to_millisecond(t BIGINT)",
        "BIGINT",
        f"CASE WHEN t BETWEEN 0 AND {MAX_EPOCH_SECONDS} THEN t * 1000 ELSE t END",
    )
    _define(spark, "salted_key(k STRING)", "STRING", "concat(right(md5(k), 2), ':', k)")
    _define(spark, "salted_key_n(k STRING, n INT)", "STRING", "concat(right(md5(k), n), ':', k)")
    _define(
        spark,
        "date_shift(d STRING, n INT)",
        "STRING",
        "date_format(date_add(CAST(try_to_timestamp(d, 'yyyy-MM-dd') AS DATE), n), 'yyyy-MM-dd')",
    )
    _define(
        spark,
        "event_day(ms BIGINT)",
        "STRING",
        f"CASE WHEN ms BETWEEN {_MIN_MS} AND {_MAX_MS} THEN "
        f"CAST(CAST(convert_timezone('UTC', '{tz}', timestampadd(MILLISECOND, ms, "
        "TIMESTAMP_NTZ'1970-01-01 00:00:00')) AS DATE) AS STRING) END",
    )
    if rates_view:
        _define(
            spark,
            "get_exchange_rate(c STRING, d STRING)",
            "DOUBLE",
            f"coalesce((SELECT max(r.rate) FROM {rates_view} r WHERE r.country = c "
            "AND r.rate_date = CAST(try_to_timestamp(d, 'yyyy-MM-dd') AS DATE)), 0.0D)",
        )
