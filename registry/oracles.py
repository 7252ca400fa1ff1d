"""SQL over the stored tables that must give the same rows as the query of the same name."""

from __future__ import annotations

AS_OF = 1705377600000
LOCAL_DAY = "1705334400000 AND {t} < 1705420800000"
SEEK_MS = 1705276800000
SEEN_MS = 1704153600000


def _currency(number: str) -> str:
    return (
        f"CASE {number} % 5 WHEN 0 THEN 'IDR' WHEN 1 THEN 'PHP' WHEN 2 THEN 'MYR' "
        "WHEN 3 THEN 'SGD' ELSE 'USD' END"
    )


def _country(currency: str) -> str:
    return (
        f"CASE {currency} WHEN 'IDR' THEN 'ID' WHEN 'PHP' THEN 'PH' WHEN 'MYR' THEN 'MY' "
        "WHEN 'SGD' THEN 'SG' ELSE '' END"
    )


def _ms(t: str) -> str:
    return f"CASE WHEN {t} BETWEEN 0 AND 4294967295 THEN ({t}) * 1000 ELSE {t} END"


def _day(ms: str, hours: int = 8) -> str:
    return f"strftime(epoch_ms({ms}) + INTERVAL {hours} HOUR, '%Y-%m-%d')"


def _in_day(t: str) -> str:
    return f"{t} >= " + LOCAL_DAY.format(t=t)


# --- building blocks: each is a CTE that may use the ones before it -----------------------------

FEED = f"""
feed AS (
  SELECT CASE WHEN event_id % 2 = 1 THEN epoch_us(ts) // 1000000 * 1000 ELSE epoch_us(ts) // 1000000 END AS create_time,
         {_currency('user_id')} AS currency,
         CASE WHEN event_type = 'purchase' THEN 'paid'
              WHEN event_type IN ('view', 'click') THEN 'processing' ELSE 'failed' END AS order_status,
         user_id,
         user_id * 100 + day(ts) AS order_id,
         value AS gmv,
         CASE WHEN event_type = 'signup' THEN 'user' ELSE 'order' END AS database,
         event_type AS topic,
         CAST(user_id % 3 AS INTEGER) AS "partition",
         event_id AS "offset",
         epoch_us(ts) // 1000 AS "timestamp"
  FROM events
)"""

# What each record of the faulty feed decodes to: bad records, routed records, and their fields.
DIRTY = """
dirty AS (
  SELECT *, "offset" % 97 AS slot,
         "offset" % 97 < 5 OR ("offset" % 97 = 5 AND database = 'order') AS is_bad,
         database = 'order' AND "offset" % 97 NOT IN (0, 1, 2, 3, 4, 6, 9) AS routed
  FROM feed
),
fallback AS (
  SELECT "offset",
         CASE WHEN is_bad THEN 0 ELSE create_time END AS create_time,
         CASE WHEN is_bad THEN 'MYR' ELSE currency END AS currency,
         CASE WHEN is_bad THEN 'paid' ELSE order_status END AS order_status,
         CASE WHEN is_bad OR slot = 8 THEN 0 ELSE user_id END AS user_id,
         CASE WHEN is_bad THEN 0 ELSE order_id END AS order_id,
         CASE WHEN is_bad OR slot = 8 THEN 0.0 ELSE gmv END AS gmv
  FROM dirty WHERE is_bad OR routed
),
dropped AS (
  SELECT "offset", create_time, currency, order_status,
         CASE WHEN slot = 8 THEN 0 ELSE user_id END AS user_id,
         order_id,
         CASE WHEN slot = 8 THEN 0.0 ELSE gmv END AS gmv
  FROM dirty WHERE routed AND NOT is_bad
)"""

CLEAN = """
clean AS (
  SELECT "offset", create_time, currency, order_status, user_id, order_id, gmv FROM feed WHERE database = 'order'
)"""


def _projected(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT "offset", gmv, order_id, user_id, {_country('currency')} AS country, {_ms('create_time')} AS event_time,
         {_day(_ms('create_time'))} AS event_date
  FROM {source} WHERE order_status = 'paid'
)"""


RATES = """
days AS (SELECT DISTINCT CAST(ts AS DATE) AS rate_date FROM events),
rates AS (
  SELECT country, rate_date, base * (100 + day(rate_date)) / 100.0 AS rate
  FROM days, (VALUES ('ID', CAST(0.00007 AS DOUBLE)), ('MY', CAST(0.24 AS DOUBLE)),
                     ('SG', CAST(0.74 AS DOUBLE)), ('PH', CAST(0.02 AS DOUBLE))) q(country, base)
  WHERE NOT (country = 'ID' AND day(rate_date) = 5) AND NOT (country = 'MY' AND day(rate_date) IN (15, 16))
    AND NOT (country = 'SG' AND day(rate_date) = 20) AND NOT (country = 'PH' AND day(rate_date) = 10)
)"""


def _rated(name: str, source: str, day: str, tolerance: int = 1) -> str:
    joins = "\n  ".join(
        f"LEFT JOIN rates r{i} ON r{i}.country = s.country AND r{i}.rate_date = {day} - INTERVAL {i} DAY"
        for i in range(tolerance + 1)
    )
    found = ", ".join(f"r{i}.rate" for i in range(tolerance + 1))
    return f"""
{name} AS (
  SELECT s.*, coalesce({found}, 0.0) AS rate
  FROM {source} s
  {joins}
)"""


def _first(name: str, source: str, keys: str, order: str) -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}
  ) WHERE rn = 1
)"""


def _with(*ctes_and_select: str) -> str:
    *ctes, select = ctes_and_select
    return "WITH " + ",".join(ctes) + "\n" + select


EVENT_DAY = "CAST(s.event_date AS DATE)"
AS_OF_DAY = "DATE '2024-01-16'"
PAID = _projected("paid", "clean")
ORDER_KEY = "country, order_id"
USER_KEY = "country, user_id, event_date"
TXN_OUT = f"gmv, order_id, user_id, country, event_time, CAST({AS_OF} AS BIGINT) AS processing_time, gmv * rate AS gmv_usd"
USER_OUT = f"user_id, country, event_time, CAST({AS_OF} AS BIGINT) AS processing_time, event_date"

# The transaction job over all days, and the visits of all days.
ALL_TXN = (
    FEED, CLEAN, PAID, RATES, _first("firsts", "paid", ORDER_KEY, '"offset"'), _rated("rated", "firsts", EVENT_DAY),
    f"\nall_txn AS (SELECT {TXN_OUT} FROM rated)",
)
ALL_VISITS = (
    FEED, CLEAN, PAID, _first("firsts", "paid", USER_KEY, '"event_time"'),
    f"\nall_visits AS (SELECT {USER_OUT} FROM firsts)",
)
MINUTE = "date_trunc('minute', epoch_ms(event_time))"
TXN_ROLLUP = f"""
txn_rollup AS (
  SELECT {MINUTE} AS minute_ts, country, count(*) AS "count", sum(gmv) AS gmv, sum(gmv_usd) AS gmv_usd
  FROM all_txn GROUP BY 1, 2
)"""
USER_ROLLUP = f"""
user_rollup AS (SELECT {MINUTE} AS minute_ts, country, count(*) AS "count" FROM all_visits GROUP BY 1, 2)"""
DAY_ROWS = "minute_ts >= TIMESTAMP '2024-01-15 16:00:00' AND minute_ts < TIMESTAMP '2024-01-16 16:00:00'"
HOURLY_TXN = _with(
    *ALL_TXN, TXN_ROLLUP,
    f"""SELECT date_trunc('hour', minute_ts) AS hour_ts, country, CAST(sum("count") AS DOUBLE) AS "count",
       floor(sum(gmv) * 1000000 + 0.123456789) / 1000000 AS gmv, floor(sum(gmv_usd) * 1000000 + 0.123456789) / 1000000 AS gmv_usd
FROM txn_rollup WHERE {DAY_ROWS} GROUP BY 1, 2""",
)

TXN_JOB = _with(
    FEED, DIRTY, _projected("paid", "fallback"), RATES,
    f"\nof_day AS (SELECT * FROM paid WHERE {_in_day('event_time')})",
    _first("firsts", "of_day", ORDER_KEY, '"offset"'), _rated("rated", "firsts", AS_OF_DAY),
    f"SELECT {TXN_OUT} FROM rated",
)
TXN_USER_JOB = _with(
    FEED, DIRTY, _projected("paid", "dropped"),
    f"\nof_day AS (SELECT * FROM paid WHERE {_in_day('event_time')})",
    _first("firsts", "of_day", USER_KEY, "event_time"),
    f"SELECT {USER_OUT} FROM firsts",
)
TXN_TTL_JOB = _with(
    FEED, CLEAN, PAID, RATES,
    f"\nof_day AS (SELECT * FROM paid WHERE {_in_day('event_time')})",
    _first("firsts", "of_day", ORDER_KEY, '"offset"'), _rated("rated", "firsts", AS_OF_DAY),
    f"SELECT {TXN_OUT} FROM rated",
)

STORED = f"""
stored AS (
  SELECT CASE WHEN o_orderkey % 2 = 1 THEN epoch_ms(o_orderdate) // 1000 * 1000
              ELSE epoch_ms(o_orderdate) // 1000 END AS create_time,
         {_currency('c_nationkey')} AS currency,
         CASE o_orderstatus WHEN 'P' THEN 'paid' WHEN 'O' THEN 'processing' ELSE 'failed' END AS order_status,
         o_custkey AS user_id, o_orderkey AS order_id, o_totalprice AS gmv
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

LOG = """
log AS (SELECT topic, "partition", "offset", "timestamp", order_id AS value FROM feed)"""
STARTS = f"""
starts AS (
  SELECT topic, "partition", coalesce(min(CASE WHEN "timestamp" >= {SEEK_MS} THEN "offset" END), -1) AS "offset"
  FROM log GROUP BY 1, 2
)"""
COMMITS = f"""
commits AS (
  SELECT topic, "partition", max("offset" + 1) AS committed FROM log
  WHERE "timestamp" < {SEEK_MS} AND topic <> 'error' GROUP BY 1, 2
)"""
LASTS = """
lasts AS (SELECT topic, "partition", max("offset") + 1 AS last_offset FROM log GROUP BY 1, 2)"""


def _salted(key: str, n: int = 2) -> str:
    return f"right(md5({key}), {n}) || ':' || {key}"


CUSTKEY = "CAST(c_custkey AS VARCHAR)"
TABLE = f"""
tab AS (
  SELECT {_salted(CUSTKEY)} AS rowkey, c_name AS name,
         CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance
  FROM customer
)"""
REQUESTS = f"""
keyed AS (
  SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE 'n' END || CAST(o_custkey AS VARCHAR) AS k FROM orders
),
requests AS (
  SELECT {_salted('k')} AS rowkey, o_totalprice AS balance, o_orderdate, o_orderkey, o_orderstatus FROM keyed
)"""
WINS = """
wins AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY rowkey ORDER BY o_orderdate, o_orderkey) AS rn FROM requests
  ) WHERE rn = 1 AND rowkey NOT IN (SELECT rowkey FROM tab WHERE balance IS NOT NULL)
)"""
CONDITIONAL = f"""
conditional AS (
  SELECT {_salted(CUSTKEY)} AS rowkey,
         CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_acctbal >= 0 THEN c_acctbal END ELSE 0.0 END AS expected,
         c_acctbal + 1 AS value
  FROM customer
),
judged AS (
  SELECT c.*, t.name, t.balance, t.balance IS NOT DISTINCT FROM c.expected AS applied
  FROM conditional c LEFT JOIN tab t USING (rowkey)
)"""


def _in_turn(value: str, select: str) -> str:
    """One recursive step for each request of a key, with the cell behind it."""
    asked = _salted("CAST(CASE WHEN o_custkey % 5 = 0 THEN 5 ELSE o_custkey END AS VARCHAR)")
    return f"""WITH RECURSIVE graded AS (
  SELECT {_salted(CUSTKEY)} AS rowkey, c_name AS name, nullif(c_custkey % 4, 3) AS grade FROM customer
),
asked AS (
  SELECT {asked} AS rowkey, o_orderkey, nullif(o_orderkey // 4 % 4, 3) AS expected, nullif(o_orderkey // 16 % 4, 3) AS value,
         row_number() OVER (PARTITION BY {asked} ORDER BY o_orderdate, o_orderkey) AS turn
  FROM orders
),
done AS (
  SELECT rowkey, CAST(0 AS BIGINT) AS turn, max(grade) AS cell, CAST(NULL AS BIGINT) AS o_orderkey, false AS applied
  FROM (SELECT DISTINCT rowkey FROM asked) LEFT JOIN graded USING (rowkey) GROUP BY rowkey
  UNION ALL
  SELECT d.rowkey, a.turn, CASE WHEN d.cell IS NOT DISTINCT FROM a.expected THEN {value} ELSE d.cell END,
         a.o_orderkey, d.cell IS NOT DISTINCT FROM a.expected
  FROM done d JOIN asked a ON a.rowkey = d.rowkey AND a.turn = d.turn + 1
),
after AS (
  SELECT rowkey, name, CASE WHEN l.rowkey IS NULL THEN grade ELSE l.cell END AS grade
  FROM graded FULL JOIN (SELECT rowkey, arg_max(struct_pack(c := cell), turn).c AS cell FROM done GROUP BY rowkey) l USING (rowkey)
)
""" + select


def _upsert(writes: str) -> str:
    return f"""SELECT coalesce(t.rowkey, w.rowkey) AS rowkey, t.name,
       CASE WHEN w.rowkey IS NOT NULL THEN w.balance ELSE t.balance END AS balance
FROM tab t FULL OUTER JOIN {writes} w ON t.rowkey = w.rowkey"""


VISIT_JSON = (
    """'{"user_id":' || user_id || ',"country":"' || country || '","event_time":' || event_time """
    """|| ',"processing_time":' || processing_time || ',"event_date":"' || event_date || '"}'"""
)
ENRICHED = 'SELECT "offset", country, rate, gmv * rate AS gmv_usd FROM rated'

TURNS = "SELECT o_orderkey, rowkey, applied FROM done WHERE turn > 0"
AFTER_TURNS = "SELECT * FROM after WHERE name IS NOT NULL OR grade IS NOT NULL"

ORACLES: dict[str, str] = {
    "fn_currency_to_country": _with(FEED, f'SELECT "offset", {_country("currency")} AS country FROM feed'),
    "fn_second_to_millisecond": _with(
        FEED,
        f"""SELECT "offset", {_ms('create_time')} AS ms, {_ms('create_time - 1705000000')} AS shifted_ms,
       {_ms('create_time + 2590000000')} AS edge_ms FROM feed""",
    ),
    "fn_salted_key": _with(
        FEED,
        f'\nkeys AS (SELECT "offset", {_country("currency")} || {_day(chr(34) + "timestamp" + chr(34))} AS k FROM feed)',
        f'SELECT "offset", {_salted("k")} AS rowkey FROM keys',
    ),
    "fn_salted_key_n": _with(
        FEED,
        f'\nkeys AS (SELECT "offset", {_country("currency")} || {_day(chr(34) + "timestamp" + chr(34))} AS k FROM feed)',
        f'SELECT "offset", {_salted("k", 5)} AS rowkey FROM keys',
    ),
    "fn_date_shift": """SELECT event_id, strftime(CAST(ts AS DATE) - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before,
       strftime(CAST(ts AS DATE) + INTERVAL 31 DAY, '%Y-%m-%d') AS month_later FROM events""",
    "fn_event_date": """SELECT event_id AS "offset", strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_day,
       strftime(ts, '%Y-%m-%d') AS utc_day FROM events""",
    "fn_business_key": _with(FEED, CLEAN, PAID, 'SELECT "offset", country || CAST(order_id AS VARCHAR) AS rowkey FROM paid'),
    "fn_format_millis": """SELECT event_id AS "offset", strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS local_time
FROM events""",
    "fn_truncate_time": """SELECT event_id AS "offset", epoch_ms(date_trunc('minute', ts)) AS minute_ms,
       date_trunc('hour', ts) AS hour_ts FROM events""",
    "fn_sql_functions": _with(
        FEED,
        f"""SELECT "offset", {_country('currency')} AS country, {_ms('create_time')} AS event_time,
       {_salted('(' + _country('currency') + ')')} AS salted, {_salted('currency', 3)} AS salted_n,
       strftime(epoch_ms({_ms('create_time')}) + INTERVAL 8 HOUR - INTERVAL 1 DAY, '%Y-%m-%d') AS day_before
FROM feed""",
    ),
    "parse_fallback": _with(FEED, DIRTY, "SELECT * FROM fallback"),
    "parse_drop": _with(FEED, DIRTY, "SELECT * FROM dropped"),
    "parse_fail": _with(FEED, CLEAN, "SELECT * FROM clean"),
    "parse_bad_counts": _with(
        FEED, DIRTY, "SELECT topic, count(*) AS records, count(*) FILTER (WHERE is_bad) AS malformed FROM dirty GROUP BY 1"
    ),
    "route_by_database": _with(
        FEED,
        """SELECT "offset", 'order' AS route FROM feed WHERE database = 'order'
UNION ALL SELECT "offset", 'user' FROM feed WHERE database = 'user'
UNION ALL SELECT "offset", 'paid_order' FROM feed WHERE database = 'order' AND order_status = 'paid'""",
    ),
    "route_outputs": _with(
        FEED,
        """SELECT database AS output, "offset", user_id, order_status FROM feed WHERE database IN ('order', 'user')""",
    ),
    "union_topics": "SELECT event_id, event_type, value FROM events WHERE event_type IN ('purchase', 'view', 'click')",
    "filter_paid": _with(
        FEED, CLEAN, """SELECT "offset", order_id, user_id, gmv FROM clean WHERE order_status = 'paid'"""
    ),
    "txn_project": _with(
        FEED, CLEAN, PAID, 'SELECT gmv, order_id, user_id, country, event_time, "offset" FROM paid'
    ),
    "txn_user_project": _with(
        FEED, CLEAN, PAID, 'SELECT user_id, country, event_time, event_date, "offset" FROM paid'
    ),
    "txn_project_orders": _with(
        STORED,
        f"""SELECT gmv, order_id, user_id, {_country('currency')} AS country, {_ms('create_time')} AS event_time
FROM stored WHERE order_status = 'paid'""",
    ),
    "txn_user_project_orders": _with(
        STORED,
        f"""SELECT user_id, {_country('currency')} AS country, {_ms('create_time')} AS event_time,
       {_day(_ms('create_time'))} AS event_date
FROM stored WHERE order_status = 'paid'""",
    ),
    "view_fields": _with(
        FEED, CLEAN, f"SELECT order_id, create_time, {_ms('create_time')} AS rowtime_ms FROM clean"
    ),
    "enrich_rate_same_day": _with(FEED, CLEAN, PAID, RATES, _rated("rated", "paid", EVENT_DAY, 0), ENRICHED),
    "enrich_rate_fallback": _with(FEED, CLEAN, PAID, RATES, _rated("rated", "paid", EVENT_DAY, 1), ENRICHED),
    "enrich_rate_asof": _with(FEED, CLEAN, PAID, RATES, _rated("rated", "paid", EVENT_DAY, 3), ENRICHED),
    "enrich_rate_missing": _with(
        FEED, CLEAN, PAID, RATES, _rated("rated", "paid", EVENT_DAY),
        "SELECT country, event_date, count(*) AS n FROM rated WHERE rate = 0.0 GROUP BY 1, 2",
    ),
    "enrich_rate_processing_day": _with(
        FEED, CLEAN, PAID, RATES, _rated("rated", "paid", AS_OF_DAY), 'SELECT "offset", gmv * rate AS gmv_usd FROM rated'
    ),
    "enrich_rate_salted": _with(
        FEED, CLEAN, PAID, RATES, _rated("rated", "paid", EVENT_DAY), 'SELECT "offset", rate FROM rated'
    ),
    "effective_rate_table": _with(
        RATES,
        """
wanted AS (
  SELECT country, rate_date FROM rates
  UNION SELECT country, CAST(rate_date + INTERVAL 1 DAY AS DATE) FROM rates
)""",
        """SELECT w.country, w.rate_date, coalesce(a.rate, b.rate) AS rate
FROM wanted w
LEFT JOIN rates a ON a.country = w.country AND a.rate_date = w.rate_date
LEFT JOIN rates b ON b.country = w.country AND b.rate_date = w.rate_date - INTERVAL 1 DAY""",
    ),
    "today_filter": _with(
        FEED, CLEAN, PAID, f'SELECT "offset", order_id, event_time FROM paid WHERE {_in_day("event_time")}'
    ),
    "interval_filter": """SELECT event_id, user_id FROM events
WHERE ts >= TIMESTAMP '2024-01-15 16:00:00' AND ts < TIMESTAMP '2024-01-16 16:00:00'""",
    "late_reject": _with(
        FEED, CLEAN, PAID, f'SELECT "offset", event_time FROM paid WHERE event_time >= {AS_OF} - 3600000'
    ),
    "dedup_order": _with(
        FEED, CLEAN, PAID, _first("firsts", "paid", ORDER_KEY, '"offset"'),
        'SELECT gmv, order_id, user_id, country, event_time, "offset" FROM firsts',
    ),
    "dedup_user_day": _with(
        FEED, CLEAN, PAID, _first("firsts", "paid", USER_KEY, "event_time"),
        "SELECT user_id, country, event_time, event_date FROM firsts",
    ),
    "dedup_seen": _with(
        FEED, CLEAN, PAID,
        f"\nlater AS (SELECT * FROM paid WHERE event_time >= {SEEN_MS})",
        _first("firsts", "later", "country, user_id", '"offset"'),
        f"""SELECT "offset", country, user_id FROM firsts f
WHERE NOT EXISTS (SELECT 1 FROM paid p WHERE p.event_time < {SEEN_MS}
                  AND p.country = f.country AND p.user_id = f.user_id)""",
    ),
    "txn_job": TXN_JOB,
    "txn_user_job": TXN_USER_JOB,
    "txn_ttl_job": TXN_TTL_JOB,
    "txn_job_all_days": _with(*ALL_TXN, "SELECT * FROM all_txn"),
    "txn_user_job_all_days": _with(*ALL_VISITS, "SELECT * FROM all_visits"),
    "txn_sql_job": _with(
        FEED, CLEAN, PAID, RATES, _rated("rated", "paid", EVENT_DAY),
        'SELECT "offset", country, gmv * rate AS gmv_usd FROM rated',
    ),
    "rollup_minute_txn": _with(
        *ALL_TXN, TXN_ROLLUP,
        """SELECT minute_ts, country, "count", floor(gmv * 1000000 + 0.123456789) / 1000000 AS gmv, floor(gmv_usd * 1000000 + 0.123456789) / 1000000 AS gmv_usd FROM txn_rollup""",
    ),
    "rollup_minute_user": _with(*ALL_VISITS, USER_ROLLUP, "SELECT * FROM user_rollup"),
    "rollup_late_rejected": _with(
        *ALL_TXN,
        f"""SELECT {MINUTE} AS minute_ts, country, count(*) AS "count",
       floor(sum(gmv) * 1000000 + 0.123456789) / 1000000 AS gmv, floor(sum(gmv_usd) * 1000000 + 0.123456789) / 1000000 AS gmv_usd
FROM all_txn WHERE event_time >= {AS_OF} - 3600000 GROUP BY 1, 2""",
    ),
    "hourly_country_txn": HOURLY_TXN,
    "hourly_from_stored_rollup": HOURLY_TXN,
    "hourly_country_user": _with(
        *ALL_VISITS, USER_ROLLUP,
        f"""SELECT date_trunc('hour', minute_ts) AS hour_ts, country, CAST(sum("count") AS DOUBLE) AS "count"
FROM user_rollup WHERE {DAY_ROWS} GROUP BY 1, 2""",
    ),
    "total_country_txn": _with(
        *ALL_TXN, TXN_ROLLUP,
        """SELECT country, floor(sum(gmv) * 1000000 + 0.123456789) / 1000000 AS gmv_sum, floor(sum(gmv_usd) * 1000000 + 0.123456789) / 1000000 AS gmv_usd_sum,
       CAST(sum("count") AS BIGINT) AS order_count FROM txn_rollup GROUP BY 1""",
    ),
    "total_country_user": _with(
        *ALL_VISITS, USER_ROLLUP,
        """SELECT country, CAST(sum("count") AS BIGINT) AS user_count FROM user_rollup GROUP BY 1""",
    ),
    "rollup_hour_country": _with(
        *ALL_TXN, TXN_ROLLUP,
        """SELECT date_trunc('hour', minute_ts) AS "hour", country, CAST(sum("count") AS BIGINT) AS "count",
       floor(sum(gmv) * 1000000 + 0.123456789) / 1000000 AS gmv, floor(sum(gmv_usd) * 1000000 + 0.123456789) / 1000000 AS gmv_usd FROM txn_rollup GROUP BY 1, 2""",
    ),
    "encode_json_rows": _with(*ALL_VISITS, f"SELECT {VISIT_JSON} AS value FROM all_visits"),
    "encode_output_records": _with(
        *ALL_VISITS,
        f"""SELECT event_time, country || CAST(user_id AS VARCHAR) || event_date AS rowkey, {VISIT_JSON} AS value
FROM all_visits""",
    ),
    "encode_round_trip": _with(
        *ALL_TXN,
        """SELECT country || CAST(order_id AS VARCHAR) AS rowkey, gmv, order_id, user_id, country, event_time, gmv_usd
FROM all_txn""",
    ),
    "log_offsets_for_time": _with(FEED, LOG, STARTS, "SELECT * FROM starts"),
    "log_offsets_json": _with(
        FEED, LOG, STARTS,
        """
topics AS (
  SELECT topic, string_agg('"' || "partition" || '":' || "offset", ',' ORDER BY "partition") AS body
  FROM starts GROUP BY 1
)""",
        """SELECT '{' || string_agg('"' || topic || '":{' || body || '}', ',' ORDER BY topic) || '}' AS offsets FROM topics""",
    ),
    "log_seek": _with(
        FEED, LOG,
        """SELECT * FROM log WHERE ("partition" = 0 AND "offset" >= 500) OR ("partition" = 2 AND "offset" >= 900)""",
    ),
    "log_seek_to_beginning": _with(FEED, LOG, 'SELECT * FROM log WHERE "offset" >= 0'),
    "log_seek_from_time": _with(
        FEED, LOG, STARTS,
        """SELECT l.* FROM log l JOIN starts s ON l.topic = s.topic AND l."partition" = s."partition"
WHERE s."offset" >= 0 AND l."offset" >= s."offset" """,
    ),
    "log_last_offset": _with(FEED, LOG, LASTS, "SELECT * FROM lasts"),
    "log_committed_offset": _with(FEED, LOG, COMMITS, "SELECT * FROM commits"),
    "log_lag": _with(
        FEED, LOG, LASTS, COMMITS,
        """SELECT l.topic, CAST(sum(last_offset - coalesce(committed, 0)) AS BIGINT) AS lag
FROM lasts l LEFT JOIN commits c ON l.topic = c.topic AND l."partition" = c."partition" GROUP BY 1""",
    ),
    "kv_scan": _with(TABLE, "SELECT rowkey, balance FROM tab WHERE balance IS NOT NULL"),
    "kv_get": _with(
        TABLE, REQUESTS, "SELECT o_orderkey, r.rowkey, t.balance FROM requests r LEFT JOIN tab t ON r.rowkey = t.rowkey"
    ),
    "kv_put": _with(
        TABLE, REQUESTS,
        """
writes AS (
  SELECT rowkey, balance FROM (
    SELECT *, row_number() OVER (PARTITION BY rowkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM requests
  ) WHERE rn = 1
)""",
        _upsert("writes"),
    ),
    "kv_delete_row": _with(
        TABLE, REQUESTS, "SELECT * FROM tab WHERE rowkey NOT IN (SELECT rowkey FROM requests WHERE o_orderstatus = 'F')"
    ),
    "kv_delete_column": _with(
        TABLE, REQUESTS,
        """SELECT rowkey, name,
       CASE WHEN rowkey NOT IN (SELECT rowkey FROM requests WHERE o_orderstatus = 'F') THEN balance END AS balance
FROM tab""",
    ),
    "kv_put_if_absent": _with(
        TABLE, REQUESTS, WINS,
        """SELECT o_orderkey, rowkey, o_orderkey IN (SELECT o_orderkey FROM wins) AS applied FROM requests""",
    ),
    "kv_put_if_absent_table": _with(TABLE, REQUESTS, WINS, _upsert("wins")),
    "kv_check_put": _with(TABLE, CONDITIONAL, "SELECT rowkey, expected, value, applied FROM judged"),
    "kv_check_put_table": _with(
        TABLE, CONDITIONAL,
        "SELECT rowkey, name, CASE WHEN applied THEN value ELSE balance END AS balance FROM judged",
    ),
    "kv_check_delete": _with(TABLE, CONDITIONAL, "SELECT rowkey, expected, applied FROM judged"),
    "kv_check_delete_table": _with(
        TABLE, CONDITIONAL, "SELECT rowkey, name, CASE WHEN NOT applied THEN balance END AS balance FROM judged"
    ),
    "kv_check_put_sequence": _in_turn("a.value", TURNS),
    "kv_check_put_sequence_table": _in_turn("a.value", AFTER_TURNS),
    "kv_check_delete_sequence": _in_turn("NULL", TURNS),
    "kv_check_delete_sequence_table": _in_turn("NULL", AFTER_TURNS),
    "stream_dedup_forever": _with(FEED, CLEAN, PAID, "SELECT DISTINCT country, order_id, user_id FROM paid"),
    "stream_dedup_ttl": _with(
        FEED, CLEAN, PAID, _first("firsts", "paid", ORDER_KEY, '"offset"'),
        'SELECT gmv, order_id, user_id, country, event_time, "offset" FROM firsts',
    ),
    "stream_dedup_watermark": _with(FEED, CLEAN, PAID, "SELECT DISTINCT country, order_id FROM paid"),
    "stream_rollup_minute": _with(
        *ALL_VISITS, USER_ROLLUP,
        """SELECT * FROM user_rollup WHERE epoch_ms(minute_ts) + 60000
   <= (SELECT max(event_time) FROM all_visits) - 3600000""",
    ),
    "stream_rollup_txn": _with(
        *ALL_TXN, TXN_ROLLUP,
        """SELECT minute_ts, country, "count", floor(gmv * 1000000 + 0.123456789) / 1000000 AS gmv,
       floor(gmv_usd * 1000000 + 0.123456789) / 1000000 AS gmv_usd
FROM txn_rollup WHERE epoch_ms(minute_ts) + 60000 <= (SELECT max(event_time) FROM all_txn) - 3600000""",
    ),
    "stream_txn_job": TXN_JOB,
    "stream_txn_user_job": TXN_USER_JOB,
    "stream_txn_ttl_job": TXN_TTL_JOB,
}
