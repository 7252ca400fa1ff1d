"""SQL for the queries of ``registry.batches``."""

from __future__ import annotations

from registry.oracles import (
    AS_OF,
    CLEAN,
    DIRTY,
    EVENT_DAY,
    FEED,
    LASTS,
    LOG,
    ORACLES as BATCH_FREE,
    ORDER_KEY,
    PAID,
    RATES,
    TXN_JOB,
    TXN_OUT,
    TXN_ROLLUP,
    _first,
    _ms,
    _rated,
    _with,
)

#: The micro-batch in which an event arrives.
BATCH = 'CAST("offset" * 4 // (SELECT max(event_id) + 1 FROM events) AS BIGINT)'
SHUFFLED = '"offset" % 4'
TEN_DAYS = 864000000

# The watermark by which a batch judges lateness is that of the batch before it: it has seen all but the last two.
ARRIVED = f"""
arrived AS (SELECT *, {SHUFFLED} AS batch_id FROM paid),
newest AS (SELECT batch_id, max(event_time) AS t FROM arrived GROUP BY batch_id),
marks AS (
  SELECT b.batch_id, (SELECT max(t) FROM newest n WHERE n.batch_id < b.batch_id - 1) - {TEN_DAYS} AS mark
  FROM (SELECT DISTINCT batch_id FROM arrived) b
)"""
FAR = """
far AS (
  SELECT * REPLACE (CASE WHEN "offset" % 97 = 20 THEN 400000000000000 ELSE create_time END AS create_time) FROM feed
),"""

SIDE = _with(
    FEED, FAR + DIRTY.replace("FROM feed", "FROM far"),
    f"""
judged AS (
  SELECT "offset", is_bad, routed, order_status = 'paid' AS paid, slot = 20 AS far,
         {_ms('create_time')} < {AS_OF} - 10 * 86400000 - 3600000 AS late
  FROM dirty
)""",
    """SELECT output, "offset" FROM (
  SELECT "offset", unnest(CASE
    WHEN is_bad THEN ['malformed']
    WHEN NOT routed THEN ['other']
    WHEN far THEN ['far_time']
    WHEN paid AND late THEN ['late']
    WHEN paid THEN ['txn', 'user']
    ELSE CAST([] AS VARCHAR[]) END) AS output
  FROM judged
)""",
)

ORACLES: dict[str, str] = {
    "stream_dedup_seen_table": _with(
        FEED, CLEAN, PAID, _first("firsts", "paid", ORDER_KEY, '"offset"'),
        f'SELECT country, order_id, "offset", {BATCH} AS batch_id FROM firsts',
    ),
    "stream_dedup_batches": _with(
        FEED, CLEAN, PAID, f"SELECT country, order_id, min({BATCH}) AS batch_id FROM paid GROUP BY 1, 2"
    ),
    "stream_dedup_ttl_batches": _with(
        FEED, CLEAN, PAID, _first("firsts", "paid", ORDER_KEY, f'{SHUFFLED}, "offset"'),
        f'SELECT country, order_id, "offset", {SHUFFLED} AS batch_id FROM firsts',
    ),
    "stream_dedup_late": _with(
        FEED, CLEAN, PAID, ARRIVED,
        """SELECT country, order_id, min(batch_id) AS batch_id FROM arrived JOIN marks USING (batch_id)
WHERE mark IS NULL OR event_time > mark GROUP BY 1, 2""",
    ),
    "stream_rollup_late": _with(
        FEED, CLEAN, PAID, ARRIVED,
        f"""SELECT date_trunc('minute', epoch_ms(event_time)) AS minute_ts, country, count(*) AS "count"
FROM arrived JOIN marks USING (batch_id)
WHERE (mark IS NULL OR event_time // 60000 * 60000 + 60000 > mark)
  AND event_time // 60000 * 60000 + 60000 <= (SELECT max(event_time) FROM arrived) - {TEN_DAYS}
GROUP BY 1, 2""",
    ),
    "stream_rollup_stored": _with(
        FEED, CLEAN, PAID, RATES, _first("firsts", "paid", ORDER_KEY, f'{SHUFFLED}, "offset"'),
        _rated("rated", "firsts", EVENT_DAY), f"\nall_txn AS (SELECT {TXN_OUT} FROM rated)", TXN_ROLLUP,
        """SELECT minute_ts, country, "count", floor(gmv * 1000000 + 0.123456789) / 1000000 AS gmv,
       floor(gmv_usd * 1000000 + 0.123456789) / 1000000 AS gmv_usd FROM txn_rollup""",
    ),
    "stream_side_outputs": SIDE,
    "stream_bad_counts": _with(
        FEED, DIRTY, f'SELECT {BATCH} AS batch_id, count(*) AS records, count_if(is_bad) AS malformed FROM dirty GROUP BY 1'
    ),
    "stream_txn_records": TXN_JOB,
    "log_index_offsets_for_time": BATCH_FREE["log_offsets_for_time"],
    "log_index_seek": BATCH_FREE["log_seek"],
    "log_index_seek_from_time": BATCH_FREE["log_seek_from_time"],
    "log_index_last_offset": _with(FEED, LOG, LASTS, "SELECT * FROM lasts"),
    "log_lag_of_checkpoint": _with(
        FEED, LOG, f"SELECT topic, CAST(count(*) FILTER ({BATCH} = 3) AS BIGINT) AS lag FROM log GROUP BY 1"
    ),
}
