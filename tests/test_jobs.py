import dataclasses
import json

import pytest
from helpers import GOLDEN, GOLDEN_NOON, order, plan, record_table, rows
from pyspark.sql import functions as F

from ordertide.operators.dedup import first_per_key, first_unseen, not_seen
from ordertide.operators.filters import in_interval, reject_late, today
from ordertide.operators.rates import effective_rates, enrich_usd, lookup
from ordertide.plans.jobs import JOBS, TXN, TXN_TTL, TXN_USER, output_records, run_job, run_sql
from ordertide.sources.files import read_table

TXN_ROW = (3174.6346553637804, 7699329, 659334, "PH", 1641885053000)


def rate_table(spark, *quotes):
    df = spark.createDataFrame(list(quotes), "country string, day string, rate double")
    return df.select("country", F.to_date("day").alias("rate_date"), "rate")


@pytest.mark.parametrize("name", ["txn", "txn_ttl"])
def test_transaction_job(spark, name):
    got = rows(run_job(name, record_table(spark, order()), as_of=GOLDEN_NOON))
    assert got == [(*TXN_ROW, GOLDEN_NOON, 0.0)]


@pytest.mark.parametrize("name", sorted(JOBS))
def test_unpaid_orders_are_left_out(spark, name):
    assert rows(run_job(name, record_table(spark, order(order_status="processing")), as_of=GOLDEN_NOON)) == []


def test_user_job(spark):
    got = rows(run_job("txn_user", record_table(spark, order()), as_of=GOLDEN_NOON))
    assert got == [(659334, "PH", 1641885053000, GOLDEN_NOON, "2022-01-11")]


def test_a_job_with_its_own_hook(spark):
    """Records of another shape pass a hook of the job's own before everything else, here one that makes two orders of each."""

    def parse(records):
        pair = F.array(F.col("value").cast("bigint"), F.col("value").cast("bigint") + 1)
        return records.select(
            F.lit(GOLDEN["create_time"]).alias("create_time"), F.lit("PHP").alias("currency"), F.lit("paid").alias("order_status"),
            F.lit(7).alias("user_id"), F.explode(pair).alias("order_id"), F.lit(1.5).alias("gmv"),
        )

    job = dataclasses.replace(TXN, parse=parse)
    got = rows(job.batch(record_table(spark, "1", "5", "6"), as_of=GOLDEN_NOON).select("order_id", "country", "gmv"))
    assert sorted(got) == [(1, "PH", 1.5), (2, "PH", 1.5), (5, "PH", 1.5), (6, "PH", 1.5), (7, "PH", 1.5)]


def test_old_orders_are_filtered(spark):
    assert rows(TXN_TTL.batch(record_table(spark, order()), as_of=GOLDEN_NOON + 86_400_000)) == []
    assert len(rows(TXN_TTL.batch(record_table(spark, order()), time_filter=False))) == 1


def test_the_clock_is_the_current_time_by_default(spark):
    import time

    now = int(time.time())
    assert len(rows(TXN.batch(record_table(spark, order(create_time=now))))) == 1
    assert rows(TXN.batch(record_table(spark, order(create_time=now - 86_400)))) == []


def test_same_order_twice(spark):
    values = order(), order(create_time=GOLDEN["create_time"] - 5000, gmv=1.0)
    got = rows(TXN_TTL.batch(record_table(spark, *values), as_of=GOLDEN_NOON, arrival=("offset",)))
    assert [r[0] for r in got] == [GOLDEN["gmv"]]
    got = rows(TXN_TTL.batch(record_table(spark, *values), as_of=GOLDEN_NOON))
    assert [r[0] for r in got] == [1.0]


def test_keys_do_not_collide_when_joined(spark):
    # Joined without a separator both keys would read MY11.
    a = order(currency="MYR", user_id=1, order_id=11)
    b = order(currency="MYR", user_id=11, order_id=1)
    assert TXN.batch(record_table(spark, a, b), as_of=GOLDEN_NOON).count() == 2


def test_output_records(spark):
    out = output_records(TXN.batch(record_table(spark, order()), as_of=GOLDEN_NOON), TXN.keys).first()
    assert (out.event_time, out.rowkey) == (1641885053000, "PH7699329")
    assert list(json.loads(out.value)) == list(TXN.columns)


def test_rates_fall_back_by_one_day(spark):
    rates = rate_table(spark, ("PH", "2022-01-10", 0.02), ("ID", "2022-01-09", 0.5), ("MY", "2022-01-11", 0.24))
    df = spark.createDataFrame([("PH", 100.0), ("ID", 100.0), ("MY", 100.0), ("", 1.0)], "country string, gmv double")
    df = df.withColumn("event_time", F.lit(GOLDEN_NOON))
    got = dict(enrich_usd(df, rates, as_of=GOLDEN_NOON).select("country", "gmv_usd").collect())
    assert got == {"PH": 2.0, "ID": 0.0, "MY": 24.0, "": 0.0}
    got = dict(enrich_usd(df, rates, "event", tolerance_days=2).select("country", "gmv_usd").collect())
    assert got["ID"] == 50.0


def test_repeated_rates_do_not_multiply_rows(spark):
    rates = rate_table(spark, ("PH", "2022-01-11", 0.02), ("PH", "2022-01-11", 0.03))
    versions = rates.withColumn("v", -F.col("rate"))
    assert rows(effective_rates(rates, 0).select("rate")) == [(0.03,)]
    assert rows(effective_rates(versions, 0, "v").select("rate")) == [(0.02,)]


def test_enrichment_does_not_shuffle_the_orders(spark, sf):
    rates = rate_table(spark, ("PH", "2022-01-11", 0.02))
    events = read_table(spark, sf, "events").select(
        F.col("event_type").alias("country"), F.col("value").alias("gmv"), F.col("event_id").alias("event_time")
    )
    text = plan(enrich_usd(events, rates, as_of=GOLDEN_NOON))
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text


def test_large_lookup_table_is_joined_with_salt(spark):
    df = spark.range(1000).select(F.lit("hot").alias("k"), "id")
    table = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    got = lookup(df, table, {"k": "k"}, ["v"], broadcast_rows=1, salts=8)
    assert got.columns == ["k", "id", "v"]
    assert rows(got.agg(F.count("*"), F.min("v"), F.max("v"))) == [(1000, 1, 1)]
    assert "broadcast" not in got._jdf.queryExecution().optimizedPlan().toString().lower()


def test_sql_job_with_rates(spark):
    session = spark.newSession()
    orders = session.createDataFrame([("PHP", 1641885053, 100.0, "paid")], "currency string, create_time bigint, gmv double, order_status string")
    rates = rate_table(session, ("PH", "2022-01-10", 0.02))
    text = "SELECT gmv * get_exchange_rate(currency_to_country(currency), '2022-01-11') FROM order_tab"
    assert rows(run_sql(session, text, orders, rates)) == [(2.0,)]
    assert rows(run_sql(session, text.replace("2022-01-11", "no date"), orders, rates)) == [(0.0,)]


def test_time_filters(spark):
    now = GOLDEN_NOON
    df = spark.createDataFrame([(now,), (now - 86_400_000,), (now - 3_600_001,), (now + 43_200_000,)], "event_time bigint")
    assert sorted(rows(today(df, now))) == [(now - 3_600_001,), (now,)]
    assert sorted(rows(reject_late(df, now))) == [(now,), (now + 43_200_000,)]
    assert rows(in_interval(df, now, now + 1, "event_time")) == [(now,)]


def test_stored_time_bounds_reach_the_scan(spark, sf):
    from datetime import datetime

    events = read_table(spark, sf, "events")
    text = plan(in_interval(events, datetime(2024, 1, 5), datetime(2024, 1, 6), "ts").select("event_id"))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00" in text and "LessThan(ts,2024-01-06T00:00" in text
    # In 1970 Singapore was 7:30 hours ahead of UTC.
    text = plan(today(events.select("user_id", "event_id"), 1000, event_time="event_id"))
    assert "GreaterThanOrEqual(event_id,-27000000)" in text and "LessThan(event_id,59400000)" in text


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 9, "c")], "k int, t int, v string")
    assert sorted(rows(first_per_key(df, ["k"], ["t"]))) == [(1, 3, "a"), (2, 9, "c")]
    assert sorted(rows(first_per_key(df, ["k"], ["t"], largest=True))) == [(1, 5, "b"), (2, 9, "c")]
    assert sorted(rows(first_per_key(df.drop("v"), ["k"], ["t"]))) == [(1, 3), (2, 9)]


def test_hot_keys_are_cut_before_the_shuffle(spark):
    df = spark.range(10).select(F.pmod("id", F.lit(2)).alias("k"), "id", F.md5(F.col("id").cast("string")).alias("v"))
    text = plan(first_per_key(df, ["k"], ["id"]))
    assert text.index("Exchange") < text.index("row_number(), 1, Partial")
    text = plan(first_per_key(df.drop("v"), ["k"], ["id"]))
    assert "partial_min" in text and "Sort" not in text


def test_unseen_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (2, 4)], "k int, t int")
    seen = spark.createDataFrame([(2,), (None,)], "k int")
    assert sorted(rows(not_seen(df, seen, ["k"]))) == [(1, 1), (1, 2)]
    fresh, keys = first_unseen(df, seen, ["k"], ["t"])
    assert (rows(fresh), rows(keys)) == ([(1, 1)], [(1,)])


def test_user_job_needs_no_sort(spark):
    text = plan(TXN_USER.batch(record_table(spark, order()), as_of=GOLDEN_NOON))
    assert "partial_min" in text and "Window" not in text
