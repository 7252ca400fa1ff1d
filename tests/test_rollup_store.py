from datetime import datetime

from helpers import GOLDEN_NOON, order, plan, rows
from pyspark.sql import functions as F

from ordertide.operators.rollup import rollup_minute
from ordertide.plans.jobs import TXN
from ordertide.sinks.rollup_store import RollupStore
from ordertide.streaming.rates import RateSnapshot
from ordertide.streaming.run import run_available
from ordertide.streaming.seen_keys import SeenKeys
from test_streams import text_stream, write_lines

BASE = 1_700_000_400_000  # 2023-11-14 22:20:00 UTC
SCHEMA = "country string, event_time bigint, gmv double, gmv_usd double"


def sales(spark, *data):
    return spark.createDataFrame([(c, BASE + 1000 * s, float(x), x / 4) for c, s, x in data], SCHEMA)


FIRST = [("ID", 0, 1), ("ID", 59, 2), ("SG", 5, 8), ("ID", 3600, 3), ("SG", 7200, 4)]
SECOND = [("ID", 7205, 5), ("SG", 10, 6)]
LATE = [("ID", 3, 16), (None, 3601, 32), ("ID", 3600, 64)]


def whole(spark, *parts):
    return sorted(rows(rollup_minute(sales(spark, *[r for p in parts for r in p]))), key=str)


def test_segments_add_up_and_replays_do_not(spark, tmp_path):
    store = RollupStore(str(tmp_path / "r"))
    assert rows(store.read(spark)) == []
    store.add(sales(spark, *FIRST), "q", 0)
    store.add(sales(spark, *SECOND, *LATE), "q", 1)
    store.add(sales(spark, *SECOND), "q", 1)  # the batch runs again and has other rows of the hour
    assert sorted(rows(store.read(spark)), key=str) == whole(spark, FIRST, SECOND)
    store.add(sales(spark, *LATE), "other", 0)
    assert sorted(rows(store.read(spark)), key=str) == whole(spark, FIRST, SECOND, LATE)


def test_compaction_before_and_after_late_rows(spark, tmp_path):
    store = RollupStore(str(tmp_path / "r"))
    store.add(sales(spark, *FIRST), "q", 0)
    store.add(sales(spark, *SECOND), "q", 1)
    assert store.compact(spark) == 2, "the hours of both segments"
    assert len(list((tmp_path / "r" / "deltas").iterdir())) == 1, "the first segment has an hour of its own"
    assert sorted(rows(store.read(spark)), key=str) == whole(spark, FIRST, SECOND)
    store.add(sales(spark, *LATE), "q", 2)
    assert sorted(rows(store.read(spark)), key=str) == whole(spark, FIRST, SECOND, LATE)
    assert store.compact(spark, before=datetime(2023, 11, 14, 23)) == 1
    assert store.compact(spark) == 1 and store.compact(spark) == 0
    assert sorted(rows(store.read(spark)), key=str) == whole(spark, FIRST, SECOND, LATE)
    assert list((tmp_path / "r" / "deltas").iterdir()) == []
    # The replay of a batch that is folded already changes nothing.
    store.add(sales(spark, *LATE), "q", 2)
    assert sorted(rows(store.read(spark)), key=str) == whole(spark, FIRST, SECOND, LATE)


def test_a_fold_that_was_cut_off_does_not_count(spark, tmp_path):
    store = RollupStore(str(tmp_path / "r"))
    store.add(sales(spark, *FIRST), "q", 0)
    store.add(sales(spark, *FIRST), "q", 1)
    kept = {p: p.read_bytes() for p in (tmp_path / "r" / "deltas").rglob("*") if p.is_file()}
    store.compact(spark)
    want = whole(spark, FIRST, FIRST)

    def back():
        for p, b in kept.items():
            p.parent.mkdir(exist_ok=True, parents=True)
            p.write_bytes(b)

    # The state is complete, but what it replaces is not removed yet.
    back()
    assert sorted(rows(store.read(spark)), key=str) == want
    # The state is not complete yet.
    (tmp_path / "r" / "folds" / "000000" / "current" / "_SUCCESS").unlink()
    assert sorted(rows(store.read(spark)), key=str) == want
    store.compact(spark)
    assert sorted(rows(store.read(spark)), key=str) == want


def test_only_the_hours_asked_for_are_read(spark, tmp_path):
    store = RollupStore(str(tmp_path / "r"))
    store.add(sales(spark, *FIRST), "q", 0)
    got = store.read(spark, datetime(2023, 11, 14, 23, 10), datetime(2023, 11, 14, 23, 30))
    assert [r["gmv"] for r in got.collect()] == [3.0]
    assert "PushedFilters: [IsNotNull(minute_ts), GreaterThanOrEqual(minute_ts" in plan(got)
    assert got.schema["minute_ts"].dataType.typeName() == "timestamp_ntz"
    assert store.read(spark, datetime(2024, 1, 1), datetime(2024, 1, 2)).count() == 0


def test_other_dimensions_and_counts_alone(spark, tmp_path):
    store = RollupStore(str(tmp_path / "r"), metrics=(), dimensions=("shop",), types={"shop": "int"})
    data = spark.createDataFrame([(1, BASE), (1, BASE + 1), (2, BASE), (3, 400000000000000)], "shop int, event_time bigint")
    store.add(data, "q", 0)
    store.add(data.where("shop = 2"), "q", 1)
    assert sorted(rows(store.read(spark).select("shop", "count"))) == [(1, 2), (2, 2)]
    assert store.read(spark).agg(F.sum("count")).head()[0] == 4


def test_a_stream_rolls_up_with_the_rates_of_each_batch(spark, tmp_path):
    """De-duplication, rates and roll-up in one stream, in which a rate changes between two batches."""
    store, path = RollupStore(str(tmp_path / "r")), str(tmp_path / "rates")
    seen = SeenKeys(str(tmp_path / "seen"), TXN.keys, buckets=2)
    rates = RateSnapshot(lambda: spark.read.parquet(path), 0.0)

    def run(name, rate, *ids):
        quote = spark.createDataFrame([("PH", rate)], "country string, rate double")
        quote.withColumn("rate_date", F.to_date(F.lit("2022-01-11"))).write.mode("append").parquet(path)
        write_lines(tmp_path / "in", name, *[order(order_id=i, gmv=10.0) for i in ids])
        run_available(TXN.write(
            text_stream(spark, tmp_path / "in"), checkpoint=str(tmp_path / "c"), rates=rates, as_of=GOLDEN_NOON,
            sink=store.add, seen=seen,
        ))
        return [(r["country"], r["count"], r["gmv"], r["gmv_usd"]) for r in store.read(spark).collect()]

    assert run("a", 1.0, 1, 2, 2) == [("PH", 2, 20.0, 20.0)]
    assert run("b", 2.0, 2, 3) == [("PH", 3, 30.0, 40.0)]
    store.compact(spark)
    assert run("c", 4.0, 1, 4) == [("PH", 4, 40.0, 80.0)]
