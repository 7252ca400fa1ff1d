from datetime import datetime

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from ordertide.operators import keyed_table as kv
from ordertide.operators.rollup import country_totals, hourly_totals, rollup_minute, with_hour
from ordertide.sinks.tables import write_rollup
from ordertide.sources import kafka
from ordertide.sources import record_log as log
from ordertide.sources.files import records


@pytest.fixture()
def table(spark):
    return spark.createDataFrame([("a", "A", 1.0), ("b", "B", None), ("c", None, 3.0)], "rowkey string, name string, v double")


def requests(spark, *r):
    return spark.createDataFrame(list(r), "rowkey string, v double, seq int")


def test_scan_and_get(spark, table):
    assert sorted(rows(kv.scan(table, "v"))) == [("a", 1.0), ("c", 3.0)]
    keys = spark.createDataFrame([("a",), ("a",), ("b",), ("z",)], "rowkey string")
    assert sorted(rows(kv.get(keys, table, "v")), key=str) == [("a", 1.0), ("a", 1.0), ("b", None), ("z", None)]


def test_put_last_write_wins(spark, table):
    got = kv.put(table, requests(spark, ("a", 7.0, 1), ("a", 8.0, 2), ("z", 9.0, 1)), "v", ["seq"])
    assert sorted(rows(got)) == [("a", "A", 8.0), ("b", "B", None), ("c", None, 3.0), ("z", None, 9.0)]


def test_deletes(spark, table):
    keys = spark.createDataFrame([("a",), ("c",), ("c",), ("z",)], "rowkey string")
    assert rows(kv.delete_rows(table, keys)) == [("b", "B", None)]
    # Row c has no other cell, so it is gone with it.
    assert sorted(rows(kv.delete_cells(table, keys, "v"))) == [("a", "A", None), ("b", "B", None)]


def test_put_if_absent(spark, table):
    asked = requests(spark, ("a", 7.0, 1), ("b", 8.0, 2), ("b", 9.0, 1), ("z", 5.0, 3), ("z", 6.0, 4))
    after, results = kv.put_if_absent(table, asked, "v", ["seq"])
    assert sorted(rows(results)) == [
        ("a", 7.0, 1, False), ("b", 8.0, 2, False), ("b", 9.0, 1, True), ("z", 5.0, 3, True), ("z", 6.0, 4, False)
    ]
    assert sorted(rows(after)) == [("a", "A", 1.0), ("b", "B", 9.0), ("c", None, 3.0), ("z", None, 5.0)]


def test_check_and_put(spark, table):
    asked = spark.createDataFrame(
        [("a", 1.0, 10.0), ("b", 0.0, 11.0), ("c", 2.0, 12.0), ("z", None, 13.0)], "rowkey string, expected double, value double"
    )
    after, results = kv.check_and_put(table, asked, "v")
    assert {r.rowkey: r.applied for r in results.collect()} == {"a": True, "b": False, "c": False, "z": True}
    assert sorted(rows(after)) == [("a", "A", 10.0), ("b", "B", None), ("c", None, 3.0), ("z", None, 13.0)]


def test_check_and_delete(spark, table):
    asked = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0)], "rowkey string, expected double")
    after, results = kv.check_and_delete(table, asked, "v")
    assert {r.rowkey: r.applied for r in results.collect()} == {"a": True, "b": True, "c": False}
    assert sorted(rows(after)) == [("a", "A", None), ("b", "B", None), ("c", None, 3.0)]


def test_conditional_requests_must_be_unique(spark, table):
    asked = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 3.0)], "rowkey string, expected double, value double")
    with pytest.raises(Exception, match="more than one conditional request for key a"):
        kv.check_and_put(table, asked, "v")[1].collect()


def test_bucketed_table_is_not_shuffled_again(spark, table, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS kvdb LOCATION '{tmp_path}'")
    kv.save_bucketed(table, "kvdb.t", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = spark.table("kvdb.t")
        text = plan(kv.delete_rows(stored, stored.select("rowkey")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP DATABASE kvdb CASCADE")
    assert "Exchange" not in text


def test_rollup_and_reports(spark, tmp_path):
    minute = 1705377600000
    df = spark.createDataFrame(
        [(minute, "ID", 1.0, 0.5), (minute + 59_999, "ID", 2.0, 0.5), (minute + 60_000, "ID", 4.0, 1.0), (minute, "MY", 8.0, 2.0)],
        "event_time bigint, country string, gmv double, gmv_usd double",
    )
    rollup = rollup_minute(df)
    t = datetime(2024, 1, 16, 4)
    assert sorted(rows(rollup)) == [
        (t, "ID", 2, 3.0, 1.0), (t, "MY", 1, 8.0, 2.0), (datetime(2024, 1, 16, 4, 1), "ID", 1, 4.0, 1.0)
    ]
    assert sorted(rows(hourly_totals(rollup, t, datetime(2024, 1, 16, 4, 1)))) == [
        (t, "ID", 2.0, 3.0, 1.0), (t, "MY", 1.0, 8.0, 2.0)
    ]
    assert sorted(rows(country_totals(rollup))) == [("ID", 7.0, 2.0, 3), ("MY", 8.0, 2.0, 1)]
    assert with_hour(rollup).select("hour").distinct().count() == 1
    write_rollup(rollup, str(tmp_path / "r"))
    stored = spark.read.parquet(str(tmp_path / "r")).withColumn("hour", F.col("hour").cast("timestamp_ntz"))
    assert hourly_totals(stored, t, datetime(2024, 1, 16, 5)).count() == 2


@pytest.fixture()
def record_log(spark):
    data = [("t", 0, 0, 1000, "a"), ("t", 0, 1, 5000, "b"), ("t", 1, 0, 2000, "c"), ("u", 0, 7, 9000, "d")]
    return spark.createDataFrame(
        [(t, p, o, ms + 1_700_000_000_000, v) for t, p, o, ms, v in data],
        "topic string, partition int, offset bigint, timestamp bigint, value string",
    )


def test_offsets_for_time(record_log):
    got = log.offsets_for_time(record_log, 1_700_000_003)
    assert sorted(rows(got)) == [("t", 0, 1), ("t", 1, -1), ("u", 0, 7)]
    assert rows(log.offsets_json(got)) == [('{"t":{"0":1,"1":-1},"u":{"0":7}}',)]
    assert {r[2] for r in rows(log.offsets_for_time(record_log, 0))} == {-1}


def test_seek(spark, record_log):
    def values(df):
        return sorted(r.value for r in df.collect())

    assert values(log.seek_to_beginning(record_log)) == ["a", "b", "c", "d"]
    assert values(log.seek(record_log, 1)) == ["b", "d"]
    assert values(log.seek(record_log, [1, 0])) == ["b", "c", "d"]
    # A partition without an offset is skipped; the others are still read.
    assert values(log.seek(record_log, [None, 0])) == ["c"]
    assert values(log.seek(record_log, [None])) == []
    assert values(log.seek_from_time(record_log, 1_700_000_003_000)) == ["b", "d"]


def test_lag(spark, record_log):
    committed = spark.createDataFrame([("t", 0, 1)], "topic string, partition int, offset bigint")
    last = log.last_offsets(record_log)
    assert sorted(rows(log.offset_lag(last, log.committed_offsets(committed)))) == [("t", 2), ("u", 8)]
    progress = {"sources": [{"endOffset": {"t": {"0": 5}}}, {"endOffset": None}]}
    assert log.progress_offsets(progress) == {"t": {"0": 5}}


def test_kafka_options():
    base = {"kafka.bootstrap.servers": "b:9092", "subscribe": "x,y", "failOnDataLoss": "false"}
    assert kafka.source_options("b:9092", "x,y") == {**base, "startingOffsets": "latest"}
    assert kafka.source_options("b:9092", "x,y", kafka.EARLIEST)["startingOffsets"] == "earliest"
    assert kafka.source_options("b:9092", "x,y", 0)["startingOffsets"] == "latest"
    timed = kafka.source_options("b:9092", "x,y", 1_700_000_000, max_offsets_per_trigger=1000)
    assert timed == {
        **base, "startingTimestamp": "1700000000000", "startingOffsetsByTimestampStrategy": "latest",
        "maxOffsetsPerTrigger": "1000",
    }
    bounded = kafka.source_options("b:9092", "x,y", -1, 1_700_000_000_000, max_offsets_per_trigger=1000)
    assert bounded == {**base, "startingOffsets": "earliest", "endingTimestamp": "1700000000000"}
    assert kafka.source_options("b:9092", "o.*", pattern=True)["subscribePattern"] == "o.*"
    auth = kafka.source_options("b:9092", "x", auth=kafka.KafkaAuth(jaas="j"))
    assert auth["kafka.security.protocol"] == "SASL_PLAINTEXT" and auth["kafka.sasl.mechanism"] == "PLAIN"
    assert auth["kafka.sasl.jaas.config"] == "j"
    assert kafka.end_options(-1) == {"endingOffsets": "latest"}


def test_records(spark):
    df = spark.sql("SELECT CAST('x' AS BINARY) AS value, timestamp_millis(1999) AS timestamp, 3 AS partition")
    assert rows(records(df, ["partition"])) == [("x", 1, 3)]


def test_far_times_neither_stop_a_rollup_nor_vanish(spark):
    from ordertide.operators.rollup import far_times, rollup_minute

    data = [(1641885053000, "ID", 1.0), (10**17, "ID", 2.0), (-(10**17), "PH", 3.0)]
    df = spark.createDataFrame(data, "event_time bigint, country string, gmv double")
    assert [(r["country"], r["count"], r["gmv"]) for r in rollup_minute(df, ["gmv"]).collect()] == [("ID", 1, 1.0)]
    assert sorted(r["gmv"] for r in far_times(df).collect()) == [2.0, 3.0]
