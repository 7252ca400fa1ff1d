import json

import pytest
from helpers import GOLDEN_NOON, order, rows
from pyspark.sql import functions as F

from ordertide.plans.jobs import TXN, run_job
from ordertide.session import scratch_path, streaming_session
from ordertide.sinks import streams
from ordertide.streaming.metrics import BatchMetrics, bad_record_counts, batch_metrics
from ordertide.streaming.run import run_available
from ordertide.streaming.seen_keys import SeenKeys
from ordertide.streaming.side_outputs import order_outputs, read_output, to_side_outputs
from test_streams import text_stream, write_lines


def lose_commit(checkpoint, batch):
    (checkpoint / "commits" / str(batch)).unlink()
    (checkpoint / "commits" / f".{batch}.crc").unlink(missing_ok=True)


def test_sinks_by_options(monkeypatch):
    made = []
    monkeypatch.setattr(streams, "kafka_records_sink", lambda *a: made.append(a))
    streams.sink_from({"type": "kafka", "servers": "b:1", "topic": "t"}, ["order_id"])
    assert made == [("b:1", "t", ["order_id"], None)]
    for options in ({"type": "folder", "path": "p"}, {"type": "records", "path": "p"}, {"type": "console"}, {"type": "folder", "path": "p", "format": "json"}):
        assert callable(streams.sink_from(options, ["order_id"]))
    with pytest.raises(ValueError, match="type"):
        streams.sink_from({"type": "queue"}, [])
    with pytest.raises(TypeError):
        streams.sink_from({"type": "folder", "way": "p"}, [])


def test_a_job_wants_one_place_to_write(spark, tmp_path):
    write_lines(tmp_path / "in", "a", order())
    stream = text_stream(spark, tmp_path / "in")
    for places in ({}, {"path": "p", "sink": {"type": "console"}}):
        with pytest.raises(ValueError, match="either"):
            run_job("txn", stream, checkpoint="c", **places)


def test_records_of_a_replayed_batch_are_dropped(spark, tmp_path):
    topic, checkpoint = scratch_path(spark, "topic"), tmp_path / "c"
    seen = SeenKeys(scratch_path(spark, "seen"), TXN.keys, buckets=2)

    def run():
        stream = text_stream(spark, tmp_path / "in")
        run_available(run_job("txn", stream, checkpoint=str(checkpoint), seen=seen, sink={"type": "records", "path": topic}, time_filter=False))

    write_lines(tmp_path / "in", "a", order(order_id=1), order(order_id=2))
    run()
    write_lines(tmp_path / "in", "b", order(order_id=2), order(order_id=3))
    run()
    lose_commit(checkpoint, 1)
    run()
    sent = spark.read.parquet(topic)
    assert sent.count() == 4
    once = streams.drop_replays(sent)
    assert sorted(json.loads(r["value"])["order_id"] for r in once.collect()) == [1, 2, 3]
    # The clock is in the value, and still the key of a replayed row is what it was.
    assert len({r["key"] for r in sent.collect()}) == 3
    numbered = sent.withColumn("offset", F.monotonically_increasing_id())
    assert streams.drop_replays(numbered).count() == 3


RECORDS = [
    order(order_id=1), order(order_id=2, order_status="failed"), order(order_id=3, create_time=400000000000000),
    order(order_id=4, create_time=1600000000), "broken", order(order_id=5, event={"database": "user"}),
]


def test_side_outputs_and_their_commits(spark, tmp_path):
    session = streaming_session(spark, 2)
    out, checkpoint = scratch_path(spark, "side"), tmp_path / "c"
    taken, fail = [], [True]

    def sink(name):
        def take(rows_, query, batch_id):
            if name == "late" and fail[0]:
                raise RuntimeError("the sink is away")
            taken.append((name, batch_id, sorted(r["order_id"] for r in rows_.collect())))
        return take

    def run():
        tagged = order_outputs(text_stream(session, tmp_path / "in"), GOLDEN_NOON)
        sinks = {name: sink(name) for name in ("txn", "far_time", "late")}
        run_available(to_side_outputs(tagged, out, str(checkpoint), sinks))

    write_lines(tmp_path / "in", "a", *RECORDS)
    with pytest.raises(Exception, match="away"):
        run()
    assert taken == [("txn", 0, [1]), ("far_time", 0, [3])]
    fail[0] = False
    run()
    assert taken[2:] == [("late", 0, [4])], "the others had theirs"
    write_lines(tmp_path / "in", "b", order(order_id=9))
    run()
    assert taken[3:] == [("txn", 1, [9]), ("far_time", 1, []), ("late", 1, [])]
    texts = {o: [r["value"] for r in read_output(session, out, o).collect()] for o in ("malformed", "other", "user")}
    assert texts["malformed"] == ["broken"] and len(texts["user"]) == 2 and "user" in texts["other"][0]


def test_one_scan_feeds_all_outputs(spark, tmp_path):
    write_lines(tmp_path / "in", "a", *RECORDS)
    table = spark.read.text(str(tmp_path / "in")).withColumn("timestamp", F.lit(0).cast("bigint"))
    plan = order_outputs(table, GOLDEN_NOON)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    counts = dict(rows(order_outputs(table, GOLDEN_NOON).groupBy("output").count()))
    assert counts == {"txn": 1, "user": 1, "late": 1, "far_time": 1, "malformed": 1, "other": 1}


def test_counts_of_each_batch(spark, tmp_path):
    session = streaming_session(spark, 2, idle_batches=False)
    metrics = BatchMetrics(session, scratch_path(spark, "metrics")).start()
    out, checkpoint = scratch_path(spark, "counted"), tmp_path / "c"
    try:
        for n, lines in enumerate((["broken", order(order_id=1)], [order(order_id=2)], ["x", "", "{", order(order_id=3)])):
            write_lines(tmp_path / "in", f"f{n}", *lines)
            writer = TXN.write(text_stream(session, tmp_path / "in"), out, str(checkpoint), as_of=GOLDEN_NOON, observe="orders")
            metrics.wait(run_available(writer))
        lose_commit(checkpoint, 2)
        writer = TXN.write(text_stream(session, tmp_path / "in"), out, str(checkpoint), as_of=GOLDEN_NOON, observe="orders")
        metrics.wait(run_available(writer))
    finally:
        metrics.stop()
    got = bad_record_counts(session, metrics.path, "orders").where("records > 0")
    assert sorted(rows(got.select("batch_id", "records", "malformed"))) == [(0, 2, 1), (1, 1, 0), (2, 4, 3)]
    assert batch_metrics(session, metrics.path).select("query_id").distinct().count() == 1
