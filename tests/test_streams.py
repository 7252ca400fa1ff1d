import json
import time

from helpers import GOLDEN_NOON, order, rows
from pyspark.sql import functions as F

from ordertide.plans.jobs import JOBS, TXN, TXN_USER
from ordertide.session import scratch_path, streaming_session
from ordertide.sinks.streams import kafka_sink_options, to_batches, to_console, to_files, to_memory
from ordertide.sources.kafka import KafkaAuth
from ordertide.streaming import dedup
from ordertide.streaming.event_time import with_event_time, with_time_attributes
from ordertide.streaming.rates import RateSnapshot
from ordertide.streaming.run import drain_to_table, run_available, run_with_refresh


def write_lines(folder, name, *values):
    folder.mkdir(exist_ok=True)
    part = folder.parent / f"{name}.tmp"
    part.write_text("\n".join(values) + "\n")
    part.rename(folder / name)


def text_stream(session, folder):
    return session.readStream.text(str(folder)).withColumn("timestamp", F.lit(0).cast("bigint"))


VALUES = [order(order_id=i % 5, user_id=i % 3) for i in range(20)] + ["broken", order(order_status="failed")]


def test_stream_equals_batch(spark, tmp_path):
    session = streaming_session(spark, 2)
    write_lines(tmp_path / "in", "a", *VALUES)
    batch = session.read.text(str(tmp_path / "in")).withColumn("timestamp", F.lit(0).cast("bigint"))
    for job in (TXN, TXN_USER):
        def finish(rows_, job=job):
            return job.finish(rows_, None, GOLDEN_NOON, "Asia/Singapore")

        streamed = drain_to_table(job.stream(text_stream(session, tmp_path / "in"), GOLDEN_NOON), job.name, finish)
        keys = list(job.keys)
        expected = job.batch(batch, as_of=GOLDEN_NOON).select(keys)
        assert sorted(rows(streamed.select(keys))) == sorted(rows(expected))
        assert streamed.columns == list(job.columns)


def test_restart_neither_repeats_nor_loses(spark, tmp_path):
    session = streaming_session(spark, 2)
    out, checkpoint = scratch_path(spark, "restart"), scratch_path(spark, "restart-c")

    def run():
        run_available(TXN.write(text_stream(session, tmp_path / "in"), out, checkpoint, as_of=GOLDEN_NOON))
        return sorted(r.order_id for r in session.read.parquet(out).collect())

    write_lines(tmp_path / "in", "a", order(order_id=1), order(order_id=2))
    assert run() == [1, 2]
    write_lines(tmp_path / "in", "b", order(order_id=2), order(order_id=3))
    assert run() == [1, 2, 3]
    assert run() == [1, 2, 3]


def test_replayed_batch_overwrites_itself(spark, tmp_path):
    """A batch whose commit was lost runs again from the same checkpoint."""
    session = streaming_session(spark, 2)
    out, checkpoint = scratch_path(spark, "replay"), tmp_path / "replay-c"
    write_lines(tmp_path / "in", "a", "x", "y")
    for _ in range(2):
        run_available(to_batches(text_stream(session, tmp_path / "in"), out, str(checkpoint)))
        for commit in (checkpoint / "commits").glob("*0*"):
            commit.unlink()
    assert sorted(r.value for r in session.read.parquet(out).collect()) == ["x", "y"]


def test_new_checkpoint_erases_nothing(spark, tmp_path):
    session = streaming_session(spark, 2)
    out = scratch_path(spark, "restarted")
    for name, line in (("a", "x"), ("b", "y")):
        write_lines(tmp_path / name, "f", line)
        run_available(to_batches(text_stream(session, tmp_path / name), out, scratch_path(spark, f"new-{name}")))
    assert sorted(r.value for r in session.read.parquet(out).collect()) == ["x", "y"]


def test_ttl(spark, tmp_path):
    session = streaming_session(spark, 2, idle_batches=False)
    out, checkpoint = scratch_path(spark, "ttl"), scratch_path(spark, "ttl-c")

    def run(name):
        write_lines(tmp_path / "in", name, "k")
        kept = dedup.with_ttl(session.readStream.text(str(tmp_path / "in")), ["value"], ttl_ms=15_000)
        run_available(to_files(kept, out, checkpoint))
        return session.read.schema("value string").parquet(out).count()

    assert run("a") == 1
    first = time.time()
    assert run("b") == 1, "still alive, also after a restart"
    assert time.time() - first < 15, "too slow for the check above"
    time.sleep(max(0.0, first + 16 - time.time()))
    assert run("c") == 2, "expired, so let through again"


def test_ttl_takes_the_least_of_a_batch(spark, tmp_path):
    session = streaming_session(spark, 2, idle_batches=False)
    write_lines(tmp_path / "in", "a", "3", "1", "2")
    rows_ = session.readStream.text(str(tmp_path / "in")).select(F.lit("k").alias("k"), "value")
    kept = dedup.with_ttl(rows_, ["k"], order_by="value")
    assert rows(drain_to_table(kept, "ttl-least")) == [("k", "1")]


def test_collapse_keeps_one_row_per_key_and_order(spark):
    df = spark.range(10_000, numPartitions=1).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 7).cast("string")).alias("k"), "id"
    )
    got = rows(dedup.collapse_repeats(df, ["k"]))
    assert {k: i for k, i in got} == {None: 0, "1": 1, "2": 2, "4": 4, "5": 5, "0": 7, "3": 10, "6": 13}
    assert len(got) == 8


def test_late_rows(spark, tmp_path):
    session = streaming_session(spark, 2)
    def stream(folder):
        parsed = session.readStream.option("maxFilesPerTrigger", 1).text(str(folder))
        return with_event_time(parsed.select(F.col("value").cast("bigint").alias("t")), "t", None)

    write_lines(tmp_path / "in", "a", "1700007200")
    time.sleep(1.1)
    write_lines(tmp_path / "in", "b", "1700000000")
    assert drain_to_table(dedup.forever(stream(tmp_path / "in"), ["t"]), "late").count() == 2
    within = dedup.within_watermark(stream(tmp_path / "in"), ["t"], "event_ts", "10 minutes")
    time.sleep(1.1)
    write_lines(tmp_path / "in", "c", "1700000001")
    assert drain_to_table(within, "late-w").count() < 3


def test_rate_snapshot_is_read_again_when_old(spark):
    now, loads = [0.0], []

    def load():
        loads.append(now[0])
        return spark.sql("SELECT 'PH' AS country, DATE'2022-01-11' AS rate_date, 1.0D AS rate")

    snapshot = RateSnapshot(load, 60.0, clock=lambda: now[0])
    for now[0] in (0.0, 59.0, 60.0, 61.0, 200.0):
        assert snapshot.current().count() == 2
    assert loads == [0.0, 60.0, 200.0]


def test_stream_sees_rates_added_later(spark, tmp_path):
    session = streaming_session(spark, 2)
    out, checkpoint, path = scratch_path(spark, "fresh"), scratch_path(spark, "fresh-c"), str(tmp_path / "rates")

    def add_rate(rate):
        quote = spark.createDataFrame([("PH", rate)], "country string, rate double")
        quote.withColumn("rate_date", F.to_date(F.lit("2022-01-11"))).write.mode("append").parquet(path)

    snapshot = RateSnapshot(lambda: session.read.parquet(path), 0.0)
    query = None
    try:
        add_rate(1.0)
        write_lines(tmp_path / "in", "a", order(order_id=1, gmv=10.0))
        writer = TXN.write(
            text_stream(session, tmp_path / "in"), out, checkpoint, snapshot, trigger="1 second", as_of=GOLDEN_NOON
        )
        query = writer.start()
        query.processAllAvailable()
        add_rate(2.0)
        write_lines(tmp_path / "in", "b", order(order_id=2, gmv=10.0))
        query.processAllAvailable()
    finally:
        if query:
            query.stop()
    assert dict(session.read.parquet(out).select("order_id", "gmv_usd").collect()) == {1: 10.0, 2: 20.0}


def test_refresh_plans_each_round_anew(spark, tmp_path):
    session = streaming_session(spark, 2)
    out, checkpoint, made = scratch_path(spark, "refresh"), scratch_path(spark, "refresh-c"), []
    write_lines(tmp_path / "in", "a", "x")

    def make():
        made.append(1)
        return to_files(text_stream(session, tmp_path / "in"), out, checkpoint, trigger="200 milliseconds")

    assert run_with_refresh(make, 6.0, rounds=2) == 2 and len(made) == 2
    assert [r.value for r in session.read.parquet(out).collect()] == ["x"]
    assert run_with_refresh(lambda: to_files(text_stream(session, tmp_path / "in"), out, checkpoint), 60.0) == 1


def test_plain_sinks(spark, tmp_path):
    session = streaming_session(spark, 2)
    write_lines(tmp_path / "in", "a", "x")
    run_available(to_memory(text_stream(session, tmp_path / "in"), "seen"))
    assert session.table("seen").count() == 1
    run_available(to_console(text_stream(session, tmp_path / "in"), trigger=None))
    assert kafka_sink_options("b:1", "t", KafkaAuth()) == {
        "kafka.bootstrap.servers": "b:1", "topic": "t",
        "kafka.security.protocol": "SASL_PLAINTEXT", "kafka.sasl.mechanism": "PLAIN",
    }


def test_time_attributes(spark):
    df = spark.createDataFrame([(1700000000,), (1700000000123,)], "t bigint")
    got = with_time_attributes(df, "t").select(F.unix_millis("t_rowtime"), F.col("proctime").isNotNull())
    assert rows(got) == [(1700000000000, True), (1700000000123, True)]


def test_job_names():
    assert sorted(JOBS) == ["txn", "txn_ttl", "txn_user"]
    assert json.loads(order())["event"] == {"database": "order"}
