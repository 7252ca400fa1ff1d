import time

import pytest
from helpers import rows

from ordertide.session import scratch_path, streaming_session
from ordertide.sinks.streams import folder_sink, to_files, to_sink
from ordertide.sources.log_index import LogIndex
from ordertide.streaming import dedup, progress
from ordertide.streaming.run import run_available
from test_streams import write_lines


def test_lag_by_files(spark, tmp_path):
    path, checkpoint = str(tmp_path / "log"), tmp_path / "c"
    log = lambda n, topic: spark.range(n).selectExpr(f"'{topic}' AS topic", "0 AS partition", "id AS offset", "id AS timestamp")
    run = lambda: run_available(to_sink(spark.readStream.schema(log(0, "a").schema).parquet(path), str(checkpoint), folder_sink(scratch_path(spark, "o"))))
    index = LogIndex(spark, path, str(tmp_path / "index"))

    def lag():
        index.refresh()
        return dict(rows(progress.file_lag(index, str(checkpoint))))

    log(5, "a").union(log(3, "b")).coalesce(1).write.mode("append").parquet(path)
    assert progress.committed_batch(spark, str(checkpoint)) is None and lag() == {"a": 5, "b": 3}
    run()
    assert progress.committed_batch(spark, str(checkpoint)) == 0 and lag() == {"a": 0, "b": 0}
    log(7, "a").coalesce(1).write.mode("append").parquet(path)
    assert lag() == {"a": 7, "b": 0}
    run()
    assert lag() == {"a": 0, "b": 0}
    # A batch that has begun but is not committed does not count.
    (checkpoint / "commits" / "1").unlink()
    assert lag() == {"a": 7, "b": 0}


def test_lag_by_offsets(spark, tmp_path):
    """The offset and commit logs of a query over two topics, as Spark writes them."""
    for kind, batch, text in (
        ("offsets", 4, 'v1\n{"batchWatermarkMs":0}\n{"order":{"1":40,"0":7}}\n{"user":{"0":3}}\n-'),
        ("offsets", 5, 'v1\n{"batchWatermarkMs":0}\n{"order":{"1":90,"0":70}}\n{"user":{"0":30}}\n-'),
        ("commits", 4, 'v1\n{"nextBatchWatermarkMs":0}'),
    ):
        (tmp_path / kind).mkdir(exist_ok=True)
        (tmp_path / kind / str(batch)).write_text(text)
    got = progress.checkpoint_offsets(spark, str(tmp_path))
    assert sorted(rows(got)) == [("order", 0, 7), ("order", 1, 40), ("user", 0, 3)]
    last = spark.createDataFrame([("order", 0, 10), ("order", 1, 40), ("user", 0, 9), ("new", 0, 2)], "topic string, partition int, last_offset bigint")
    assert dict(rows(progress.topic_lag(last, spark, str(tmp_path)))) == {"order": 3, "user": 6, "new": 2}


def test_a_key_in_use_is_not_forgotten(spark, tmp_path):
    """By the time after which an untouched key is forgotten, a key seen meanwhile is still known."""
    session = streaming_session(spark, 2, idle_batches=False)
    out, checkpoint = scratch_path(spark, "idle"), scratch_path(spark, "idle-c")
    ttl = 30.0

    def run(name, *keys):
        """When it began and ended, and what came out so far."""
        began = time.time()
        write_lines(tmp_path / "in", name, *keys)
        kept = dedup.with_ttl(session.readStream.text(str(tmp_path / "in")), ["value"], ttl_ms=int(1000 * ttl), renew=True)
        run_available(to_files(kept, out, checkpoint))
        return began, time.time(), sorted(r["value"] for r in session.read.schema("value string").parquet(out).collect())

    first, first_ended, got = run("a", "touched", "idle")
    assert got == ["idle", "touched"]
    time.sleep(ttl / 3)
    touched, touched_ended, got = run("b", "touched")
    if touched_ended - first > ttl:
        pytest.skip("the machine is too slow to tell the two apart")
    assert got == ["idle", "touched"]
    time.sleep(max(0.0, first_ended + ttl + 0.5 - time.time()))
    _, ended, got = run("c", "touched", "idle")
    if ended - touched > ttl:
        pytest.skip("the machine is too slow to tell the two apart")
    assert got == ["idle", "idle", "touched"]
