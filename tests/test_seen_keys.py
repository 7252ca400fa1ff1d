import os
from collections import Counter

import numpy as np
from helpers import GOLDEN_NOON, order
from pyspark.sql import functions as F

from ordertide.plans.jobs import TXN
from ordertide.session import scratch_path
from ordertide.sinks.streams import folder_sink
from ordertide.streaming.run import run_available
from ordertide.streaming.seen_keys import SeenKeys, bloom_filter, may_hold, to_sink_once
from test_streams import text_stream, write_lines


def files_read(df):
    """Files that the scans of a finished query took up."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        metrics = node.metrics()
        if metrics.contains("numFiles"):
            total += metrics.apply("numFiles").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_filter_knows_its_own_and_few_others():
    r = np.random.default_rng(1)
    own, others = r.integers(-(2**63), 2**63, 20_000), r.integers(-(2**63), 2**63, 200_000)
    bits = bloom_filter(own)
    assert may_hold(bits, own).all()
    assert may_hold(bits, others).mean() < 1e-4
    assert may_hold(bloom_filter(own[:1]), own[:1]).all()


def test_batches_without_new_keys(spark, tmp_path):
    seen = SeenKeys(str(tmp_path / "seen"), ["a"], buckets=4, fold_every=2)
    rows = spark.createDataFrame([(1, 1), (None, 2)], "a int, x int")
    for n in range(4):
        # Nothing but empty segments, at last folded ones.
        assert seen.known(spark) is None
        assert seen.fresh(rows, "q", n).count() == 2
        seen.add(rows.where("false"), "q", n)
        assert seen.fold(spark, "q", n + 1) == (n == 2)
    seen.add(rows, "q", 4)
    seen.add(rows.where("false"), "q", 5)
    assert seen.fresh(rows, "q", 6).count() == 0
    assert seen.fold(spark, "q", 6)
    assert sorted(r["a"] or 0 for r in seen.known(spark).collect()) == [0, 1]
    assert [r["a"] for r in seen.fresh(spark.createDataFrame([(1, 1), (2, 2)], "a int, x int"), "other", 0).collect()] == [2]


def test_keys_over_batches(spark, tmp_path):
    seen = SeenKeys(str(tmp_path / "seen"), ["a", "b"], buckets=8, fold_every=3)
    expected, done = Counter(), set()
    for n in range(9):
        rows = [(i % 50, None if i % 7 == 0 else f"k{i}", i) for i in range(n * 10, n * 10 + 30)]
        batch = spark.createDataFrame(rows, "a int, b string, x int")
        fresh = sorted(tuple(r) for r in seen.fresh(batch, "q", n).collect())
        assert fresh == sorted(r for r in rows if r[:2] not in done)
        seen.add(batch.where(F.col("x").isin([r[2] for r in fresh])), "q", n)
        done |= {r[:2] for r in rows}
        seen.fold(spark, "q", n + 1)
        assert len(seen.segments(spark)) <= 4
    assert Counter(tuple(r) for r in seen.known(spark).collect()) == Counter(done), expected
    # A query with another checkpoint begins at batch 0 again and sees them all.
    again = spark.createDataFrame([(1, "k1", 1), (1, "new", 2)], "a int, b string, x int")
    assert [r["b"] for r in seen.fresh(again, "other", 0).collect()] == ["new"]


def test_untouched_buckets_are_not_read(spark, tmp_path):
    seen = SeenKeys(str(tmp_path / "seen"), ["k"], buckets=32)
    stored = spark.range(3200).select(F.concat(F.lit("k"), "id").alias("k"))
    seen.add(stored, "q", 0)
    new = spark.range(500).select(F.concat(F.lit("other"), "id").alias("k"))
    for rows, most in ((new, 2), (new.union(stored.where("k = 'k7'")), 3)):
        fresh = seen.fresh(rows, "q", 1)
        found = [p for p in fresh.inputFiles() if "/seen/" in p]
        assert {r["k"] for r in fresh.collect()} == {r["k"] for r in new.collect()}
        # A file of keys for each bucket that is read, beside the batch's own files.
        assert files_read(fresh) <= len({p for p in fresh.inputFiles()}) - len(found) + most + 8
    assert seen.fresh(new, "q", 0).count() == 500


def test_batches_and_replay(spark, tmp_path):
    out, checkpoint = scratch_path(spark, "once"), tmp_path / "once-c"
    seen = SeenKeys(str(tmp_path / "seen"), ["country", "order_id"], buckets=4, fold_every=2)

    def run():
        stream = text_stream(spark, tmp_path / "in")
        run_available(TXN.write(stream, out, str(checkpoint), as_of=GOLDEN_NOON, seen=seen))
        got = spark.read.parquet(out)
        return sorted((r["batch_id"], r["order_id"]) for r in got.collect())

    for n, ids in enumerate(([1, 2, 2], [2, 3], [1, 4], [4, 5], [5, 6])):
        write_lines(tmp_path / "in", f"f{n}", *[order(order_id=i) for i in ids])
        want = run()
    assert want == [(0, 1), (0, 2), (1, 3), (2, 4), (3, 5), (4, 6)]
    assert not os.path.exists(checkpoint / "state")
    # The commit of the last batch is lost, so the batch runs again: once with, once without its segment.
    (checkpoint / "commits" / "4").unlink()
    (checkpoint / "commits" / ".4.crc").unlink(missing_ok=True)
    assert run() == want
    assert sorted(r["order_id"] for r in seen.known(spark).collect()) == [1, 2, 3, 4, 5, 6]


def test_hot_key_and_empty_batch(spark, tmp_path):
    out = scratch_path(spark, "hot")
    seen = SeenKeys(str(tmp_path / "seen"), ["value"], buckets=4)
    write_lines(tmp_path / "in", "a", *["hot"] * 500, *[f"v{i}" for i in range(100)])
    run_available(to_sink_once(text_stream(spark, tmp_path / "in"), str(tmp_path / "c"), seen, ["value"], folder_sink(out)))
    write_lines(tmp_path / "in", "b", *["hot"] * 50)
    run_available(to_sink_once(text_stream(spark, tmp_path / "in"), str(tmp_path / "c"), seen, ["value"], folder_sink(out)))
    assert spark.read.parquet(out).count() == 101
