import random

import pytest

from ordertide.operators import ordered_requests as R

TABLE = "rowkey string, name string, cell double"
REQUESTS = "rowkey string, n int, sub int, expected double, value double, note string"
NAN = float("nan")


def brute(table, requests, delete=False):
    cells = {k: c for k, _, c in table}
    names = {k: n for k, n, _ in table}
    applied = {}
    for k, n, sub, e, v, _ in sorted(requests, key=lambda r: (r[1], r[2])):
        if k is None:
            applied[k, n, sub] = False
            continue
        cell = cells.get(k)
        hit = str(e) == str(cell) if e != e or cell != cell else e == cell
        applied[k, n, sub] = hit
        if hit:
            cells[k] = None if delete else v
    rows = {(k, names.get(k), cells.get(k)) for k in {*cells, *names}}
    return applied, {r for r in rows if r[1] is not None or r[2] is not None}


def judged(spark, table, requests, parts, delete=False):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        t, q = spark.createDataFrame(table, TABLE), spark.createDataFrame(requests, REQUESTS)
        run = R.check_and_delete_in_order if delete else R.check_and_put_in_order
        after, results = run(t, q, "cell", ["n", "sub"])
        assert results.columns == [*q.columns, "applied"]
        got = {(r["rowkey"], r["n"], r["sub"]): r["applied"] for r in results.collect()}
        return got, {tuple(r) for r in after.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.enabled")


def same(got, want):
    text = lambda rows: {tuple(map(str, r)) for r in rows}
    assert got[0] == want[0]
    assert text(got[1]) == text(want[1])


def toggles(seed, n, keys, values):
    r = random.Random(seed)
    # One key has half of all requests.
    pick = lambda: "hot" if r.random() < 0.5 else f"k{r.randrange(keys)}"
    value = lambda: r.choice(values)
    return [(pick(), i // 3, i % 3, value(), value(), "x") for i in range(n)]


@pytest.mark.parametrize("seed, parts, delete", [(1, 1, False), (2, 5, True), (3, 13, False)])
def test_random_requests(spark, seed, parts, delete):
    values = [None, 0.0, 1.0, 2.0, NAN]
    requests = toggles(seed, 400, 9, values)
    table = [("hot", "h", 1.0), ("k0", "a", None), ("k1", "b", 2.0), ("idle", "i", 3.0), ("k2", None, NAN)]
    same(judged(spark, table, requests, parts, delete), brute(table, requests, delete))


def test_a_counter_over_many_ranges(spark):
    """Each request expects what the one before wrote; one in the middle is missing, so the rest fail."""
    steps = [("hot", i, 0, float(i) if i else None, float(i + 1), "x") for i in range(300) if i != 200]
    want = brute([], steps)
    assert sum(want[0].values()) == 200
    same(judged(spark, [], steps, 17), want)


def test_a_key_without_a_row_begins_a_range(spark):
    requests = [("a", i, 0, None, None, "x") for i in range(40)] + [("b", i, 0, None if i == 0 else 1.0, 1.0, "y") for i in range(40)]
    for parts in (2, 3, 7):
        same(judged(spark, [("c", "n", 1.0)], requests, parts), brute([("c", "n", 1.0)], requests))


def test_a_key_without_a_row_that_no_request_finds_empty(spark):
    requests = [("a", i, 0, 1.0, 2.0, "x") for i in range(30)] + [("b", i, 0, float(i % 3), 1.0, "y") for i in range(60)]
    requests += [("b", 45, 1, None, 0.0, "y")]
    for parts in (3, 5, 9):
        same(judged(spark, [], requests, parts), brute([], requests))


def test_requests_without_key_and_none_at_all(spark):
    table = [("a", "x", 1.0), ("b", None, None)]
    requests = [(None, 1, 0, None, 5.0, "x"), ("a", 1, 0, -0.0, 5.0, "x"), ("z", 1, 0, None, 0.0, "x"), ("z", 2, 0, -0.0, 7.0, "x")]
    same(judged(spark, table, requests, 3), brute(table, requests))
    same(judged(spark, table, [], 3), brute(table, []))


def test_run_map():
    r = random.Random(5)
    for _ in range(200):
        requests = [(r.choice([None, 1, 2, 3]), r.choice([None, 1, 2, 3, 4])) for _ in range(r.randrange(1, 12))]
        told = R.run_map(requests)
        for start in (None, 1, 2, 3, 4, 9):
            cell = start
            for _, cell in R.folded(start, iter(requests)):
                pass
            assert told.get(start, (start, start))[1] == cell
