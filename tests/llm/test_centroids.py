import hashlib
import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from ordertide.llm import centroids as C

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, v array<int>, cluster string, distance int, squares int"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, 1, "i", [1], "c", 2, 3) for i, x in rows], SCHEMA)


def brute(rows, clusters=16, rounds=3, dims=64):
    limit = 2**27
    kept = [
        (i, tuple(math.floor(max(min(e * 64, limit), -limit)) for e in x)) for i, x in rows
        if x is not None and len(x) == dims and all(e is not None and math.isfinite(e) for e in x)
    ]
    name = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centre = [v for _, v in sorted(kept, key=name)[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centre))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for k in range(len(centre)):
            mine = [v for (_, v), a in zip(kept, at) if a == k]
            if mine:
                centre[k] = tuple(sum(x) // len(mine) for x in zip(*mine))
    found = [(i, *near(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    digest = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    own = lambda k: sum(d for _, d, j in found if j == k)
    fit = lambda x: x if x < 2**63 else None
    return sorted(((i, k, d, fit(own(k)), fit(total), digest(centre[k])) for i, d, k in found), key=str)


def got(df, **options):
    out = C.cluster_report(df, **options)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def vectors(n, seed, dims=64):
    r = random.Random(seed)
    centre = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(5)]
    # Multiples of 1/1024 are the same as float and as double.
    return [(i, [round((c + r.gauss(0, 0.4)) * 1024) / 1024 for c in centre[r.randrange(5)]]) for i in range(n)]


def test_awkward_vectors(spark):
    rows = vectors(120, 1)
    one = rows[7][1]
    rows += [
        (7, one), (7, one), (900, one), (None, one), (901, None), (902, []), (903, one[:63]), (904, [*one, 0.0]),
        (905, [None, *one[1:]]), (906, [float("nan"), *one[1:]]), (907, [float("inf"), *one[1:]]),
        (908, [-float("inf"), *one[1:]]), (909, [0.0] * 64), (910, [-0.0] * 64), (911, [3e38] * 64), (912, [-3e38] * 64),
    ]
    assert got(frame(spark, rows)) == brute(rows)


def test_one_vector_a_third_of_all(spark):
    rows = vectors(90, 2)
    rows += [(1000 + i, rows[0][1]) for i in range(60)]
    assert got(frame(spark, rows).repartition(7)) == brute(rows)


def test_few_vectors_and_none(spark):
    rows = vectors(5, 3)
    assert got(frame(spark, rows)) == brute(rows)
    assert got(frame(spark, [])) == []
    assert got(frame(spark, [(1, None)])) == []


def test_other_sizes(spark):
    rows = vectors(60, 4, dims=3)
    assert got(frame(spark, rows), clusters=4, rounds=6, dimensions=3) == brute(rows, 4, 6, 3)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=2, max_size=2), min_size=1, max_size=25))
def test_ties(spark, points):
    rows = [(i, [e / 2 for e in p]) for i, p in enumerate(points)]
    assert got(frame(spark, rows), clusters=3, rounds=2, dimensions=2) == brute(rows, 3, 2, 2)
