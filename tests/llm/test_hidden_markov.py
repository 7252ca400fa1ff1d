import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from ordertide.llm import hidden_markov as H

COLUMNS = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def model(states, symbols, seed):
    r = np.random.default_rng(seed)
    part = lambda *n: (x := r.uniform(0.05, 1, n)) / x.sum(-1, keepdims=True)
    return H.Model(part(states), part(states, states), part(states, symbols).T.copy())


def paths(m, seq):
    """Every path of states with its probability together with the sequence."""
    for p in itertools.product(range(len(m.start)), repeat=len(seq)):
        chance = m.start[p[0]] * m.emit[seq[0], p[0]]
        for a, b, s in zip(p, p[1:], seq[1:]):
            chance *= m.move[a, b] * m.emit[s, b]
        yield p, chance


SEQUENCES = [np.array(x, np.int32) for x in ([0, 1, 2, 2, 1], [3], [2, 2], [1, 0, 3, 1, 1, 2], [0, 1, 2, 2, 1], [3])]


@pytest.mark.parametrize("states", [1, 2, 3])
def test_recursions_against_all_paths(states):
    m = model(states, 4, states)
    start, move, emit, fit = np.zeros(states), np.zeros((states, states)), np.zeros((4, states)), []
    for seq in SEQUENCES:
        total = sum(c for _, c in paths(m, seq))
        fit.append(math.log10(total))
        for p, c in paths(m, seq):
            start[p[0]] += c / total
            for a, b in zip(p, p[1:]):
                move[a, b] += c / total
            for k, s in zip(p, seq):
                emit[s, k] += c / total
    both = H.Abreast(SEQUENCES)
    assert np.allclose(both.log_likelihood(m), fit, rtol=1e-12)
    got = both.expected(m)
    for x, y in zip(got, (start, move, emit, sum(fit))):
        assert np.allclose(x, y, rtol=1e-5)


def test_rounds_raise_the_likelihood(spark):
    # Two languages that share no word, and words that come in a fixed order.
    texts = [" ".join((["a", "b", "c"] if k % 2 else ["x", "y", "z"]) * (4 + k % 5)) for k in range(60)]
    df = cases.frame(spark, texts)
    known = H.vocabulary(H.word_counts(H.identified(df, "doc_id", "text")))
    docs = H.coded(H.identified(df, "doc_id", "text"), spark.sparkContext.broadcast(known))
    m = H.trained(docs, known.share, states=4, start_docs=20, start_rounds=5, rounds=8)
    last = m.history[-7:]
    assert all(b > a - 1e-3 * abs(a) for a, b in zip(last, last[1:])) and last[-1] > m.history[5]
    assert np.allclose(m.emit.sum(0), 1) and np.allclose(m.move.sum(1), 1) and np.isclose(m.start.sum(), 1)
    score = lambda t: H.Abreast([np.array([known.words[w.encode()] for w in t.split()], np.int32)]).log_likelihood(m)[0]
    assert score("a b c a b c") > score("a x b y c z") + 1


def brute(rows):
    """Base columns by the formula, over plain token lists."""
    token = [(i, zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    count = Counter(w for _, out, ws in token if not out for w in ws)
    n = sum(count.values())
    total = math.log10(n + len(count) + 1)
    return [
        (i, out, len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10(count[w] + 1) - total for w in ws))
        for i, out, ws in token
    ]


@pytest.mark.parametrize("share", [1e-6, 0.01])
def test_base_columns(spark, share):
    df = cases.frame(spark)
    out = H.likelihood_report(df.repartition(4), share=share, start_rounds=2, rounds=1)
    assert out.columns == COLUMNS
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    got, want = cases.plain(out, *COLUMNS[:5]), brute(rows)
    assert got == cases.in_order([w[:5] for w in want])
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    for g, w in zip(sorted(map(tuple, out.collect()), key=key), sorted(want, key=key)):
        assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isfinite(g[6]) and g[6] < 0


def test_score_is_the_models(spark):
    """The whole score from the vocabulary and the model by hand, rare and unseen words included."""
    rows = ["the cat sat on the mat", "the dog sat", "The CAT ran oddly", "a mat on a mat zzz", "the unseen word mat"] * 3
    df = cases.frame(spark, rows)
    texts = H.identified(df, "doc_id", "text")
    counts = H.word_counts(texts)
    known = H.vocabulary(counts, share=0.12)
    docs = H.coded(texts, spark.sparkContext.broadcast(known))
    m = H.trained(docs, known.share, states=2, start_rounds=1, rounds=2)
    c = {r["word"].encode(): r["c"] for r in counts.collect()}
    want = []
    for r in df.collect():
        ws = H.words((r["text"] or "").encode())
        at = [known.words.get(w, known.endings.get(w.decode()[-2:], known.other)) for w in ws]
        inside = sum(math.log10((c.get(w, 0) + 1) / (known.counts[k] + known.places[k])) for w, k in zip(ws, at) if k >= len(known.words))
        want.append(math.log10(sum(p for _, p in paths(m, at))) + inside)
    out = H.likelihood_report(df, share=0.12, states=2, start_rounds=1, rounds=2)
    assert len(known.words) < 12 and known.endings is not None
    assert np.allclose(sorted(r["score"] for r in out.collect()), sorted(want), rtol=1e-5)


def test_all_outcomes_have_probability_one(spark):
    counts = H.word_counts(H.identified(cases.frame(spark), "doc_id", "text"))
    v = H.vocabulary(counts, share=0.001)
    assert np.isclose(v.share.sum(), 1) and v.counts.sum() == v.tokens
    assert len(v.words) <= 1000 and v.places.sum() == v.types + len(v.endings) + 1


def test_no_texts(spark):
    assert H.likelihood_report(cases.frame(spark, [])).count() == 0
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][0]
    only = spark.createDataFrame([(held, "some words")], "doc_id bigint, text string")
    (row,) = H.likelihood_report(only).collect()
    assert row["held_out"] and row["train_tokens"] == 0 and row["base_score"] == 0 and row["n_known"] == 0


def test_held_out_texts_are_likelier_than_by_the_base(spark, sf):
    from ordertide.llm.queries import QUERIES

    out = QUERIES["op11_hidden_markov"](spark, sf.replace("0.001", "0.01")).where("held_out").agg({"score": "sum", "base_score": "sum"}).head()
    assert out["sum(score)"] > 0.93 * out["sum(base_score)"]


def test_every_round_counts_all_training_texts(spark):
    df = cases.frame(spark, [f"a b {'c d' if k % 3 else 'e'} w{k % 7}" for k in range(4000)])
    texts = H.identified(df, "doc_id", "text")
    known = H.vocabulary(H.word_counts(texts))
    docs = H.coded(texts, spark.sparkContext.broadcast(known))
    m = H.trained(docs, known.share, states=2, start_rounds=1, rounds=1)
    whole = H.log_likelihoods(docs.where("not held_out"), H.random_model(known.share, 2)).agg(F.sum("fit")).head()[0]
    assert len(m.history) == 2 and math.isclose(m.history[0], whole, rel_tol=1e-4)


def test_symbols_are_converted_once_for_all_states(monkeypatch):
    kinds, inner = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *a: kinds.append(x.dtype) or inner(x, *a))
    H.Abreast(SEQUENCES).expected(model(3, 4, 1))
    assert kinds == [np.dtype(np.intp)] * 3
