"""Operator 9: a quality classifier taught by weak labels.

Overlapping heuristic labellers vote on every document: good, bad, or nothing. Expectation-maximisation
over the counts of vote patterns, of which there are at most 3 to the number of labellers, estimates how
accurate each labeller is and how common good documents are; the posterior of a document's pattern is
its label. A hashed linear scorer (logistic regression on words and word shapes in a fixed number of
buckets) is fitted to the posteriors of a bounded sample and judges every document.

The votes, the patterns and the scores cover all rows. ``SAMPLE`` bounds the rows that are fitted; they
are those with the least hash of id and text, rows that repeat both counted once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.llm.quality_rules import base_counts, words_of
from ordertide.llm.rows import sliced

SAMPLE = 8_000
BUCKETS = 1 << 16
#: Least probability of a document that is kept; below one half, as losing a good one costs more.
THRESHOLD = 0.35
ROUNDS = 60
GOOD, BAD, NONE = 1, 0, -1
MEMORY = 400_000


def votes(text: str | None) -> list[int]:
    """The labellers' votes on one text; all abstain on a text without words."""
    words = words_of(text)
    n = len(words)
    if not n:
        return [NONE] * len(LABELLERS)
    n_words, chars, symbols, dup_lines, repeated = base_counts(text, words)
    upper = sum(w.isupper() and len(w) > 1 for w in words) / n
    bare = sum(not any(map(str.isalnum, w)) for w in words) / n
    marked = sum(w[-1:] in "#*$%&|<>!" for w in words) / n
    kinds = len(set(words)) / n
    facts = {
        "symbols": symbols / n, "repeated": repeated / n, "upper": upper, "bare": bare, "marked": marked,
        "kinds": kinds, "mean": chars / n, "ends": sum(w[-1:] in ".!?" for w in words) / n, "n": n,
    }
    return [f(facts) for f in LABELLERS.values()]


def _detector(name: str, bad):
    """Votes bad or nothing: not to have one fault says little about the others."""
    return lambda facts: BAD if bad(facts[name]) else NONE


def _band(name: str, good, bad):
    return lambda facts: GOOD if good(facts[name]) else BAD if bad(facts[name]) else NONE


LABELLERS = {
    "symbols": _detector("symbols", lambda v: v > 0.2),
    "repetition": _detector("repeated", lambda v: v > 0.5),
    "capitals": _detector("upper", lambda v: v > 0.25),
    "bare marks": _detector("bare", lambda v: v > 0.15),
    "odd endings": _detector("marked", lambda v: v > 0.25),
    "few kinds of words": _detector("kinds", lambda v: v < 0.2),
    "word length": _band("mean", lambda v: 3 <= v <= 9, lambda v: v < 2 or v > 14),
    "sentences": _band("ends", lambda v: 0.02 < v < 0.4, lambda v: v < 0.005),
}


def fit_votes(patterns: list[tuple[list[int], int]], rounds: int = 200) -> tuple[float, np.ndarray, dict]:
    """(share of good, table of P(vote | class) by labeller, posterior of each pattern) by EM."""
    m = np.array([p for p, _ in patterns], np.int64).reshape(len(patterns), -1) + 1
    n = np.array([c for _, c in patterns], np.float64)
    share = 0.8
    # Labellers start out better than chance, so that the classes keep their names.
    table = np.tile(np.array([[0.5, 0.3, 0.2], [0.28, 0.02, 0.7]]), (m.shape[1], 1, 1))
    posterior = np.full(len(n), share)
    for _ in range(rounds):
        logs = [np.log([1 - share, share][c]) + sum(np.log(table[j, c, m[:, j]]) for j in range(m.shape[1])) for c in (0, 1)]
        posterior = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))
        weight = np.stack([(1 - posterior) * n, posterior * n])
        share = float(np.clip(weight[1].sum() / max(n.sum(), 1e-9), 0.01, 0.99))
        for j in range(m.shape[1]):
            for c in (0, 1):
                counts = np.bincount(m[:, j], weight[c], 3) + 0.5
                table[j, c] = counts / counts.sum()
    return share, table, {tuple(p): float(q) for (p, _), q in zip(patterns, posterior)}


def _shape(word: str) -> str:
    out = ""
    for c in word:
        k = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        if not out.endswith(k):
            out += k
    return out[:8]


class Features:
    """Hashed counts of words and of word shapes, damped and scaled to length one."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        found: list[int] = []
        for w in words_of(text):
            pair = known.get(w)
            if pair is None:
                made = (zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS, zlib.crc32(b"\0" + _shape(w).encode("utf-8", "surrogatepass")) % BUCKETS)
                pair = known[w] = made
            found += pair
        at, counts = np.unique(np.array(found, np.int64), return_counts=True)
        values = 1 + np.log(counts) if len(counts) else counts.astype(float)
        return at, values / max(1e-9, float(np.sqrt((values**2).sum())))


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = ROUNDS) -> np.ndarray:
    """Weights and, last, the bias of a logistic regression on soft labels, by gradient steps of Adagrad."""
    weights, square = np.zeros(BUCKETS + 1), np.full(BUCKETS + 1, 1e-8)
    if not rows:
        return weights
    at = np.concatenate([r[0] for r in rows])
    value = np.concatenate([r[1] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    target = np.array([r[2] for r in rows])
    balance = np.where(target > 0.5, 0.5 / max(target.mean(), 1e-3), 0.5 / max(1 - target.mean(), 1e-3))
    for _ in range(rounds):
        score = np.bincount(row, weights[at] * value, len(rows)) + weights[-1]
        miss = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - target) * balance / len(rows)
        gradient = np.append(np.bincount(at, miss[row] * value, BUCKETS), miss.sum())
        square += gradient**2
        weights -= 0.3 * gradient / np.sqrt(square)
    return weights


def classify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``row``, score (probability of good) and kept for every row of ``docs``.

    Null and wordless texts score 0 and are not kept. Equal texts score alike. An empty table stays empty.
    """
    spark = docs.sparkSession
    boxed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].cast("string").alias("text"))
    tie = F.xxhash64(docs[id_col].cast("string"), docs[text_col].cast("string"))

    def voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1_000_000):
            made = [votes(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.int32()))], names=["votes"])

    counted = boxed.select("text").mapInArrow(voted, "votes array<int>").groupBy("votes").agg(F.count("*").alias("n"))
    patterns = [(list(r["votes"]), r["n"]) for r in counted.collect()]
    posterior = fit_votes(patterns)[2] if patterns else {}
    hashed = docs.select(tie.alias("tie"), docs[text_col].cast("string").alias("text")).filter("text is not null")
    # Hashes alone are ordered; texts are read for those that were chosen, each once.
    last = hashed.select("tie").distinct().orderBy("tie").limit(sample).agg(F.max("tie")).head()[0]
    chosen = hashed.filter(F.col("tie") <= F.lit(last).cast("long")).groupBy("tie").agg(F.min("text").alias("text"))
    features, rows = Features(), []
    for _, text in chosen.orderBy("tie").toLocalIterator():
        if words_of(text):
            rows.append((*features.of(text), posterior[tuple(votes(text))]))
    sent = spark.sparkContext.broadcast(fit_scorer(rows).astype(np.float32))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights = Features(), sent.value
        for batch in sliced(batches, "text", 1_000_000):
            out = []
            for text in batch.column(1).to_pylist():
                at, value = features.of(text)
                score = float(weights[at] @ value) + float(weights[-1])
                out.append(1 / (1 + np.exp(-np.clip(score, -30, 30))) if len(at) else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.float64()), pa.array([x >= THRESHOLD for x in out])], names=["row", "score", "kept"])

    return boxed.mapInArrow(scored, T.StructType([boxed.schema["row"], *T.StructType.fromDDL("score double, kept boolean").fields]))


def classifier_report(docs: DataFrame) -> DataFrame:
    """doc_id, score, kept of every row."""
    return classify(docs.select("doc_id", "text")).select("row.doc_id", "score", "kept")
