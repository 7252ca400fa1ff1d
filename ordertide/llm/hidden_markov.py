"""Operator 11: language-model scoring with a hidden Markov model over the tokens of a text.

Words are counted over all training texts. A word that makes up at least ``SHARE`` of all training tokens
(and stands there twice) is a symbol of its own, so that there are at most 1/``SHARE`` of them at any size
of the corpus; other words, unseen ones too, are met through the symbol of their last two characters, or
one symbol for all rarer endings. What such a symbol emits is a word of its class by its count, with one
place for unseen words, so that every count of the corpus is in the score and all outcomes together have
probability one.

Texts are written once as symbols. Baum-Welch runs over them: a task takes many texts abreast, longest
first, computes scaled forward and backward recursions for all of them in one step of array arithmetic a
position, and adds up the expected starts, moves and emissions, a row for each symbol. Spark sums these rows over
all partitions, and the driver, which gets a row for each symbol, divides them out to the next model.
Every round, from a random start on, counts over all training texts; only a caller who names ``start_docs``
has the first rounds look at fewer. The score is the scaled forward recursion alone, over every whole text.

Counts of rare words reach their texts by a join on the word, of one row for each text and word; words
that are common enough to be hot are symbols and never get there. The number of documents of a rare word
is below ``SHARE`` of all training tokens; held-out copies of one unseen word meet no counts and are
dropped before any sum, as the logarithm of one is nothing.

Edge cases. A null or empty text is its end alone. A null id counts as the empty text and so is trained on.
Repeated rows and ids give a row each and are each counted. Without any training text each token has
probability one by the base and the model knows the end and the rest. An empty table gives no row. Other
columns are not looked at. A text is one row at any length; tokens are held as four bytes each. Sums of
fractions come in any order, so that scores may differ in their last digits between runs.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm.rows import ranges, sliced
from ordertide.session import settle

STATES = 8
#: Least share of all training tokens, and least count, of a word or an ending that is a symbol.
SHARE, LEAST = 1e-6, 2
#: Characters at the end of a rare word that make its class.
ENDING = 2
#: Rounds of Baum-Welch, each over all training texts.
START_ROUNDS, ROUNDS = 4, 2
#: Share of every state's emissions that follows the counts of the whole corpus.
MIXED = 0.02
#: Chance of a state to stay, in the random start.
STAY = 0.9
#: Words that a task counts before it passes them on, and characters of texts handled together.
HELD, PART = 400_000, 4_000_000
#: Tokens of texts that are ordered by length together, and of those that are then walked abreast.
ORDERED, ABREAST = 8_000_000, 1_000_000
FOLDS, HELD_OUT = 7, 2
SEED = 1
#: The token behind the last word. No word is empty.
END = b""


def held_out(id_col: Column) -> Column:
    """Whether the CRC-32 of the id as text leaves the remainder that is not trained on."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def words(text: bytes | None) -> list[bytes]:
    """Lower-cased words, apart by ASCII white space, and the end."""
    return [*(text or b"").lower().split(), END]


def identified(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(
        F.monotonically_increasing_id().alias("uid"), df[id_col].alias("id"), held_out(df[id_col]).alias("held_out"),
        df[text_col].cast("string").cast("binary").alias("text"),
    )


def word_counts(texts: DataFrame) -> DataFrame:
    """How often each word, and the end, stands in the training texts; added up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in sliced(batches, "text", PART):
            for text in batch.column(0).to_pylist():
                seen.update(words(text))
                if len(seen) > HELD:
                    yield told(seen)
                    seen = Counter()
        if seen:
            yield told(seen)

    def told(seen: Counter[bytes]) -> pa.RecordBatch:
        word = pa.array(list(seen), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([word, pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    parts = texts.where(~F.col("held_out")).select("text").mapInArrow(run, "word string, n bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("c"))


@dataclass
class Vocabulary:
    """The symbols: frequent words, then endings of rare ones, then all other endings."""

    tokens: int
    types: int
    least: int
    words: dict[bytes, int]
    endings: dict[str, int]
    #: Count of each word, or of all rare words of a class together; their types, and a place for unseen ones.
    counts: np.ndarray
    places: np.ndarray

    @property
    def other(self) -> int:
        return len(self.words) + len(self.endings)

    @property
    def share(self) -> np.ndarray:
        """What the counts alone, one added to each, give every symbol."""
        n = self.counts + self.places
        return n / n.sum()

    @property
    def log_total(self) -> float:
        return math.log10(self.tokens + self.types + 1)


def vocabulary(counts: DataFrame, share: float = SHARE) -> Vocabulary:
    """Symbols by the counts of a whole corpus, at most ``1/share`` words and ``1/share`` endings."""
    whole = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).head()
    least = max(LEAST, math.ceil(share * whole["n"]))
    often = (F.col("c") >= least) | (F.col("word") == "")
    found = counts.where(often).toArrow()
    frequent = dict(zip((w.encode() for w in found["word"].to_pylist()), found["c"].to_pylist()))
    frequent.setdefault(END, 0)
    known = sorted(frequent)
    rare = counts.where(~often).groupBy(F.right("word", F.lit(ENDING)).alias("ending")).agg(
        F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")
    )
    classes = sorted(rare.where(F.col("c") >= least).toArrow().to_pylist(), key=lambda r: r["ending"])
    rest = rare.where(F.col("c") < least).agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).head()
    n = len(known)
    return Vocabulary(
        whole["n"], whole["v"], least, {w: k for k, w in enumerate(known)}, {r["ending"]: n + k for k, r in enumerate(classes)},
        np.array([*[frequent[w] for w in known], *[r["c"] for r in classes], rest["c"]], np.float64),
        np.array([*[1] * n, *[r["v"] + 1 for r in classes], rest["v"] + 1], np.float64),
    )


_CODED = (
    "uid bigint, id {id}, held_out boolean, symbols array<int>, n_known bigint, base double, inside double, "
    "rare array<struct<word:string,n:bigint>>"
)


def coded(texts: DataFrame, known: Broadcast[Vocabulary]) -> DataFrame:
    """Each text as symbols, its sums over frequent words and over classes, and its rare words with their number.

    ``base`` lacks the logarithms of rare words' counts; ``inside`` is what their classes divide by.
    """
    kind = texts.schema["id"].dataType.simpleString()
    names = ["uid", "id", "held_out", "symbols", "n_known", "base", "inside", "rare"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = known.value
        symbol, ending, other, n_words = v.words.get, v.endings.get, v.other, len(v.words)
        log_count, log_class = np.log10(v.counts + 1), np.log10(v.counts + v.places)
        for batch in sliced(batches, "text", PART):
            each: list[np.ndarray] = []
            figures: list[tuple[int, float, float]] = []
            rare_words: list[bytes] = []
            rare_n: list[int] = []
            ends = [0]
            for text in batch.column(3).to_pylist():
                token = words(text)
                at = np.fromiter(map(symbol, token, repeat(-1)), np.int32, len(token))
                missing = np.flatnonzero(at < 0)
                if len(missing):
                    # A text's rare words, each looked at once.
                    lost = [token[k] for k in missing.tolist()]
                    number = Counter(lost)
                    of = {w: ending(w.decode()[-ENDING:], other) for w in number}
                    at[missing] = [of[w] for w in lost]
                    rare_words += number
                    rare_n += number.values()
                ends.append(len(rare_words))
                own = at[at < n_words]
                count = v.counts[own]
                figures.append((int((count > 0).sum()), float(log_count[own].sum()) - len(token) * v.log_total, float(log_class[at[missing]].sum())))
                each.append(at)
            lengths = np.cumsum([0, *[len(x) for x in each]]).astype(np.int32)
            symbols = pa.ListArray.from_arrays(pa.array(lengths), pa.array(np.concatenate(each) if each else np.zeros(0, np.int32)))
            rare = pa.StructArray.from_arrays(
                [pa.array(rare_words, pa.binary()).cast(pa.string()), pa.array(rare_n, pa.int64())], names=["word", "n"]
            )
            columns = [pa.array([f[k] for f in figures], t) for k, t in enumerate((pa.int64(), pa.float64(), pa.float64()))]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rare)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(3)], symbols, *columns, lists], names=names)

    return texts.mapInArrow(run, _CODED.format(id=kind))


@dataclass
class Model:
    """Chances of the first state, of moves from row to column, and of each symbol (row) in each state."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    #: log10 of the likelihood that each round found, of the model before it.
    history: list[float] = field(default_factory=list)


def random_model(share: np.ndarray, states: int = STATES, seed: int = SEED) -> Model:
    """States that differ a little at random and tend to stay."""
    emit = share[:, None] * np.random.default_rng(seed).uniform(0.5, 1.5, (len(share), states))
    move = np.full((states, states), (1 - STAY) / max(states - 1, 1))
    np.fill_diagonal(move, STAY if states > 1 else 1)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


class Abreast:
    """Sequences side by side, longest first: position t of all of them is one block of rows."""

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences], np.int64)
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        # So many sequences are longer than t, and their block starts there.
        self.width = np.searchsorted(-lengths, -np.arange(lengths[0] if len(lengths) else 0), "left")
        self.first = np.concatenate([[0], np.cumsum(self.width)])
        at = self.first[ranges(lengths)] + np.repeat(np.arange(len(lengths)), lengths)
        self.symbols = np.empty(len(at), np.int32)
        self.symbols[at] = np.concatenate([sequences[k] for k in self.order])
        self.blocks = list(zip(self.first[:-1].tolist(), self.first[1:].tolist(), self.width.tolist()))

    def log_likelihood(self, model: Model) -> np.ndarray:
        """log10 of the probability of every sequence, by the scaled forward recursion."""
        total, one = np.zeros(len(self.order)), np.ones((len(model.start), 1))
        a = np.broadcast_to(model.start, (len(self.order), len(model.start)))
        for t, (first, last, n) in enumerate(self.blocks):
            a = a[:n] @ model.move if t else a
            a = a * model.emit[self.symbols[first:last]]
            scale = np.matmul(a, one)
            a /= scale
            total[:n] += np.log10(scale[:, 0])
        out = np.empty(len(total))
        out[self.order] = total
        return out

    def expected(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected starts, moves and emissions by scaled forward and backward recursions, and the log10 likelihood."""
        kind, states = np.float32, len(model.start)
        move, back = model.move.astype(kind), np.ascontiguousarray(model.move.T.astype(kind))
        # The scale is written out to every column, as equal shapes divide much faster.
        one, wide = np.ones((states, 1), kind), np.ones((1, states), kind)
        emit = np.take(model.emit.astype(kind), self.symbols, axis=0)
        ahead, scales, scale = np.empty_like(emit), np.empty_like(emit), np.empty((len(emit), 1), kind)
        a = np.broadcast_to(model.start.astype(kind), (len(self.order), states))
        for t, (first, last, n) in enumerate(self.blocks):
            a = np.matmul(a[:n], move) if t else a
            a = np.multiply(a, emit[first:last], out=ahead[first:last])
            a /= np.matmul(np.matmul(a, one, out=scale[first:last]), wide, out=scales[first:last])
        emit /= scales
        after = scales
        after[:] = 1
        for (before, _, _), (first, last, n) in zip(self.blocks[-2::-1], self.blocks[:0:-1]):
            # What comes at and behind this position, given the state here; then given the state before.
            e = np.multiply(emit[first:last], after[first:last], out=emit[first:last])
            np.matmul(e, back, out=after[before : before + n])
        moves, n0 = np.zeros((states, states)), self.blocks[0][1]
        previous = np.arange(n0, len(emit)) - np.repeat(self.width[:-1], self.width[1:])
        for k in range(0, len(previous), 8192):
            moves += ahead[previous[k : k + 8192]].T.astype(np.float64) @ emit[n0 + k : n0 + k + 8192]
        ahead *= after
        symbols, emitted = self.symbols.astype(np.intp), np.empty((len(model.emit), states))
        for k in range(states):
            emitted[:, k] = np.bincount(symbols, ahead[:, k], len(model.emit))
        return ahead[:n0].sum(0, dtype=np.float64), model.move * moves, emitted, float(np.log10(scale, dtype=np.float64).sum())


def _abreast(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[list[pa.RecordBatch], Iterator[tuple[np.ndarray, Abreast]]]]:
    """Batches of about ``ORDERED`` tokens, and their sequences, longest first, in groups of about ``ABREAST``.

    Walking texts of like length together makes few steps of many rows. Each group comes with the numbers
    of its sequences.
    """

    def groups(sequences: list[np.ndarray]) -> Iterator[tuple[np.ndarray, Abreast]]:
        order = np.argsort([-len(s) for s in sequences], kind="stable")
        ends = np.cumsum([len(sequences[k]) for k in order])
        start = 0
        while start < len(order):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + ABREAST, "right")))
            yield order[start:stop], Abreast([sequences[k] for k in order[start:stop]])
            start = stop

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += len(batch.column(column).flatten())
        if size >= ORDERED:
            yield held, groups(_sequences(held, column))
            held, size = [], 0
    if held:
        yield held, groups(_sequences(held, column))


def _sequences(batches: list[pa.RecordBatch], column: str) -> list[np.ndarray]:
    out = []
    for batch in batches:
        lists = batch.column(column)
        flat, ends = lists.flatten().to_numpy(False), np.cumsum(lists.value_lengths().to_numpy(False))
        out += np.split(flat, ends[:-1]) if len(ends) else []
    return out


def baum_welch(docs: DataFrame, model: Model, share: np.ndarray) -> Model:
    """One round over all ``symbols`` of ``docs``: expected counts added up over partitions, then divided out."""
    spark, states = docs.sparkSession, len(model.start)
    sent = spark.sparkContext.broadcast(model)
    names = ["symbol", *[f"k{k}" for k in range(states)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = sent.value, None
        for _, groups in _abreast(batches, "symbols"):
            for _, group in groups:
                part = group.expected(now)
                sums = part if sums is None else tuple(x + y for x, y in zip(sums, part))
        if sums is None:
            return
        started, moves, emitted, fit = sums
        seen = np.flatnonzero(emitted.any(1))
        # Below zero stand the moves, the starts and the likelihood.
        symbol = np.concatenate([seen, -1 - np.arange(states + 2)])
        table = np.concatenate([emitted[seen], moves, started[None], np.full((1, states), fit)])
        for k in range(0, len(symbol), 50_000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(symbol[k : k + 50_000]), *[pa.array(np.ascontiguousarray(c)) for c in table[k : k + 50_000].T]], names=names
            )

    schema = ", ".join(["symbol bigint", *[f"{c} double" for c in names[1:]]])
    parts = docs.select("symbols").mapInArrow(run, schema)
    found = parts.groupBy("symbol").agg(*[F.sum(c).alias(c) for c in names[1:]]).toArrow()
    sent.unpersist()
    symbol = found["symbol"].to_numpy()
    table = np.stack([found[c].to_numpy() for c in names[1:]], 1) if len(symbol) else np.zeros((0, states))
    emitted = np.zeros_like(model.emit)
    emitted[symbol[symbol >= 0]] = table[symbol >= 0]
    below = np.zeros((states + 2, states))
    below[-1 - symbol[symbol < 0]] = table[symbol < 0]
    moves, started, fit = below[:states] + 1, below[states] + 1, below[states + 1, 0]
    mass = emitted.sum(0)
    emit = np.where(mass > 0, emitted / np.maximum(mass, 1e-300), share[:, None])
    return Model(
        started / started.sum(), moves / moves.sum(1, keepdims=True), (1 - MIXED) * emit + MIXED * share[:, None],
        [*model.history, float(fit)],
    )


def trained(
    docs: DataFrame, share: np.ndarray, states: int = STATES, start_docs: int | None = None,
    start_rounds: int = START_ROUNDS, rounds: int = ROUNDS, seed: int = SEED,
) -> Model:
    """A model of the training texts, by rounds over all of them.

    With ``start_docs`` the first rounds look at about so many texts, chosen by the hash of their ids.
    """
    training = docs.where(~F.col("held_out")).select("id", "uid", "symbols")
    model = random_model(share, states, seed)
    if training.isEmpty():
        return model
    some = training
    if start_docs is not None:
        steps = 2**40
        some = training.where(F.pmod(F.xxhash64("id", "uid"), F.lit(steps)) < math.ceil(steps * min(1, start_docs / training.count())))
        some = settle(some.select("symbols"), "start-texts")
    for _ in range(start_rounds):
        model = baum_welch(some, model, share)
    for _ in range(rounds):
        model = baum_welch(training, model, share)
    return model


def log_likelihoods(docs: DataFrame, model: Model) -> DataFrame:
    """``uid`` and the log10 likelihood of the ``symbols`` of each of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, groups in _abreast(batches, "symbols"):
            fit = np.zeros(sum(b.num_rows for b in held))
            for numbers, group in groups:
                fit[numbers] = group.log_likelihood(sent.value)
            uid = pa.chunked_array([b.column("uid") for b in held]).combine_chunks()
            yield pa.RecordBatch.from_arrays([uid, pa.array(fit)], names=["uid", "fit"])

    return docs.select("uid", "symbols").mapInArrow(run, "uid bigint, fit double")


def likelihood_report(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = SHARE, **training
) -> DataFrame:
    """Base and model score of every text, learnt from those that are not held out."""
    spark: SparkSession = df.sparkSession
    texts = identified(df, id_col, text_col)
    counts = settle(word_counts(texts), "word-counts")
    known = vocabulary(counts, share)
    docs = settle(coded(texts, spark.sparkContext.broadcast(known)), "coded-texts")
    model = trained(docs, known.share, **training)
    rare = docs.select("uid", F.explode("rare").alias("r")).select("uid", "r.*")
    # A part of the counts, of which no word is hot, is held as a hash table, so that neither side is sorted.
    met = rare.join(counts.where((F.col("c") < known.least) & (F.col("word") != "")).hint("shuffle_hash"), "word")
    sums = met.groupBy("uid").agg(F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_log"))
    own = docs.select("uid", "id", "held_out", "n_known", "base", "inside", F.size("symbols").cast("bigint").alias("n_tokens"))
    whole = own.join(log_likelihoods(docs, model), "uid").join(sums, "uid", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return whole.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(known.tokens).cast("bigint").alias("train_tokens"), (F.col("base") + rare_log).alias("base_score"),
        (F.col("fit") + rare_log - F.col("inside")).alias("score"),
    )
