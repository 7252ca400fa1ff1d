"""Operator 3: quality rules with an n-gram language model.

``ngram_counts`` counts in Spark, over all texts, the character n-grams (order 5) inside words, with
start and end marks, per language. ``kneser_ney`` turns them into an interpolated modified Kneser-Ney
model: lower orders count the distinct n-grams that end in a gram, every order and language has its own
three discounts from its counts of counts, and each probability is interpolated down to the uniform one.
``HashModel`` keeps it as sorted arrays of 64-bit gram hashes beside log probabilities and back-off
weights. ``quality`` scores each text by its perplexity per gram and rejects what lies outside a lower
and an upper band of its language.

Counts are added up in each task before they are shuffled, so that the volume follows the number of
distinct grams, and no frequent gram gathers anywhere. The bands are set by the median and the median
absolute deviation of log perplexity over all texts of the language that pass the base rules.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.llm.rows import mixed, ranges, sliced
from ordertide.llm.tokens import forget
from ordertide.session import fits, settle

ORDER = 5
START, END = "\x02", "\x03"
MIN_WORDS = 50
#: Width of the bands in robust standard deviations below and above the median.
LOWER, UPPER = 6.0, 6.0
#: Least robust standard deviation of log perplexity, so that a uniform language rejects nothing.
LEAST_SPREAD = 0.02
#: Grams of all models together, and languages, that may be sent to every task (16 bytes a gram), the
#: smallest models first. Texts of the other languages are scored by a join.
SENT_GRAMS, SENT_LANGS = 8_000_000, 1000
#: Numbers of rejected rows that may be sent to all tasks, counted first; beyond that they are joined.
SENT_IDS = 500_000
#: Steps of log probability in which a join adds up, so that no order of rows changes a sum.
STEPS = 1 << 30
#: Distinct grams that a task holds before it passes them on.
HELD_GRAMS = 400_000
HELD_WORDS = 200_000
#: Words whose scores a task remembers in all its models together.
HELD_SCORES = 500_000

_SYMBOL = re.compile(r"[#*$%&|<>]")
_SPACE = " \t\n\v\f\r"


def words_of(text: str | None) -> list[str]:
    """Runs of anything but space, \\t, \\n, \\v, \\f and \\r; none for null."""
    found = (text or "").encode("utf-8", "surrogatepass").split()
    return b" ".join(found).decode("utf-8", "surrogatepass").split(" ") if found else []


def base_counts(text: str | None, words: list[str] | None = None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    text = text or ""
    words = words_of(text) if words is None else words
    n, symbols = len(words), len(_SYMBOL.findall(text))
    if not n:
        return 0, 0, symbols, 0, 0
    lines = [x for x in text.split("\n") if x.strip(_SPACE)]
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    repeated = 0
    if n >= 3 and len(numbers) < n:
        ids = np.fromiter(map(numbers.__getitem__, words), np.uint64, n)
        kinds = np.uint64(len(numbers))
        pairs = ids[:-2] * kinds + ids[1:-1]
        if len(numbers) > 2_000_000:
            pairs = np.unique(pairs, return_inverse=True)[1].astype(np.uint64)
        _, which, counts = np.unique(pairs * kinds + ids[2:], return_inverse=True, return_counts=True)
        twice = counts[which] > 1
        if twice.any():
            inside = np.zeros(n, bool)
            for k in range(3):
                inside[k : n - 2 + k] |= twice
            repeated = int(inside.sum())
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated


def word_grams(word: str, order: int = ORDER) -> list[str]:
    padded = START * (order - 1) + word + END
    return [padded[i : i + order] for i in range(len(word) + 1)]


def gram_windows(words: list[str], order: int = ORDER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points of the padded words, where each gram starts in them, how many grams each word has)."""
    pad = START * (order - 1)
    codes = np.frombuffer("".join([pad + w + END for w in words]).encode("utf-32-le", "surrogatepass"), "<u4")
    many = np.fromiter(map(len, words), np.int64, len(words)) + 1
    first = np.cumsum(many + order - 1) - (many + order - 1)
    return codes, np.repeat(first, many) + ranges(many), many


def window_hashes(codes: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """``gram_hashes`` of the grams of ``order`` code points that start at ``at``."""
    h = np.full(len(at), order + 1, np.uint64)
    for k in range(order):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + codes[at + k].astype(np.uint64) + np.uint64(1))
    return h


def gram_sums(counted: dict[str, int], order: int) -> tuple[list[str], list[int]]:
    """The different grams of counted words, and how often each stands in them."""
    codes, at, many = gram_windows(list(counted), order)
    _, one, which = np.unique(window_hashes(codes, at, order), return_index=True, return_inverse=True)
    sums = np.bincount(which, np.repeat(np.fromiter(counted.values(), np.float64, len(counted)), many))
    text = codes[at[one][:, None] + np.arange(order)].tobytes().decode("utf-32-le", "surrogatepass")
    return [text[k : k + order] for k in range(0, len(text), order)], sums.astype(np.int64).tolist()


def ngram_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order: int = ORDER) -> DataFrame:
    """lang (null: empty), gram, n over all texts. A task holds a bounded number of words and grams."""
    taken = docs.select(
        F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("lang"), docs[text_col].cast("string").alias("text")
    )
    types = [pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        held: dict[str, Counter] = {}
        grams: dict[str, dict[str, int]] = {}

        def spread() -> None:
            for lang, counted in held.items():
                if not counted:
                    continue
                into = grams.setdefault(lang, {})
                for g, n in zip(*gram_sums(counted, order)):
                    into[g] = into.get(g, 0) + n
            held.clear()

        def passed() -> Iterator[pa.RecordBatch]:
            for lang, counted in grams.items():
                columns = [[lang] * len(counted), list(counted), list(counted.values())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "gram", "n"])
            grams.clear()

        for batch in sliced(batches, "text", 1_000_000):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(lang, Counter()).update(words_of(text))
            if sum(map(len, held.values())) > HELD_WORDS:
                spread()
                if sum(map(len, grams.values())) > HELD_GRAMS:
                    yield from passed()
        spread()
        yield from passed()

    pieces = taken.mapInArrow(run, "lang string, gram string, n bigint")
    return pieces.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """lang, k, gram, logp, backoff for every gram of every order, from the counts of the highest.

    ``logp`` is the interpolated log probability of the last character after the others; ``backoff`` is
    the log weight of the lower order after this gram as a context (null where it is none).
    """
    levels = {order: counts.select("lang", "gram", F.col("n").alias("a"))}
    for k in range(order - 1, 0, -1):
        shorter = F.substring("gram", 2, k).alias("gram")
        levels[k] = settle(levels[k + 1].groupBy("lang", shorter).agg(F.count("*").alias("a")), f"order-{k}")
    lower, out = None, None
    for k in range(1, order + 1):
        level = levels[k].withColumn("context", F.substring("gram", 1, k - 1)).withColumn("c", F.least("a", F.lit(4)))
        ones = [F.sum((F.col("a") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]
        seen = level.groupBy("lang").agg(*ones)
        y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
        rates = [_discount(i, y).alias(f"d{i}") for i in (1, 2, 3)]
        seen = seen.select("lang", *rates)
        left = level.join(seen, "lang").withColumn("d", F.when(F.col("a") == 1, F.col("d1")).when(F.col("a") == 2, F.col("d2")).otherwise(F.col("d3")))
        contexts = left.groupBy("lang", "context").agg(
            F.sum("a").alias("total"), (F.sum("d") / F.sum("a")).alias("gamma"), F.count("*").alias("kinds")
        )
        left = left.select("lang", "gram", "context", (F.col("a") - F.col("d")).alias("kept")).join(contexts, ["lang", "context"])
        if lower is None:
            below = F.lit(1.0) / F.col("kinds")
        else:
            short = lower.select("lang", F.col("gram").alias("ending"), F.col("p").alias("p_below"))
            left = left.withColumn("ending", F.substring("gram", 2, k - 1)).join(short, ["lang", "ending"])
            below = F.col("p_below")
        here = left.select("lang", "gram", (F.col("kept") / F.col("total") + F.col("gamma") * below).alias("p"))
        lower = settle(here, f"model-{k}") if k < order else here
        rows = lower.select("lang", F.lit(k).alias("k"), "gram", F.log("p").alias("v"))
        weights = contexts.select("lang", F.lit(-k).alias("k"), F.col("context").alias("gram"), F.log("gamma").alias("v"))
        out = rows.unionByName(weights) if out is None else out.unionByName(rows).unionByName(weights)
    return out


def _discount(i: int, y):
    """Chen and Goodman's discount for a count of ``i``, between a tenth and nine tenths of it."""
    with_next = F.when(F.col(f"n{i}") > 0, i - (i + 1) * y * F.col(f"n{i + 1}") / F.col(f"n{i}"))
    return F.least(F.greatest(F.coalesce(with_next, F.lit(0.5 * i)), F.lit(0.1 * i)), F.lit(0.9 * i))


def gram_hashes(texts: list[str], order: int) -> np.ndarray:
    """64-bit hashes of equally long strings."""
    if not texts:
        return np.empty(0, np.uint64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(texts), -1)
    h = np.full(len(texts), order + 1, np.uint64)
    for column in codes.T:
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64) + np.uint64(1))
    return h


def entry_hashes(k: int, grams: list[str]) -> np.ndarray:
    """Hashes of the grams of order ``k``, or of the contexts of order ``-k``."""
    return np.zeros(len(grams), np.uint64) if k == -1 else gram_hashes(grams, k if k > 0 else -k - 1)


class HashModel:
    """One language's model in sorted hash arrays: log probabilities per order, back-off per context."""

    def __init__(self, rows: list[tuple[int, str, float]], order: int = ORDER):
        kinds = np.array([r[0] for r in rows], np.int8)
        hashes = np.zeros(len(rows), np.uint64)
        for k in set(kinds.tolist()):
            at = np.flatnonzero(kinds == k)
            hashes[at] = entry_hashes(k, [rows[i][1] for i in at.tolist()])
        self._hold(kinds, hashes, np.array([r[2] for r in rows], np.float64), order)

    @classmethod
    def collected(cls, model: DataFrame, order: int = ORDER) -> HashModel:
        """The model of the rows (k, gram, v) of ``model``, hashed in the tasks; 17 bytes a row reach the driver's arrays."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kinds, hashes = batch.column(0).to_numpy(False), np.zeros(batch.num_rows, np.uint64)
                grams = batch.column(1).to_pylist()
                for k in set(kinds.tolist()):
                    at = np.flatnonzero(kinds == k)
                    hashes[at] = entry_hashes(k, [grams[i] for i in at.tolist()])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(hashes.view(np.int64)), batch.column(2)], names=["k", "hash", "v"])

        kinds, hashes, values = array("b"), array("q"), array("d")
        rows = model.select("k", "gram", "v").mapInArrow(run, "k int, hash bigint, v double")
        for k, h, v in rows.toLocalIterator(prefetchPartitions=True):
            kinds.append(k)
            hashes.append(h)
            values.append(v)
        made = cls([], order)
        made._hold(np.array(kinds, np.int8), np.array(hashes, np.int64).view(np.uint64), np.array(values, np.float64), order)
        return made

    def _hold(self, kinds: np.ndarray, hashes: np.ndarray, values: np.ndarray, order: int) -> None:
        self.order, self.arrays, self.memory = order, {}, {}
        for k in np.unique(kinds).tolist():
            part = np.flatnonzero(kinds == k)
            by = part[np.argsort(hashes[part], kind="stable")]
            self.arrays[k] = (hashes[by], values[by])

    def _find(self, k: int, texts: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
        keys, values = self.arrays.get(k, (np.empty(0, np.uint64), np.empty(0)))
        hashes = gram_hashes(texts, length) if length else np.zeros(len(texts), np.uint64)
        if not len(keys):
            return np.zeros(len(texts), bool), np.zeros(len(texts))
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        return keys[at] == hashes, values[at]

    def log_probabilities(self, grams: list[str]) -> np.ndarray:
        """Of each gram's last character; an unseen gram backs off to shorter ones, at last to 1e-7."""
        out, left, weight = np.zeros(len(grams)), np.arange(len(grams)), np.zeros(len(grams))
        for k in range(self.order, 0, -1):
            if not len(left):
                return out
            tails = [grams[i][-k:] for i in left.tolist()]
            hit, value = self._find(k, tails, k)
            out[left[hit]] = value[hit] + weight[left[hit]]
            known, backoff = self._find(-k, [t[:-1] for t in tails], k - 1)
            weight[left] += np.where(known, backoff, 0.0)
            left = left[~hit]
        out[left] = weight[left] + math.log(1e-7)
        return out

    def word_scores(self, words: set[str]) -> dict[str, float]:
        """Summed log probabilities of each word's grams, remembered between calls."""
        todo = [w for w in words if w not in self.memory]
        if todo:
            codes, at, many = gram_windows(todo, self.order)
            keys, values = self.arrays.get(self.order, (np.empty(0, np.uint64), np.empty(0)))
            hashes = window_hashes(codes, at, self.order)
            place = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
            known = keys[place] == hashes if len(keys) else np.zeros(len(hashes), bool)
            scored = values[place] if len(keys) else np.zeros(len(hashes))
            if not known.all():
                rest = codes[at[~known][:, None] + np.arange(self.order)].tobytes().decode("utf-32-le", "surrogatepass")
                scored[~known] = self.log_probabilities([rest[i : i + self.order] for i in range(0, len(rest), self.order)])
            ends = np.cumsum(many)
            sums = np.add.reduceat(scored, np.append(0, ends[:-1]))
            self.memory.update(zip(todo, sums.tolist()))
        return self.memory


def scored(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order: int = ORDER, carry: list[str] | None = None
) -> DataFrame:
    """``row`` (the columns ``carry``, by default all), lang, the base counts and log_perplexity (null without words) of each text of ``docs``.

    The smallest models are sent to the tasks, up to ``SENT_GRAMS`` and ``SENT_LANGS``. Texts of other
    languages are scored by joining their grams to the model, which has all of them.
    """
    spark = docs.sparkSession
    model = settle(kneser_ney(settle(ngram_counts(docs, text_col, lang_col, order), "grams"), order), "model")
    boxed = docs.select(
        F.struct(*[docs[c] for c in (docs.columns if carry is None else carry)]).alias("row"),
        F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("lang"),
        docs[text_col].cast("string").alias("text"),
    )
    sizes = model.groupBy("lang").count().orderBy("count", "lang").limit(SENT_LANGS + 1).collect()
    sent, total = {}, 0
    for lang, n in sizes[:SENT_LANGS]:
        total += n
        if total > SENT_GRAMS:
            break
        sent[lang] = spark.sparkContext.broadcast(HashModel.collected(model.filter(F.col("lang") == lang), order))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        models: dict[str, HashModel] = {}
        for batch in sliced(batches, "text", 1_000_000):
            langs, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            words = [words_of(t) for t in texts]
            need: dict[str, set] = {}
            for lang, found in zip(langs, words):
                need.setdefault(lang, set()).update(found)
            models.update((lang, sent[lang].value) for lang in need if lang in sent and lang not in models)
            if sum(len(m.memory) for m in models.values()) > HELD_SCORES:
                for m in models.values():
                    m.memory = {}
            known = {lang: models[lang].word_scores(found) for lang, found in need.items() if found and lang in models}
            scores = []
            for lang, found in zip(langs, words):
                if found and lang in known:
                    total = sum(map(known[lang].__getitem__, found))
                    scores.append(-total / (sum(map(len, found)) + len(found)))
                else:
                    scores.append(None)
            columns = list(zip(*map(base_counts, texts, words)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in columns], pa.array(scores, pa.float64())],
                names=["row", "lang", *names, "log_perplexity"],
            )

    fields = T.StructType.fromDDL("lang string, " + ", ".join(f"{n} bigint" for n in names) + ", log_perplexity double")
    if len(sent) == len(sizes):
        return boxed.mapInArrow(run, T.StructType([boxed.schema["row"], *fields.fields]))
    is_sent = F.col("lang").isin(list(sent))
    small = boxed.filter(is_sent).mapInArrow(run, T.StructType([boxed.schema["row"], *fields.fields]))
    large = settle(boxed.filter(~is_sent).withColumn("uid", F.monotonically_increasing_id()), "large-languages")
    sums = joined_scores(large.select("uid", "lang", "text"), model.filter(~is_sent & (F.col("k") == order)), order)
    numbered = large.select(F.struct("row", "uid").alias("row"), "lang", "text")
    counted = numbered.mapInArrow(run, T.StructType([numbered.schema["row"], *fields.fields])).drop("log_perplexity")
    joined = counted.withColumn("uid", F.col("row.uid")).join(sums, "uid", "left")
    value = (-F.col("total") / F.lit(float(STEPS)) / (F.col("word_chars") + F.col("n_words"))).alias("log_perplexity")
    return small.unionByName(joined.select(F.col("row.row").alias("row"), "lang", *names, value))


def joined_scores(texts: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """uid, total (log probability in ``STEPS``) of each of ``texts`` (uid, lang, text) that has words.

    Every gram of the texts must be in ``model`` (lang, gram, v).
    """
    types = [pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1_000_000):
            for uid, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                if counted := Counter(words_of(text)):
                    grams, n = gram_sums(counted, order)
                    columns = [[uid] * len(n), [lang] * len(n), grams, n]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["uid", "lang", "gram", "n"])

    grams = texts.mapInArrow(run, "uid bigint, lang string, gram string, n bigint")
    steps = model.select("lang", "gram", F.round(F.col("v") * STEPS).cast("long").alias("steps"))
    return grams.join(steps, ["lang", "gram"]).groupBy("uid").agg(F.sum(F.col("n") * F.col("steps")).alias("total"))


def quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", lower: float = LOWER, upper: float = UPPER,
            carry: list[str] | None = None) -> DataFrame:
    """``row`` with n_words, the base counts, base_failed, log_perplexity, its band, and kept.

    Null and wordless texts fail the base rules. A null language counts as a language of its own. A
    language none of whose texts passes the base rules has no band and rejects nothing further. Rows
    that repeat, and ties, are judged alike. An empty table gives an empty result.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stored = settle(scored(docs, text_col, lang_col, carry=carry).withColumn("base_failed", failed), "scored")
    sound = stored.filter(~F.col("base_failed")).select("lang", "log_perplexity")
    middle = sound.groupBy("lang").agg(F.percentile_approx("log_perplexity", 0.5, 10000).alias("middle"))
    middle = settle(middle, "middle")
    off = sound.join(middle, "lang").groupBy("lang").agg(
        F.first("middle").alias("middle"),
        F.percentile_approx(F.abs(F.col("log_perplexity") - F.col("middle")), 0.5, 10000).alias("mad"),
    )
    spread = F.greatest(1.4826 * F.col("mad"), F.lit(LEAST_SPREAD))
    bands = off.select("lang", (F.col("middle") - lower * spread).alias("band_low"), (F.col("middle") + upper * spread).alias("band_high"))
    bands = settle(bands, "bands")
    judged = stored.join(bands, "lang", "left")
    outside = ~F.col("log_perplexity").between(F.col("band_low"), F.col("band_high"))
    kept = ~F.col("base_failed") & ~F.coalesce(outside, F.lit(False))
    return judged.withColumn("kept", kept)


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, n_words, the base counts, base_failed, kept, and the perplexity behind it."""
    taken = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    slim = quality(taken, carry=["doc_id"])
    return slim.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "log_perplexity",
    )


def kept_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns unchanged; rows are told apart by number.

    Only numbers, languages and texts go through the model. The numbers of rejected rows come back.
    """
    row = F.struct(*[docs[c] for c in docs.columns])
    stored = settle(docs.select(F.monotonically_increasing_id().alias("uid"), row.alias("row")), "numbered")
    taken = stored.select("uid", F.col("row")[text_col].alias("text"), F.col("row")[lang_col].alias("lang"))
    rejected = settle(quality(taken, carry=["uid"]).filter(~F.col("kept")).select("row.uid"), "rejected")
    sent = F.broadcast(rejected) if fits(rejected, SENT_IDS) else rejected
    return stored.join(sent, "uid", "left_anti").select("row.*")
