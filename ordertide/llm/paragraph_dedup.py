"""Operator 1: near-duplicate paragraphs by MinHash banding.

Paragraphs are the lines of a text that have five words or more, the length of one shingle; a character
of a script without spaces counts as a word. A passage pasted into a longer line is no near-duplicate of
that line, so the lines that stay are cut into passages, which are compared in the same way: sentences,
and those of more than ``LONG`` words again where a pair of words has the least hash of the ``NEAR``
places on either side. Both cuts follow from the words around them, so that the same words are cut alike
in other surroundings. As passages are taken from lines that stay, one of each cluster is kept.

Paragraphs with the same set of five-word shingles are one class and meet once. Classes of up to
``FEW`` shingles meet by pairs among the least of them, enough that no pair at the threshold is missed.
Larger ones have a sketch of minwise tokens, cut into ``BANDS`` bands of ``ROWS``, and collide when they
agree in a whole band. Ten bands of two miss a pair at the threshold of 0.75 with probability
(1 - 0.75 ** 2) ** 10, 3e-4, and a pair at 0.9 with 6e-8. Colliding classes are joined, verified by the
exact Jaccard similarity of their full shingle sets, and clustered by connected components. Of each
cluster the first paragraph, by document and place, stays; the others are removed.

Crowded bands are handled as in operator 2: links to one pivot first, then only between components.

Texts are stored once. Lines and passages are places in them, and are cut out again only where classes meet.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.components import components
from ordertide.llm.near_dedup import _BASE, _MINWISE, COORDINATES, PERCENT, SENT_IDS, SHINGLE, links_in, word_hashes
from ordertide.llm.rows import mixed, ranges, sliced
from ordertide.session import fits, recorded_scratch, remove_scratch, settle

BANDS, ROWS = 10, 2
#: Shorter paragraphs have no shingle and are not looked at.
MIN_WORDS = SHINGLE
#: Classes of so many shingles meet by pairs of their least ones, larger ones by bands.
FEW = 11
#: Sentences of more words are cut where a pair of words has the least hash of so many on either side.
LONG, NEAR = 40, 4

_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")
#: It starts with one set of characters, for which Python's search skips ahead.
_END = re.compile("[.!?\u2026\u0964\u061f\u3002\uff01\uff1f](?:(?<=[.!?\u2026\u0964\u061f])[.!?\u2026\u0964\u061f]*[\"')\\]\u00bb\u201d\u2019]*[ \\t\\v\\f\\r]+|(?<=[\u3002\uff01\uff1f])[\u3002\uff01\uff1f]*[\"')\\]\u00bb\u201d\u2019]*[ \\t\\v\\f\\r]*)")


def band_keys(sketches: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each row of ``sketches`` and band."""
    keys = np.empty((len(sketches), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(sketches), b + 1, np.uint64)
        for r in range(rows):
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + sketches[:, b * rows + r].astype(np.uint64))
        keys[:, b] = h
    return keys


def spaced(text: str) -> str:
    """``text`` with each character of a script without spaces as a word of its own."""
    return text if text.isascii() else _UNSPACED.sub(r" \1 ", text)


def _long_enough(text: str) -> bool:
    if text.isascii():
        return len(text.encode().split(None, MIN_WORDS - 1)) == MIN_WORDS
    return len(spaced(text).encode("utf-8", "surrogatepass").split(None, MIN_WORDS - 1)) == MIN_WORDS


def passages(line: str) -> list[tuple[int, int]]:
    """Where the passages of a line start and stop; a shorter sentence belongs to the one before."""
    out: list[list[int]] = []
    at = 0
    for stop in [*[m.end() for m in _END.finditer(line)], len(line)]:
        if stop == at:
            continue
        if out and not _long_enough(line[at:stop]):
            out[-1][1] = stop
        else:
            out.append([at, stop])
        at = stop
    return [cut for a, b in out for cut in _cut(line, a, b)]


def _cut(line: str, start: int, stop: int) -> list[tuple[int, int]]:
    part = line[start:stop]
    plain = part.isascii() or not _UNSPACED.search(part)
    if plain and len(part.encode("utf-8", "surrogatepass").split()) <= LONG:
        return [(start, stop)]
    words = [m.span() for m in (_PLAIN if plain else _WORD).finditer(part)]
    if len(words) <= LONG:
        return [(start, stop)]
    with np.errstate(over="ignore"):
        hashes = word_hashes(" ".join(part[a:b] for a, b in words).encode("utf-8", "surrogatepass"))[0]
        pairs = mixed(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:])
    padded = np.concatenate([np.zeros(NEAR, np.uint64), pairs, np.zeros(NEAR, np.uint64)])
    around = np.lib.stride_tricks.sliding_window_view(padded, 2 * NEAR + 1)
    least = (pairs < around[:, :NEAR].min(axis=1)) & (pairs <= around[:, NEAR + 1 :].min(axis=1))
    edges = [start, *[start + words[k][0] for k in np.flatnonzero(least).tolist()], stop]
    return list(zip(edges[:-1], edges[1:]))


_PLAIN = re.compile("[^ \\t\\n\\v\\f\\r]+")
_WORD = re.compile(_UNSPACED.pattern + "|(?:(?!" + _UNSPACED.pattern + ")[^ \\t\\n\\v\\f\\r])+")


def _flat_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The shingle sets of texts of ``MIN_WORDS`` words or more, one after another, and their sizes."""
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    hashes, starts = word_hashes(b" ".join(parts))
    bounds = np.cumsum([len(p) + 1 for p in parts])
    cuts = np.concatenate([[0], np.searchsorted(starts, bounds)])
    rolled = np.zeros(len(hashes) - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        rolled = rolled * np.uint64(_BASE) + hashes[k : k + len(rolled)]
    many = np.diff(cuts) - SHINGLE + 1
    owner = np.repeat(np.arange(len(many)), many)
    values = mixed(rolled[np.repeat(cuts[:-1], many) + ranges(many)])
    by = np.lexsort((values, owner))
    values, owner = values[by], owner[by]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.bincount(owner[new], minlength=len(many))


def _least(values: np.ndarray, sizes: np.ndarray, coordinates: int) -> np.ndarray:
    """The first ``coordinates`` of the sketch of each set, of so many ``values`` each; none is empty."""
    at = np.cumsum(sizes) - sizes
    least = [np.minimum.reduceat(values * _MINWISE[c], at) >> np.uint64(32) for c in range(coordinates)]
    return np.stack(least, axis=1).astype("<u4")


def signatures(texts: list[str], percent: int = PERCENT) -> tuple[list[bytes], pa.ListArray]:
    """The class of each text of ``MIN_WORDS`` words or more, and the keys under which it meets similar ones."""
    with np.errstate(over="ignore"):
        values, sizes = _flat_sets([spaced(t) for t in texts])
        first = np.cumsum(sizes) - sizes
        few = FEW if percent > 66 else 0
        banded = np.flatnonzero(sizes > few)
        bands = np.empty((len(sizes), BANDS), np.uint64)
        if len(banded):
            held, n = values[np.repeat(first[banded], sizes[banded]) + ranges(sizes[banded])], sizes[banded]
            bands[banded] = band_keys(_least(held, n, BANDS * ROWS))
        made, counts = [], np.zeros(len(sizes), np.int64)
        for n in np.unique(sizes).tolist():
            which, columns = np.flatnonzero(sizes == n), []
            if 2 < n and percent * n <= 100 * few:
                least = values[first[which][:, None] + np.arange(n + 2 - -(-percent * n // 100))]
                columns += [mixed(mixed(least[:, i]) * np.uint64(0x9E3779B97F4A7C15) + least[:, j]) for i, j in combinations(range(least.shape[1]), 2)]
            if n > few:
                columns += list(bands[which].T)
            if columns:
                made.append((which, np.stack(columns, axis=1)))
                counts[which] = len(columns)
        ends = np.cumsum(counts)
        keys = np.empty(int(counts.sum()), np.uint64)
        for which, rows in made:
            keys[(ends - counts)[which][:, None] + np.arange(rows.shape[1])] = rows
        data, cuts = values.tobytes(), [0, *(8 * np.cumsum(sizes)).tolist()]
    classes = [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(cuts[:-1], cuts[1:])]
    return classes, pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(keys.view(np.int64)))


def _units(taken: DataFrame, cut: Callable[[str], list[tuple[int, int]]], percent: int) -> DataFrame:
    """doc, doc_id, place (of the line), start (in the line), at (in the text), length, class, keys of what is long enough.

    ``cut`` says where the units of a line start and stop. Lines whose place is in ``gone`` are left out.
    """
    names = ["doc", "doc_id", "place", "start", "at", "length"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1_000_000):
            rows: list[tuple] = []
            texts: list[str] = []
            for doc, doc_id, text, gone in zip(*(c.to_pylist() for c in batch.columns)):
                at, gone = 0, set(gone or ())
                for place, line in enumerate((text or "").split("\n")):
                    if place not in gone and _long_enough(line):
                        for a, b in cut(line):
                            if (a, b) == (0, len(line)) or _long_enough(line[a:b]):
                                rows.append((doc, doc_id, place, a, at + a, b - a))
                                texts.append(line[a:b])
                    at += len(line) + 1
            if rows:
                classes, keys = signatures(texts, percent)
                known = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([*known, pa.array(classes, pa.binary()), keys], names=[*names, "class", "keys"])

    schema = "doc bigint, doc_id bigint, place int, start int, at int, length int, class binary, keys array<bigint>"
    return taken.select("doc", "doc_id", "text", "gone").mapInArrow(run, schema)


def paragraphs(texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every line of ``texts`` (doc, doc_id, text) that is long enough, by its place; see ``_units``."""
    return _units(texts.withColumn("gone", F.lit(None).cast("array<int>")), lambda line: [(0, len(line))], percent)


def line_passages(texts: DataFrame, lines: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every passage long enough of the lines that stay, by its place; see ``_units``."""
    gone = settle(lines.filter("removed").groupBy("doc").agg(F.collect_list("place").alias("gone")), "gone")
    return _units(texts.join(_sent(gone), "doc", "left"), passages, percent)


def cut_out(texts: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` (doc, at, length, ...) with the text that stands there."""
    return texts.select("doc", F.col("text").alias("whole")).join(places, "doc").withColumn("text", F.expr("substring(whole, at + 1, length)")).drop("whole")


def _sent(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits(df, SENT_IDS) else df


def clustered(units: DataFrame, texts: DataFrame, percent: int, *order: str) -> DataFrame:
    """``units`` (with uid, class, keys; stored) with cluster, and removed for all but its first by ``order``.

    Only units that meet another class under some key are cut out of ``texts`` again.
    """
    entries = units.select(F.xxhash64("class").alias("cid"), F.explode("keys").alias("node"))
    kinds = entries.groupBy("node").agg(F.min("cid").alias("low"), F.max("cid").alias("high"))
    shared = settle(kinds.filter("low <> high").select("node"), "shared")
    met = settle(entries.join(_sent(shared), "node").select("node", "cid").distinct(), "met")
    need = settle(met.select("cid", F.lit(True).alias("meets")).distinct(), "needed")
    classes = units.groupBy("class").agg(F.min("uid").alias("rep"), F.count("*").alias("copies")).withColumn("cid", F.xxhash64("class"))
    classes = settle(classes.join(_sent(need), "cid", "left").filter("copies > 1 or meets"), "classes")
    meets = classes.filter("meets").select("cid", F.col("rep").alias("uid"))
    entries = settle(met.join(_sent(meets), "cid").select("node", "uid"), "entries")
    places = settle(units.select("uid", "doc", "at", "length").join(_sent(meets.select("uid")), "uid"), "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1_000_000):
            with np.errstate(over="ignore"):
                values, sizes = _flat_sets(batch.column(1).to_pylist())
                made = [x.tobytes() for x in _least(values, sizes, COORDINATES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["uid", "sketch"])

    words = F.regexp_replace("text", _UNSPACED.pattern, " $1 ")
    meeting = settle(cut_out(texts, _sent(places)).select("uid", words.alias("text")), "meeting-texts")
    sketches = settle(meeting.mapInArrow(run, "uid bigint, sketch binary"), "sketches")
    roots = components(links_in(entries, meeting, sketches, percent, 1))
    named = classes.join(roots, classes["rep"] == roots["uid"], "left").filter("copies > 1 or root is not null")
    named = settle(named.select("class", F.coalesce("root", "rep").alias("root")), "named")
    placed = units.drop("keys").join(_sent(named), "class", "left")
    ranked = F.struct(F.col("doc_id").isNull(), *order, "uid")
    first = placed.filter("root is not null").groupBy("root").agg(F.min(ranked).alias("first"))
    first = settle(first.select(F.col("root").alias("cluster"), F.col("first.uid").alias("first_uid")), "first")
    placed = placed.withColumn("cluster", F.coalesce("root", "uid")).drop("root", "class")
    joined = placed.join(_sent(first), "cluster", "left")
    return joined.withColumn("removed", F.coalesce(F.col("uid") != F.col("first_uid"), F.lit(False))).drop("first_uid")


def _judged(texts: DataFrame, percent: int) -> DataFrame:
    """doc, doc_id, place, at, length, cluster, removed, passages of every paragraph long enough in ``texts`` (doc, doc_id, text; stored)."""
    numbered = F.monotonically_increasing_id().alias("uid")
    with recorded_scratch() as spent:
        stored = settle(paragraphs(texts, percent).select("*", numbered), "paragraphs")
        lines = clustered(stored, texts, percent, "doc_id", "doc", "place")
    lines = settle(lines.select("doc", "doc_id", "place", "at", "length", "cluster", "removed"), "lines")
    remove_scratch(texts.sparkSession, spent)
    parts = settle(line_passages(texts, lines, percent).select("*", numbered), "passages")
    judged = clustered(parts, texts, percent, "doc_id", "doc", "place", "start").filter("removed")
    cut = judged.select("doc", "place", F.struct("start", "length").alias("cut"))
    cut = cut.groupBy("doc", "place").agg(F.array_sort(F.collect_list("cut")).alias("passages"))
    return lines.join(cut, ["doc", "place"], "left")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (number of the row), doc_id, text of every row, stored once; all else holds places in it."""
    taken = docs.select(
        F.monotonically_increasing_id().alias("doc"), docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")
    )
    return settle(taken, "texts")


def duplicate_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc, doc_id, place, text, cluster, removed, passages of every paragraph long enough.

    ``passages`` are the start and length, in characters, of what is removed inside a line that stays.
    Null and empty texts have no paragraphs. Repeated rows are documents of their own, so that all but
    one of them lose their paragraphs; ties go to the row read first. An empty table stays empty.
    """
    texts = _texts(docs, id_col, text_col)
    found = settle(_judged(texts, percent), "judged")
    return cut_out(texts, found).select("doc", "doc_id", "place", "text", "cluster", "removed", "passages")


def paragraph_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_paragraphs (long enough), n_removed, n_chars_removed, removed_places, n_passages_removed,
    removed_passages (place, start, length) of every row that has any. Passages are counted in n_chars_removed.
    """
    found = _judged(_texts(docs, id_col, text_col), PERCENT)
    gone = F.col("removed")
    inside = F.coalesce(F.aggregate("passages", F.lit(0), lambda a, x: a + x["length"]), F.lit(0))
    parts = F.transform("passages", lambda x: F.struct(F.col("place"), x["start"].alias("start"), x["length"].alias("length")))
    return found.groupBy("doc", "doc_id").agg(
        F.count("*").alias("n_paragraphs"),
        F.sum(gone.cast("long")).alias("n_removed"),
        F.sum(F.when(gone, F.col("length")).otherwise(inside)).cast("long").alias("n_chars_removed"),
        F.array_sort(F.collect_list(F.when(gone, F.col("place")))).alias("removed_places"),
        F.sum(F.coalesce(F.size("passages"), F.lit(0))).cast("long").alias("n_passages_removed"),
        F.array_sort(F.flatten(F.collect_list(parts))).alias("removed_passages"),
    ).drop("doc")
