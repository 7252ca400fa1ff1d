"""Operator 10: benchmark decontamination by a distributed positional inverted index.

``build_index`` stores the token postings of the training texts. The index is partitioned by document:
a segment holds the documents that one task read one after another, up to a fixed number of words, with
its own term dictionary and, for every term, the ascending positions at which it stands. Documents
lie back to back with a gap between them, so that no run of positions crosses a document end.

``search`` takes phrases. In each segment a phrase is looked up in the dictionary; if a term is missing
it cannot occur. Else the lists are intersected from the rarest term to the most frequent one, each
shifted by the term's place in the phrase: exact phrase matches. ``proximity`` finds the spans that hold
all terms of a phrase, in any order, within a given width.

Nothing is shuffled to build or search the index, so no frequent word gathers anywhere. Phrases go to
the tasks in blocks of a bounded number of words, however large the benchmark is; only matches are
grouped, by document.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.rows import sliced
from ordertide.session import fits, settle

WINDOW = 13
#: A segment is closed at the first document end at or past so many words.
SEGMENT_WORDS = 1 << 20
#: Words of phrases that are sent to the tasks at a time.
BLOCK_WORDS = 1 << 20
#: Numbers of contaminated rows that may be sent to all tasks; beyond that they are joined.
SENT_IDS = 500_000

SEGMENT = (
    "segment bigint, doc_ids array<bigint>, n_words array<bigint>, "
    "terms binary, counts binary, positions binary"
)
#: Words are runs of ASCII letters, digits and characters beyond ASCII; A-Z become a-z.
_TO_SPACE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, A-Z lower-cased; none for null."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """The index of ``docs`` as a stored table, one row per segment. An empty table has no segments.

    Every row is a document of its own, repeated ids included; null texts have no words. A document
    longer than a segment gets one to itself. Other columns are not read.
    """
    taken = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    schema = pa.schema([
        ("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())),
        ("terms", pa.binary()), ("counts", pa.binary()), ("positions", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, k = TaskContext.get().partitionId() << 32, 0
        ids: list = []
        lengths: list[int] = []
        numbers: dict[bytes, int] = defaultdict(count().__next__)
        stream: list[np.ndarray] = []
        size = 0

        def closed() -> pa.RecordBatch:
            row = [[base + k], [ids], [lengths], *[[x] for x in _postings(stream, lengths, numbers)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, schema.types)], schema=schema)

        for batch in sliced(batches, "text", 1_000_000):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = words(text)
                stream.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                ids.append(doc_id)
                lengths.append(len(found))
                size += len(found)
                if size >= segment_words:
                    yield closed()
                    ids, lengths, stream, size, k = [], [], [], 0, k + 1
                    numbers = defaultdict(count().__next__)
        if ids:
            yield closed()

    return settle(taken.mapInArrow(run, SEGMENT), "positional-index")


def _starts(lengths: np.ndarray) -> np.ndarray:
    """Where each document begins; one position stays free behind each."""
    return np.cumsum(lengths + 1) - (lengths + 1)


def _postings(stream: list[np.ndarray], lengths: list[int], numbers: dict[bytes, int]) -> tuple[bytes, bytes, bytes]:
    """Terms in order of appearance, how often each stands, and their positions list after list."""
    flat = np.concatenate(stream)
    n = np.asarray(lengths, np.int64)
    places = np.arange(len(flat)) + np.repeat(np.arange(len(n)), n)
    counts = np.bincount(flat, minlength=len(numbers)).astype("<u4")
    keyed = np.sort((flat.astype(np.uint64) << np.uint64(32)) | places.astype(np.uint64))
    return b" ".join(numbers), counts.tobytes(), keyed.astype("<u4").tobytes()


class Segment:
    """One segment, opened for the terms ``wanted``: their postings and the matches of phrases."""

    def __init__(self, terms: bytes, counts: bytes, positions: bytes, wanted: set[bytes]):
        self.terms = {t: i for i, t in enumerate(terms.split(b" ")) if t in wanted} if terms else {}
        self.counts = np.frombuffer(counts, "<u4").astype(np.int64)
        self.ends = np.cumsum(self.counts)
        self.positions = np.frombuffer(positions, "<u4").astype(np.int64)

    def postings(self, term: int) -> np.ndarray:
        return self.positions[self.ends[term] - self.counts[term] : self.ends[term]]

    def phrase(self, phrase: list[bytes]) -> np.ndarray:
        """Ascending positions at which ``phrase`` begins."""
        lookup = self.terms.get
        known = [lookup(w) for w in phrase]
        if not phrase or None in known:
            return np.empty(0, np.int64)
        order = sorted(range(len(known)), key=lambda i: self.counts[known[i]])
        first = order[0]
        found = self.postings(known[first]) - first
        for i in order[1:]:
            if not len(found):
                break
            found = found[_among(found + i, self.postings(known[i]))]
        return found

    def near(self, phrase: list[bytes], width: int, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Ascending positions p such that p..p+width-1 holds every term of ``phrase``, p one of them, all in
        the document of p; documents begin at ``first`` and have so many words.

        Around each place of the rarest term only, the other lists are asked for their next place.
        """
        known = [self.terms.get(w) for w in dict.fromkeys(phrase)]
        if not known or None in known:
            return np.empty(0, np.int64)
        known.sort(key=lambda t: self.counts[t])
        anchor = self.postings(known[0])
        around = [self.postings(known[0])]
        for t in known[1:]:
            p = self.postings(t)
            at = np.searchsorted(anchor, p, "left")
            close = np.zeros(len(p), bool)
            close |= (at < len(anchor)) & (anchor[np.minimum(at, len(anchor) - 1)] - p < width)
            close |= (at > 0) & (p - anchor[np.maximum(at - 1, 0)] < width)
            around.append(p[close])
        starts = np.unique(np.concatenate(around))
        doc = np.searchsorted(first, starts, "right") - 1
        ends = np.minimum(starts + width, first[doc] + lengths[doc])
        for p in around:
            at = np.searchsorted(p, starts, "left")
            held = np.append(p, np.iinfo(np.int64).max)[at] < ends
            starts, ends = starts[held], ends[held]
        return starts


def _among(wanted: np.ndarray, sorted_in: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_in, wanted)
    return sorted_in[np.minimum(at, len(sorted_in) - 1)] == wanted


def item_windows(text: str | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    """The windows of a benchmark item; an item of fewer words, but not none, is one window."""
    w = words(text)
    if not w:
        return []
    return [tuple(w[i : i + window]) for i in range(max(1, len(w) - window + 1))]


def search(index: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text",
           window: int = WINDOW, proximity: int | None = None, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Matches of the windows of ``items``: segment, doc_no, starts and ends (word offsets), items.

    One row per document with a match and block of items. With ``proximity`` a match is a span of that
    many words with all words of a window, instead of the exact phrase. Items are dealt to blocks by
    the hash of their id and text, and the driver holds one block at a time.
    """
    spark = index.sparkSession
    taken = items.select(items[item_col].cast("string").alias("item"), items[text_col].cast("string").alias("text"))
    total = taken.agg(F.coalesce(F.sum(F.length("text") / 2 * window), F.lit(0))).head()[0]
    blocks = int(total // (block_words * window)) + 1
    out = None
    for b in range(blocks):
        block = taken.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b)
        phrases: dict[tuple, set] = {}
        for item, text in block.toLocalIterator():
            for phrase in item_windows(text, window):
                phrases.setdefault(phrase, set()).add(item)
        sent = spark.sparkContext.broadcast([(list(p), sorted(i, key=str)) for p, i in phrases.items()])
        made = index.mapInArrow(_searcher(sent, proximity), MATCHES)
        out = made if out is None else out.unionByName(made)
    return out


MATCHES = "segment bigint, doc_no int, starts array<bigint>, ends array<bigint>, items array<string>"


def _searcher(sent, proximity: int | None):
    types = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string())]
    names = ["segment", "doc_no", "starts", "ends", "items"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {w for phrase, _ in sent.value for w in phrase}
        for batch in batches:
            for k in range(batch.num_rows):
                number, _, lengths, terms, counts, positions = (c[k].as_py() for c in batch.columns)
                opened = Segment(terms, counts, positions, wanted)
                sizes = np.asarray(lengths, np.int64)
                first = _starts(sizes)
                spans: dict[int, set] = {}
                named: dict[int, set] = {}
                for phrase, items in sent.value:
                    found = opened.near(phrase, proximity, first, sizes) if proximity else opened.phrase(phrase)
                    if len(found):
                        docs = np.searchsorted(first, found, "right") - 1
                        width = proximity or len(phrase)
                        for d, s in zip(docs.tolist(), (found - first[docs]).tolist()):
                            spans.setdefault(d, set()).add((s, min(s + width, lengths[d])))
                            named.setdefault(d, set()).update(items)
                rows = [(number, d, *zip(*sorted(s)), sorted(x for x in named[d] if x is not None)) for d, s in spans.items()]
                columns = list(zip(*rows)) if rows else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits, digests = [], []
        for starts, ends, items in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            hit, upto = 0, 0
            for s, e in sorted(zip(starts or (), ends or ())):
                hit += max(0, e - max(s, upto))
                upto = max(upto, e)
            names = sorted(set(items or ()))
            hits.append((hit, len(names)))
            digests.append(hashlib.sha256(",".join(names).encode()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([h for h, _ in hits], pa.int64()),
             pa.array([n for _, n in hits], pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256"],
        )


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word inside any occurrence of a window is hit; a document is contaminated when one word in twenty
    is hit. No words, or no items: nothing is hit. An item without id hits words but is not listed.
    """
    index = build_index(docs, id_col, text_col)
    matches = search(index, items, item_col, item_text_col, window)
    gathered = matches.groupBy("segment", "doc_no").agg(
        *[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")]
    )
    rows = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("doc_no", "d"))
    rows = rows.select("segment", "doc_no", F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").alias("n_words"))
    joined = rows.join(gathered, ["segment", "doc_no"], "left").select("doc_id", "n_words", "starts", "ends", "items")
    merged = joined.mapInArrow(_merged, "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string")
    return merged.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean_documents(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns unchanged; rows are told apart by number."""
    boxed = docs.select(F.monotonically_increasing_id().alias("uid"), F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].cast("string").alias("text"))
    stored = settle(boxed, "numbered")
    found = contamination(stored.select("uid", "text"), items, "uid", "text", item_col, item_text_col)
    bad = settle(found.filter("contaminated").select(F.col("doc_id").alias("uid")), "contaminated")
    return stored.join(F.broadcast(bad) if fits(bad, SENT_IDS) else bad, "uid", "left_anti").select("row.*")
