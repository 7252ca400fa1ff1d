"""Operator 7: exact substring dedup by a hash-compared suffix sort.

Every byte covered by a string of ``length`` bytes that also starts elsewhere is removed. Not every
suffix is sorted, only those that a repeated string must contain:

1. *Anchors.* In each run of ``SPAN`` consecutive byte positions the one whose 32 bytes have the least
   hash is an anchor. The choice depends on the bytes alone, so two equal strings of ``length`` bytes
   have an anchor at the same place among their first ``SPAN`` bytes, and agree on the ``length - SPAN
   + 1`` bytes behind it. Anchors whose bytes occur once are dropped after a counted shuffle of hashes.
2. *Contexts.* What surrounds an anchor, ``SPAN - 1`` bytes before and ``length`` behind, decides for
   all strings with that anchor. Equal contexts are counted, not compared: however often a passage is
   copied, it is one context.
3. *Suffix sort.* Different contexts with the same bytes behind the anchor are sorted by mergesort, once
   by what follows the anchor and once by what precedes it, read backwards. Prefix polynomial hashes
   and binary search give the common extension of two suffixes, hence their order, in logarithmic
   time. Common extensions of neighbours are verified byte by byte; a collision repeats the sort with
   another hash. A string that starts ``a`` bytes before its anchor is repeated if another context is
   in the same run of neighbours with ``length - a`` bytes behind and ``a`` bytes before.
4. Spans are joined to the texts. Equal texts share them.

A task holds one group of contexts, at most ``GROUP`` of them. A larger group is split by what its strings
have in common in halves of the places where they may start, until its parts are small enough.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.llm.rows import mixed, sliced
from ordertide.session import fits, settle

LENGTH = 400
SPAN = 256
GRAM = 32
#: Contexts of one group that are sorted together in a task (6 kB each).
GROUP = 20_000
#: Contexts that are sorted in one go.
CHUNK = 4_000
#: Texts that may be picked out by ids sent to all tasks; beyond that they are joined.
SENT_IDS = 500_000

_rng = np.random.default_rng(7)
_BYTES = _rng.integers(1, 2**63, 256, np.uint64)
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def anchors(parts: list[bytes], length: int = LENGTH, span: int = SPAN) -> dict[str, np.ndarray]:
    """doc (index in ``parts``), p, key, context, before, behind of the anchors of each text."""
    starts = np.cumsum([0] + [len(x) for x in parts])
    n = int(starts[-1])
    empty = np.empty(0, np.int64)
    if n < length:
        return dict.fromkeys(("doc", "p", "key", "context", "before", "behind"), empty)
    b = np.frombuffer(b"".join(parts), np.uint8)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[b] * _powers(_BASE, n), out=sums[1:])
    shift = _powers(_INVERSE, n)

    def hashed(at: np.ndarray, to: np.ndarray) -> np.ndarray:
        return mixed((sums[to] - sums[at]) * shift[at])

    grams = n - GRAM + 1
    order = mixed((sums[GRAM:] - sums[:grams]) * shift[:grams]) & np.uint64(0xFFFFFFFF00000000)
    padded = np.full(-(-grams // span) * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:grams] = order | np.arange(grams, dtype=np.uint64)
    rows = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = grams - span + 1
    least = np.minimum(back[:windows], ahead[span - 1 :][:windows])
    inside = np.zeros(windows, bool)
    for i, x in enumerate(parts):
        if len(x) >= length:
            inside[starts[i] : starts[i + 1] - length + 1] = True
    p = np.unique(least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.searchsorted(starts, p, "right") - 1
    before = np.minimum(span - 1, p - starts[doc])
    behind = np.minimum(length, starts[doc + 1] - p)
    context = hashed(p - before, p + behind) ^ mixed((before * 4096 + behind).astype(np.uint64))
    return {
        "doc": doc, "p": p - starts[doc], "key": hashed(p, p + length - span + 1).view(np.int64),
        "context": mixed(context).view(np.int64), "before": before, "behind": behind,
    }


class Contexts:
    """Contexts of some groups, aligned at their anchors, with prefix hashes from there both ways."""

    def __init__(self, group: np.ndarray, before: np.ndarray, behind: np.ndarray, data: list[bytes],
                 length: int = LENGTH, span: int = SPAN, base: int = _BASE):
        self.group, self.before, self.behind = group, before, behind
        self.length, self.centre = length, span - 1
        width = self.centre + length
        blank = bytes(width)
        rows = [blank[: self.centre - f] + d + blank[: width - self.centre - t] for f, t, d in zip(before.tolist(), behind.tolist(), data)]
        self.bytes = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, width)
        self.sums = np.zeros((len(data), width + 1), np.uint64)
        np.cumsum(_BYTES[self.bytes] * _powers(base, width), axis=1, out=self.sums[:, 1:])
        self.sums -= self.sums[:, self.centre : self.centre + 1].copy()

    def extension(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        """Bytes that contexts i and j share from their anchors on (``way`` 1) or before them (-1)."""
        reach = self.behind if way > 0 else self.before
        low, high = np.zeros(len(i), np.int64), np.minimum(reach[i], reach[j])
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) // 2
            at = self.centre + way * mid
            same = self.sums[i, at] == self.sums[j, at]
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)

    def less(self, i: np.ndarray, j: np.ndarray, way: int) -> np.ndarray:
        """Whether suffix i comes before suffix j; a prefix of the other comes first, then the lower index."""
        reach = self.behind if way > 0 else self.before
        n = self.extension(i, j, way)
        ended_i, ended_j = n == reach[i], n == reach[j]
        at = self.centre + (n if way > 0 else -n - 1)
        at = np.clip(at, 0, self.bytes.shape[1] - 1)
        by_byte = self.bytes[i, at] < self.bytes[j, at]
        by_end = np.where(reach[i] == reach[j], i < j, reach[i] < reach[j])
        return np.where(ended_i & ended_j, by_end, np.where(ended_i | ended_j, ended_i, by_byte))

    def sorted(self, way: int) -> np.ndarray:
        """Mergesort of all groups side by side: runs of 1, 2, 4 ... are merged by ranking in the other run."""
        order = np.arange(len(self.group))
        first = np.flatnonzero(np.diff(self.group, prepend=-1))
        sizes = np.diff(np.append(first, len(self.group)))
        start, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        width = 1
        while width < sizes.max(initial=0):
            at = np.flatnonzero(size > width)
            local = at - start[at]
            mine = local // width
            other = mine ^ 1
            low = np.minimum(other * width, size[at])
            high = np.minimum(low + width, size[at])
            from_, to = low.copy(), high.copy()
            while True:
                todo = np.flatnonzero(from_ < to)
                if not len(todo):
                    break
                mid = (from_[todo] + to[todo]) // 2
                theirs, own = order[start[at[todo]] + mid], order[at[todo]]
                smaller = self.less(theirs, own, way)
                from_[todo] = np.where(smaller, mid + 1, from_[todo])
                to[todo] = np.where(smaller, to[todo], mid)
            merged = np.minimum(mine, other) * width + (local - mine * width) + (from_ - low)
            result = order.copy()
            result[start[at] + merged] = order[at]
            order, width = result, width * 2
        return order

    def neighbours(self, order: np.ndarray, way: int) -> np.ndarray:
        """Common extension of each context with the one before it in ``order``; -1 at a group's first."""
        i, j = order[:-1], order[1:]
        shared = np.full(len(order), -1, np.int64)
        together = self.group[i] == self.group[j]
        shared[1:][together] = self.extension(i[together], j[together], way)
        return shared

    def verified(self, order: np.ndarray, shared: np.ndarray, way: int) -> bool:
        """Whether the bytes of all common extensions of neighbours are equal."""
        at = np.flatnonzero(shared > 0)
        columns = np.arange(self.length if way > 0 else self.centre)
        for k in range(0, len(at), CHUNK):
            part = at[k : k + CHUNK]
            if way > 0:
                x, y = self.bytes[order[part - 1], self.centre :], self.bytes[order[part], self.centre :]
            else:
                x, y = self.bytes[order[part - 1], : self.centre][:, ::-1], self.bytes[order[part], : self.centre][:, ::-1]
            if ((x != y) & (columns < shared[part, None])).any():
                return False
        return True

    def repeated(self) -> list[list[tuple[int, int]]] | None:
        """Per context the ranges (lo, hi) of ``a`` whose string another context of its group has too.

        None if the hashes collided.
        """
        orders, shared = {}, {}
        for way in (1, -1):
            orders[way] = self.sorted(way)
            shared[way] = self.neighbours(orders[way], way)
            if not self.verified(orders[way], shared[way], way):
                return None
        out: list[list[tuple[int, int]]] = [[] for _ in self.group]
        first = np.flatnonzero(np.diff(self.group, prepend=-1))
        sizes = np.diff(np.append(first, len(self.group)))
        twos = first[sizes == 2]
        low, high = self.length - shared[1][twos + 1], shared[-1][twos + 1]
        for k in np.flatnonzero(low <= high).tolist():
            for i in (twos[k], twos[k] + 1):
                out[i].append((int(max(low[k], 0)), int(high[k])))
        for s, m in zip(first[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            self._ranges(s, m, orders, shared, out)
        return out

    def _ranges(self, s: int, m: int, orders: dict, shared: dict, out: list) -> None:
        behind, before = shared[1][s + 1 : s + m], shared[-1][s + 1 : s + m]
        steps = np.unique(np.clip(np.concatenate([[0], self.length - behind, before + 1]), 0, self.centre + 1))
        steps = steps[steps <= self.centre]
        place = {way: orders[way][s : s + m] - s for way in (1, -1)}
        classes = {1: np.zeros(m, np.int64), -1: np.zeros(m, np.int64)}
        for k, a in enumerate(steps.tolist()):
            upto = steps[k + 1] - 1 if k + 1 < len(steps) else self.centre
            classes[1][place[1]] = np.append(0, np.cumsum(behind < self.length - a))
            classes[-1][place[-1]] = np.append(0, np.cumsum(before < a))
            _, which, counts = np.unique(classes[1] * m + classes[-1], return_inverse=True, return_counts=True)
            for i in np.flatnonzero(counts[which] > 1).tolist():
                ranges = out[s + i]
                if ranges and ranges[-1][1] + 1 == a:
                    ranges[-1] = (ranges[-1][0], int(upto))
                else:
                    ranges.append((a, int(upto)))


def compared(group: np.ndarray, before: np.ndarray, behind: np.ndarray, data: list[bytes], length: int, span: int) -> list:
    base = _BASE
    while True:
        found = Contexts(group, before, behind, data, length, span, base).repeated()
        if found is not None:
            return found
        base = (base * 5 + 2) | 1


RANGES = "key bigint, context bigint, ranges array<struct<lo: int, hi: int>>"
_RANGES = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


def _sorted_groups(contexts: DataFrame, length: int, span: int, by: str = "key") -> DataFrame:
    """Ranges of each (key, context, before, behind, data), whose groups ``by`` a column are small enough to be held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def settled(t: pa.Table) -> pa.RecordBatch:
            keys = t.column(by).to_numpy()
            group = np.cumsum(np.diff(keys, prepend=keys[:1]) != 0)
            numbers = [t.column(c).to_numpy().astype(np.int64) for c in ("before", "behind")]
            found = compared(group, *numbers, t.column("data").to_pylist(), length, span)
            made = pa.array([[{"lo": lo, "hi": hi} for lo, hi in x] for x in found], _RANGES)
            columns = [t.column("key").combine_chunks(), t.column("context").combine_chunks(), made]
            return pa.RecordBatch.from_arrays(columns, names=["key", "context", "ranges"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows < CHUNK:
                continue
            keys = held.column(by).to_numpy()
            ends = np.flatnonzero(np.diff(keys)) + 1
            start = 0
            while len(ends) and start < ends[-1]:
                stop = int(ends[max(np.searchsorted(ends, start + CHUNK, "right") - 1, np.searchsorted(ends, start, "right"))])
                yield settled(held.slice(start, stop - start))
                start = stop
            held = held.slice(start)
        if held is not None and held.num_rows:
            yield settled(held)

    return contexts.repartition(by).sortWithinPartitions(by).mapInArrow(run, RANGES)


def _halves(parts: DataFrame, length: int) -> DataFrame:
    """key, context, lo, hi, sub, cover of both halves of the ranges lo..hi of ``a`` of each of ``parts``.

    Contexts that share a string with ``a`` in a half agree on ``sub``, a hash of the bytes that all these
    strings have in common. Contexts with the same ``cover`` share all of them; it is null where some do not fit.
    """
    names = ["key", "context", "lo", "hi", "sub", "cover"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for key, context, lo, hi, before, behind, data in zip(*(c.to_pylist() for c in batch.columns)):
                for x, y in ((lo, (lo + hi) // 2), ((lo + hi) // 2 + 1, hi)):
                    if x > y or before < x or behind < length - y:
                        continue
                    sub = hashlib.blake2b(data[before - x : before + length - y], digest_size=8, key=b"%d %d %d" % (key, x, y)).digest()
                    whole = before >= y and behind >= length - x
                    cover = hashlib.blake2b(data[before - y : before + length - x], digest_size=16).digest() if whole else None
                    made.append((key, context, x, y, int.from_bytes(sub, "little", signed=True), cover))
            yield pa.RecordBatch.from_arrays([pa.array([m[k] for m in made], t) for k, t in enumerate(types)], names=names)

    taken = parts.select("key", "context", "lo", "hi", "before", "behind", "data")
    return taken.mapInArrow(run, "key bigint, context bigint, lo int, hi int, sub bigint, cover binary")


def _split_groups(data: DataFrame, length: int, span: int, group: int) -> DataFrame:
    """The same for groups of any size, which are split until they are small enough.

    The range of ``a`` is halved again and again, and each half has groups of its own, of contexts that agree
    on more bytes. A context that is alone leaves. Of contexts with the same cover one goes on for all.
    """
    data = settle(data, "crowded")
    parts = data.select("key", "context", F.lit(0).alias("lo"), F.lit(span - 1).alias("hi"))
    found = []
    while True:
        halves = settle(_halves(parts.join(data, ["key", "context"]), length), "halves")
        covers = halves.filter("cover is not null").groupBy("sub", "cover").agg(F.count("*").alias("n"), F.min("context").alias("one"))
        marked = settle(halves.join(covers.filter("n > 1").drop("n"), ["sub", "cover"], "left"), "marked")
        whole = F.array(F.struct("lo", "hi")).cast("array<struct<lo: int, hi: int>>")
        found.append(marked.filter("one is not null").select("key", "context", whole.alias("ranges")))
        left = marked.filter("one is null or one = context").select("key", "context", "lo", "hi", "sub")
        left = settle(left.join(left.groupBy("sub").agg(F.count("*").alias("n")).filter("n > 1"), "sub"), "split")
        few = left.filter(F.col("n") <= group).select("key", "context", "sub")
        found.append(_sorted_groups(few.join(data, ["key", "context"]), length, span, "sub"))
        parts = left.filter(F.col("n") > group).select("key", "context", "lo", "hi")
        if parts.isEmpty():
            break
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("key", "context").agg(F.flatten(F.collect_set("ranges")).alias("ranges"))


def _context_bytes(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, context, before, behind, data of the contexts ``wanted``, cut out of one text for each."""
    lists = wanted.groupBy("digest").agg(F.collect_list(F.struct("key", "context", "p", "before", "behind")).alias("at"))
    lists = settle(lists, "wanted")
    few = fits(lists, SENT_IDS)
    needed = lists.select("digest")
    picked = texts.join(F.broadcast(needed) if few else needed, "digest", "left_semi")
    one = picked.groupBy("digest").agg(F.first("text").alias("text"))
    joined = one.join(lists, "digest").select("text", "at")
    names = ["key", "context", "before", "behind", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 2_000_000):
            columns: list[list] = [[] for _ in names]
            for text, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                b = text.encode("utf-8", "surrogatepass")
                for x in at:
                    row = (x["key"], x["context"], x["before"], x["behind"], b[x["p"] - x["before"] : x["p"] + x["behind"]])
                    for column, v in zip(columns, row):
                        column.append(v)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return joined.mapInArrow(run, "key bigint, context bigint, before int, behind int, data binary")


def repeated_spans(texts: DataFrame, length: int = LENGTH, span: int = SPAN, group: int = GROUP) -> DataFrame:
    """digest, found (array of p, ranges) of the ``texts`` (digest, text) that repeat something.

    Ranges stay lists beside their anchors until each text is cut, so that no row is multiplied.
    """
    names = ["key", "context", "p", "before", "behind"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1_000_000):
            with np.errstate(over="ignore"):
                found = anchors([(t or "").encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()], length, span)
            digests = batch.column(0).take(pa.array(found["doc"]))
            numbers = [pa.array(found[c].astype(t)) for c, t in zip(names, (np.int64, np.int64, np.int32, np.int32, np.int32))]
            yield pa.RecordBatch.from_arrays([digests, *numbers], names=["digest", *names])

    found = texts.mapInArrow(run, "digest binary, key bigint, context bigint, p int, before int, behind int")
    twice = found.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    members = settle(found.join(twice, "key"), "anchors")
    contexts = members.groupBy("key", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("digest", "p")).alias("one"), F.max("before").alias("before"), F.max("behind").alias("behind")
    )
    contexts = settle(contexts.select("key", "context", "n", "one.digest", "one.p", "before", "behind"), "contexts")
    several = settle(contexts.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "mixed-keys")
    wanted = contexts.join(several, "key")
    data = settle(_context_bytes(texts, wanted.select("key", "context", "digest", "p", "before", "behind")), "context-bytes")
    crowded = several.filter(F.col("kinds") > group).select("key")
    few = _sorted_groups(data.join(crowded, "key", "left_anti"), length, span)
    ranges = few
    if not crowded.isEmpty():
        ranges = few.unionByName(_split_groups(data.join(crowded, "key", "left_semi"), length, span, group))
    whole = F.array(F.struct((length - F.col("behind")).alias("lo"), F.col("before").alias("hi")))
    copied = contexts.filter("n > 1").select("key", "context", whole.cast("array<struct<lo: int, hi: int>>").alias("ranges"))
    ranges = copied.unionByName(ranges.filter(F.size("ranges") > 0))
    hit = members.select("digest", "key", "context", "p").join(ranges, ["key", "context"])
    return hit.groupBy("digest").agg(F.collect_set(F.struct("p", "ranges")).alias("found"))


def joined_spans(found: list[dict] | None, length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of the bytes of the strings that start lo to hi bytes before each p."""
    spans = {(x["p"] - r["hi"], x["p"] - r["lo"] + length) for x in found or () for r in x["ranges"] if r["lo"] <= r["hi"]}
    out: list[tuple[int, int]] = []
    for x in sorted(spans):
        if out and x[0] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], x[1]))
        else:
            out.append(x)
    return out


def remove_repeats(
    docs: DataFrame, text_col: str = "text", length: int = LENGTH, span: int = SPAN, group: int = GROUP, whole: bool = False
) -> DataFrame:
    """``row``, n_bytes, spans (removed runs), kept (remaining bytes) for every row of ``docs``.

    With ``whole``, kept is text, without the characters that lost a byte. Null texts are empty. Texts shorter than ``length`` keep all their bytes. Rows that repeat remove
    each other's bytes, whatever their ids. An empty table stays empty.
    """
    boxed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    boxed = boxed.withColumn("digest", F.unhex(F.md5(F.col("text").cast("binary"))))
    spans = repeated_spans(boxed.select("digest", "text"), length, span, group)
    joined = boxed.join(spans, "digest", "left").select("row", "text", "found")
    runs = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 4_000_000):
            sizes, cut, kept = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                b, at, parts = text.encode("utf-8", "surrogatepass"), 0, []
                removed = joined_spans(found, length)
                for x, y in removed:
                    parts.append(b[at:x])
                    at = y
                sizes.append(len(b))
                cut.append([{"from": x, "to": y} for x, y in removed])
                left = b"".join([*parts, b[at:]])
                kept.append(left.decode("utf-8", "ignore") if whole else left)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(cut, runs), pa.array(kept, pa.string() if whole else pa.binary())],
                names=["row", "n_bytes", "spans", "kept"],
            )

    fields = T.StructType.fromDDL("n_bytes bigint, spans array<struct<`from`: int, `to`: int>>, kept " + ("string" if whole else "binary"))
    return joined.mapInArrow(run, T.StructType([boxed.schema["row"], *fields.fields]))


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the remaining text of every row.

    In the text a character that has lost some of its bytes shows as U+FFFD; the digest is of the bytes.
    """
    done = remove_repeats(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")))
    return done.select(
        "row.doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def without_repeats(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with their remaining text, and its length in ``chars_col``.

    A character that loses a byte is dropped whole. A document of which nothing remains keeps its row
    with an empty text; a null text without repeats stays null.
    """
    done = remove_repeats(docs, text_col, whole=True)
    text = F.when(F.size("spans") == 0, F.col("row")[text_col]).otherwise(F.col("kept"))
    slim = done.select("row", text.alias("remaining"))
    columns = [
        F.col("remaining").alias(c) if c == text_col
        else F.when(F.col("remaining").isNull(), F.col("row")[c]).otherwise(F.length("remaining")).cast(docs.schema[c].dataType).alias(c) if c == chars_col
        else F.col("row")[c].alias(c)
        for c in docs.columns
    ]
    return slim.select(*columns)
