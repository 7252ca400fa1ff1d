"""Operator 2: near-duplicates by a chosen-path set similarity join.

A document is the set of its five-word shingles; equal sets are one class. A class is known by a sketch
of minwise tokens: coordinate i is the least hash of its shingles under hash i, so two classes share a
coordinate with the probability of their Jaccard similarity.

The join grows independent trees. A node is a set of classes. It chooses coordinates by its own random
bits, one and a third on average (the inverse of the threshold), and for each of them branches its
classes by their token there. Similar classes thus meet in some leaf of a tree with a probability that
falls only slowly with the depth, and unrelated ones part. A node with few classes is not branched
further but compared exhaustively, by sketch first; what may be similar is verified on the full shingle
sets. Trees are repeated to the target recall: 16 trees miss a pair at the threshold with probability
2e-12 in a node that is small at once, 3e-4 if it had to be branched seven times, 5e-3 after twelve
branchings and 5e-2 after ``MAX_DEPTH``.

A dense node, such as thousands of near copies of one text, must not be compared all with all. Before
branching, every node of the first level verifies the links of its members with one pivot; classes that
these links have joined need no further comparison with each other, only with classes of other
components, and a node within one component is done. No link between components is lost by that.

So a node needs no branching either when few of its classes lie outside its largest component, however
large it is: these few are compared with all its members, which are dealt out in blocks. Pairs that
agree by sketch are verified one by one where a block has few of them. In a crowded block, of texts that
are all a little less similar than the threshold, the full shingle sets of all members are compared at
once where they meet, and only links that join components leave the task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.components import components
from ordertide.llm.rows import map_texts, mixed, ranges, sliced, unpacked
from ordertide.session import fits, settle

SHINGLE = 5
PERCENT = 75
TREES = 16
COORDINATES = 64
#: Fewest equal coordinates of a pair that is verified. A pair at the threshold has fewer with
#: probability 1e-8.
MIN_EQUAL = 28
#: Classes of a node that is compared exhaustively.
SMALL_NODE = 200
#: A node is not branched if at most ``APART`` times as many classes lie outside its largest component; of
#: that component ``BLOCK`` times as many meet them at once.
APART, BLOCK = 2, 4
#: Candidate pairs a class beyond which a block is crowded, and shingles that are compared at once there.
CROWDED, COLUMNS = 2, 4096
#: Members of blocks that are compared together with others, and pairs that are looked at together.
TOGETHER, AT_ONCE = 64, 50_000
#: Branchings of a path, after which a node still large is compared block by block.
MAX_DEPTH = 24
#: Ids that may be sent to all tasks to pick out the texts that pairs need; beyond that they are joined.
SENT_IDS = 500_000

_rng = np.random.default_rng(20240601)
#: Multipliers of the minwise hashes and values of bytes, drawn from a fixed seed.
_MINWISE = _rng.integers(0, 2**63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES = _rng.integers(0, 2**63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of ``data`` (UTF-8, A-Z lower-cased here), and where it starts."""
    b = np.frombuffer(data.lower() + b" ", np.uint8)
    space = _SPACE[b]
    edge = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[b] * _powers(_BASE, len(b)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _powers(_INVERSE, len(b))[starts]), starts


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's shingles as sorted distinct 64-bit hashes; a shorter text is one shingle, if it has words."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    hashes, starts = word_hashes(b" ".join(parts))
    bounds = np.cumsum([len(p) + 1 for p in parts])
    cuts = np.concatenate([[0], np.searchsorted(starts, bounds)])
    n = max(0, len(hashes) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled = rolled * np.uint64(_BASE) + hashes[k : k + n]
    rolled = mixed(rolled)
    out = []
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if j - i >= size:
            out.append(np.unique(rolled[i : j - size + 1]))
        elif j > i:
            h = np.uint64(j - i)
            for w in hashes[i:j]:
                h = h * np.uint64(_BASE) + w
            out.append(mixed(np.array([h], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The least of each minwise hash, upper 32 bits."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 1024):
        np.minimum(least, (shingles[i : i + 1024, None] * _MINWISE).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def _signatures(texts: list) -> dict:
    with np.errstate(over="ignore"):
        sets = shingle_sets(texts)
        return {
            "n_shingles": [len(s) for s in sets],
            "class": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
            "sketch": [sketch(s).tobytes() if len(s) else None for s in sets],
        }


def children(nodes: np.ndarray, sketches: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(row, child node) for every branch that each row's node sends it along."""
    with np.errstate(over="ignore"):
        bits = mixed(nodes.astype(np.uint64) + np.uint64(_BASE))
        rows, out = [], []
        chosen = 100 / percent
        for k in range(int(np.ceil(chosen))):
            taken = (bits >> np.uint64(40)).astype(np.float64) / 2**24 < chosen - k
            at = np.flatnonzero(taken)
            which = (mixed(bits[at] + np.uint64(k + 1)) % np.uint64(sketches.shape[1])).astype(np.int64)
            token = sketches[at, which].astype(np.uint64)
            out.append(mixed(bits[at] ^ mixed(token * np.uint64(64) + which.astype(np.uint64) + np.uint64(1))))
            rows.append(at)
    return np.concatenate(rows), np.concatenate(out)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(len(column), COORDINATES)


def _branched(entries: DataFrame, trees: int = 0) -> DataFrame:
    """node, uid of the children of each (node, uid, sketch); of all roots if ``trees`` is given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            uids, sketches = batch.column("uid").to_numpy(False), _matrix(batch.column("sketch"))
            for tree in range(max(1, trees)):
                nodes = np.full(len(uids), tree, np.uint64) if trees else batch.column("node").to_numpy(False).view(np.uint64)
                rows, child = children(nodes, sketches)
                yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(uids[rows])], names=["node", "uid"])

    return entries.mapInArrow(run, "node bigint, uid bigint")


def _shared(entries: DataFrame) -> DataFrame:
    """The entries of nodes with two classes or more: node, uid, size, pivot.

    A node's pivot is a member drawn by the node's own hash, so that a dense group, which meets in many
    nodes, is linked through many different members.
    """
    drawn = F.min_by("uid", F.xxhash64("node", "uid")).alias("pivot")
    sizes = entries.groupBy("node").agg(F.count("*").alias("size"), drawn).filter("size > 1")
    sizes = settle(sizes, "nodes")
    return entries.join(F.broadcast(sizes) if fits(sizes, SENT_IDS) else sizes, "node")


def _likely(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sketches agree often enough."""
    left, right = sketches.toDF("a", "sketch_a"), sketches.toDF("b", "sketch_b")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "sketch_a", "sketch_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                equal = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(axis=1)
                yield batch.select([0, 1]).filter(pa.array(equal >= MIN_EQUAL))

    return both.mapInArrow(run, "a bigint, b bigint")


def _texts(stored: DataFrame, *ids: DataFrame) -> DataFrame:
    """uid, text of the uids in ``ids``."""
    need = ids[0]
    for more in ids[1:]:
        need = need.union(more)
    need = settle(need.distinct().toDF("uid"), "needed")
    texts = stored.select("uid", "text")
    return settle(texts.join(F.broadcast(need) if fits(need, SENT_IDS) else need, "uid"), "texts")


def _verified(pairs: DataFrame, stored: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` whose full shingle sets are similar enough."""
    pairs = settle(pairs, "candidates")
    return _similar(pairs, _texts(stored, pairs.select("a"), pairs.select("b")), percent)


def alike_sets(x: list[np.ndarray], y: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Whether the sets of each pair of ``x`` and ``y`` are similar enough."""
    n_x, n_y = np.array([len(v) for v in x], np.int64), np.array([len(v) for v in y], np.int64)
    owner = np.concatenate([np.repeat(np.arange(len(x)), n_x), np.repeat(np.arange(len(y)), n_y)])
    values = np.concatenate([*x, *y]) if x else np.empty(0, np.uint64)
    by = np.lexsort((values, owner))
    values, owner = values[by], owner[by]
    both = owner[1:][(values[1:] == values[:-1]) & (owner[1:] == owner[:-1])]
    common = np.bincount(both, minlength=len(x))
    return 100 * common >= percent * (n_x + n_y - common)


def _similar(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text_a", 500_000):
            with np.errstate(over="ignore"):
                x, y = shingle_sets(batch.column(2).to_pylist()), shingle_sets(batch.column(3).to_pylist())
            yield batch.select([0, 1]).filter(pa.array(alike_sets(x, y, percent), pa.bool_()))

    return settle(both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint"), "similar")


def _dealt(nodes: DataFrame) -> DataFrame:
    """block, uid, root, outside of nodes to be compared: few members are outside the largest component, and in every block."""
    blocks = F.ceil(F.col("size") / (BLOCK * SMALL_NODE))
    outside = F.col("root") != F.col("main")
    at = F.when(outside, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(F.pmod(F.xxhash64("uid"), blocks)))
    wide = nodes.select("node", "uid", "root", outside.alias("outside"), F.explode(at).alias("k"))
    return wide.select(F.xxhash64("node", "k").alias("block"), "uid", "root", "outside")


def _compared(blocks: DataFrame, sketches: DataFrame) -> DataFrame:
    """block, a, b of different roots within each block that agree often enough by sketch, one end of each outside.

    A crowded block has one row without pair instead.
    """
    held = blocks.join(sketches, "uid").groupBy("block").agg(F.collect_list(F.struct("uid", "root", "outside", "sketch")).alias("m"))
    names = ["block", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            blocks, m = batch.column(0).to_numpy(False), batch.column(1).flatten()
            sizes = batch.column(1).value_lengths().to_numpy(False).astype(np.int64)
            first = np.cumsum(sizes) - sizes
            uids, roots, outside = m.field("uid").to_numpy(False), m.field("root").to_numpy(False), m.field("outside").to_numpy(False)
            s = _matrix(m.field("sketch"))
            few = sizes <= TOGETHER
            for part in _portions(np.where(few, sizes * sizes, 0)):
                at = part[few[part]]
                i, j, k = alike(s, uids, roots, outside, first[at], sizes[at])
                crowded = np.bincount(k, minlength=len(at)) > CROWDED * sizes[at]
                taken = ~crowded[k]
                a, b = uids[i[taken]], uids[j[taken]]
                made = [(blocks[at[crowded]], None, None), (blocks[at[k[taken]]], np.minimum(a, b), np.maximum(a, b))]
                for n in part[~few[part]].tolist():
                    own = slice(first[n], first[n] + sizes[n])
                    a, b = _alike_in(s[own], uids[own], roots[own], outside[own])
                    if len(a) > CROWDED * sizes[n]:
                        made.append((blocks[n : n + 1], None, None))
                    else:
                        made.append((np.full(len(a), blocks[n]), np.minimum(a, b), np.maximum(a, b)))
                for block, a, b in made:
                    if len(block):
                        pair = [pa.nulls(len(block), pa.int64()) if x is None else pa.array(x) for x in (a, b)]
                        yield pa.RecordBatch.from_arrays([pa.array(block), *pair], names=names)

    return held.mapInArrow(run, "block bigint, a bigint, b bigint")


def _portions(pairs: np.ndarray) -> list[np.ndarray]:
    """Numbers of blocks, one after another, dealt so that about ``AT_ONCE`` pairs are looked at together."""
    part = (np.cumsum(pairs) - pairs) // AT_ONCE
    return np.split(np.arange(len(pairs)), np.flatnonzero(np.diff(part)) + 1)


def alike(s: np.ndarray, uids: np.ndarray, roots: np.ndarray, outside: np.ndarray, first: np.ndarray, sizes: np.ndarray):
    """Numbers of both members and of the block of each pair of different roots, one outside, that agrees often enough.

    The blocks stand at ``first`` and have ``sizes`` members. All of their pairs are compared at once.
    """
    member = np.repeat(first, sizes) + ranges(sizes)
    block = np.repeat(np.arange(len(sizes)), sizes)
    rows, of = member[outside[member]], block[outside[member]]
    i, k = np.repeat(rows, sizes[of]), np.repeat(of, sizes[of])
    j = np.repeat(first[of], sizes[of]) + ranges(sizes[of])
    taken = (roots[i] != roots[j]) & (~outside[j] | (uids[i] < uids[j]))
    i, j, k = i[taken], j[taken], k[taken]
    taken = (s[i] == s[j]).sum(axis=1) >= MIN_EQUAL
    return i[taken], j[taken], k[taken]


def _alike_in(s: np.ndarray, uids: np.ndarray, roots: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same pairs, by their uids, of one large block."""
    rows = np.flatnonzero(outside)
    equal = np.zeros((len(rows), len(uids)), np.int16)
    for c in s.T:
        equal += c[rows, None] == c[None, :]
    i, j = np.nonzero((equal >= MIN_EQUAL) & _apart(rows, uids, roots, outside))
    return uids[rows[i]], uids[j]


def _apart(rows: np.ndarray, uids: np.ndarray, roots: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """Which pairs of one of ``rows`` and any member are of different roots; two outside count once."""
    return (roots[rows, None] != roots[None, :]) & (~outside[None, :] | (uids[rows, None] < uids[None, :]))


def joining_links(uids: np.ndarray, roots: np.ndarray, outside: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join the roots of a block as all of its similar pairs with an end outside do."""
    rows, sizes = np.flatnonzero(outside), np.array([len(x) for x in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, which, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(counts > 1) - 1
    taken = counts[which] > 1
    owner, column = owner[taken], shared[which[taken]]
    by = np.argsort(column, kind="stable")
    owner, column = owner[by], column[by]
    common = np.zeros((len(rows), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, [start, start + COLUMNS]))
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[owner[part], column[part] - start] = 1
        common += held[rows] @ held.T
    common = common.astype(np.int64)
    similar = 100 * common >= percent * (sizes[rows, None] + sizes[None, :] - common)
    i, j = np.nonzero(similar & _apart(rows, uids, roots, outside))
    if not len(i):
        return []
    ends = np.stack([roots[rows[i]], roots[j]])
    _, one = np.unique(np.sort(ends, axis=0), axis=1, return_index=True)
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while x in up:
            x = up[x]
        return x

    out = []
    for x, y, a, b in zip(*ends[:, one].tolist(), uids[rows[i[one]]].tolist(), uids[j[one]].tolist()):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((min(a, b), max(a, b)))
    return out


def _linked(blocks: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """a, b that join the components of each of ``blocks``, by the full shingle sets of all members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, sets = None, [], []

        def settled() -> pa.RecordBatch:
            uids, roots, outside = (np.array(c) for c in zip(*held))
            found = joining_links(uids, roots, outside, sets, percent)
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in sliced(batches, "text", 1_000_000):
            with np.errstate(over="ignore"):
                made = shingle_sets(batch.column("text").to_pylist())
            for block, *member, one in zip(*(batch.column(c).to_pylist() for c in ("block", "uid", "root", "outside")), made):
                if block != now and held:
                    yield settled()
                    held, sets = [], []
                now = block
                held.append(member)
                sets.append(one)
        if held:
            yield settled()

    rows = blocks.join(texts, "uid").select("block", "uid", "root", "outside", "text")
    return settle(rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, "a bigint, b bigint"), "joining")


def _mixed_nodes(entries: DataFrame, roots: DataFrame) -> DataFrame:
    """node, uid, root, size, main (the largest component), outside (members of others) of nodes with several components."""
    rooted = entries.join(_sent(roots), "uid", "left").select("node", "uid", F.coalesce("root", "uid").alias("root"))
    rooted = settle(rooted, "rooted")
    parts = rooted.groupBy("node", "root").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("node").agg(F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("most"))
    sizes = sizes.select("node", "size", F.col("most.root").alias("main"), (F.col("size") - F.col("most.n")).alias("outside"))
    return rooted.join(_sent(settle(sizes.filter("outside > 0"), "open-nodes")), "node")


def _sent(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits(df, SENT_IDS) else df


def _in_blocks(large: DataFrame) -> DataFrame:
    """block, uid, root, outside: every two blocks of a large node as a block of their own, about a small node in size."""
    blocks = F.ceil(F.col("size") * 2 / SMALL_NODE)
    own = F.pmod(F.xxhash64("uid"), blocks)
    wide = large.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    key = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    return wide.select(key.alias("block"), "uid", "root", F.lit(True).alias("outside")).distinct()


def _rare_shingles(texts: DataFrame, percent: int) -> DataFrame:
    """node, uid: the shingles by which two of ``texts`` (uid, text) meet if they are similar enough.

    Of its n shingles a text may lack n - ceil(n * percent / 100) in a similar one. So two similar texts share one
    of so many and one more that are rarest among all ``texts``, ties by their hash. Those that stand in one text
    only come first and meet nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", 1_000_000):
            with np.errstate(over="ignore"):
                sets = shingle_sets(batch.column(1).to_pylist())
            ends = pa.array(np.cumsum([0, *[len(x) for x in sets]]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["uid", "shingles"])

    sets = settle(texts.select("uid", "text").mapInArrow(run, "uid bigint, shingles array<bigint>"), "sets")
    wide = sets.select("uid", F.size("shingles").alias("size"), F.explode("shingles").alias("node"))
    several = settle(wide.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1"), "several")
    known = wide.join(_sent(several), "node").groupBy("uid", "size").agg(F.sort_array(F.collect_list(F.struct("n", "node"))).alias("known"))
    taken = F.size("known") - F.ceil(F.col("size") * percent / 100).cast("int") + 1
    some = known.withColumn("taken", taken).filter("taken > 0")
    return some.select(F.explode(F.slice("known", F.lit(1), F.col("taken"))).alias("x"), "uid").select("x.node", "uid")


def links_between(stored: DataFrame, sketches: DataFrame, percent: int = PERCENT, trees: int = TREES) -> DataFrame:
    """(a, b) links that join the same components as all links between the classes do."""
    return links_in(_branched(sketches, trees), stored, sketches, percent, MAX_DEPTH)


def links_in(entries: DataFrame, stored: DataFrame, sketches: DataFrame, percent: int, depths: int) -> DataFrame:
    """The links within the nodes of ``entries`` (node, uid), which are branched ``depths`` - 1 times at most.

    Members of nodes still large then meet by their rarest shingles, which lets no similar pair pass.
    """
    entries = settle(_shared(entries), "level-1")
    stars = entries.filter("uid <> pivot").select(F.least("pivot", "uid").alias("a"), F.greatest("pivot", "uid").alias("b")).distinct()
    links = _verified(_likely(stars, sketches), stored, percent)
    roots = components(links)
    entries, blocks = entries.select("node", "uid"), None
    for depth in range(1, depths + 2):
        nodes = settle(_mixed_nodes(entries, roots), "mixed")
        large = (F.col("size") > SMALL_NODE) & (F.col("outside") > APART * SMALL_NODE)
        dealt = _dealt(nodes.filter(~large))
        if depth > depths:
            dealt = dealt.unionByName(_in_blocks(nodes.filter(large)))
        blocks = dealt if blocks is None else blocks.unionByName(dealt)
        if depth > depths or nodes.filter(large).isEmpty():
            break
        if depth < depths:
            entries = _branched(nodes.filter(large).select("node", "uid").join(sketches, "uid"))
            continue
        entries = settle(_shared(_rare_shingles(_texts(stored, nodes.filter(large).select("uid")), percent)), "level-rare")
        stars = entries.filter("uid <> pivot").join(_sent(roots), "uid", "left").withColumn("own", F.coalesce("root", "uid")).drop("root")
        stars = stars.join(_sent(roots.toDF("pivot", "root")), "pivot", "left").filter(F.coalesce("root", "pivot") != F.col("own"))
        stars = stars.select(F.least("pivot", "uid").alias("a"), F.greatest("pivot", "uid").alias("b")).distinct()
        links = links.unionByName(_verified(_likely(stars, sketches), stored, percent))
        roots, entries = components(links), entries.select("node", "uid")
    blocks = settle(blocks, "blocks")
    found = settle(_compared(blocks, sketches), "compared")
    crowded = settle(found.filter("a is null").select("block"), "crowded")
    crowd = settle(blocks.join(_sent(crowded), "block"), "crowd")
    pairs = settle(found.filter("a is not null").select("a", "b").distinct(), "candidates")
    texts = _texts(stored, pairs.select("a"), pairs.select("b"), crowd.select("uid"))
    return links.unionByName(_similar(pairs, texts, percent)).unionByName(_linked(crowd, texts, percent))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, trees: int = TREES
) -> DataFrame:
    """``row``, n_shingles, component_id, kept and first for every row of ``docs``.

    Null, empty and wordless texts have no shingles and are linked with nothing: their component is
    their own id. ``kept`` says that the row's id is its component's least; rows that repeat an id
    repeat it. ``first`` is true of exactly one row of each component, one with the least id. Rows
    without id take part; a component of such rows only has a null id. An empty table stays empty.
    """
    signed = map_texts(docs, text_col, _signatures, "n_shingles bigint, class binary, sketch binary", 1_000_000)
    columns = [signed["row"], F.col(f"row.{_quoted(text_col)}").cast("string").alias("text"), F.col(f"row.{_quoted(id_col)}").alias("id")]
    stored = settle(signed.select(*columns, "n_shingles", "class", "sketch").withColumn("uid", F.monotonically_increasing_id()), "signed")
    sound = stored.filter("n_shingles > 0")
    classes = settle(sound.groupBy("class").agg(F.min("uid").alias("rep")), "classes")
    sketches = settle(stored.join(classes, stored["uid"] == classes["rep"]).select("uid", "sketch"), "sketches")
    roots = settle(components(links_between(stored, sketches, percent, trees)), "components")
    named = classes.join(roots, classes["rep"] == roots["uid"], "left").select("class", F.coalesce("root", "rep").alias("root"))
    rows = sound.select("id", "uid", "class").join(named, "class").select("id", "uid", "root")
    least = F.min(F.struct(F.col("id").isNull(), "id", "uid"))
    groups = rows.groupBy("root").agg(least.alias("least"))
    groups = groups.select("root", F.col("least.id").alias("component_id"), F.col("least.uid").alias("first_uid"))
    placed = named.join(groups, "root").select("class", "component_id", "first_uid")
    joined = stored.join(placed, "class", "left")
    alone = F.col("n_shingles") == 0
    return joined.select(
        "row",
        "n_shingles",
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, True).otherwise(F.col("id").eqNullSafe(F.col("component_id"))).alias("kept"),
        F.when(alone, True).otherwise(F.col("uid") == F.col("first_uid")).alias("first"),
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def near_duplicate_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    taken = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return near_duplicates(taken).select("row.doc_id", "n_shingles", "component_id", "kept")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, columns unchanged."""
    return unpacked(near_duplicates(docs, id_col, text_col).filter("first"))
