"""Operator 12: alignment of two tokenizers over the same text, by diagonal run skipping.

Both tokenizers cut the same bytes, so a text is two rising arrays of byte offsets at which tokens end.
``aligned`` walks both at an index shift. While the arrays agree at the current shift the tokens are one
to one, and the walk leaps: it compares stretches of doubled length, and on the first that differs it
halves its way to the last equal offset. Behind that stands an irregular group, which is settled token
by token up to the next offset that both share; the shift changes by what the group holds more on one
side. Each step of that walk is one overlap of two tokens, so groups and links come out together.

Tokenizers are slow and words repeat, so a text is cut where neither tokenizer can join or look across,
before a single space or line feed between other characters (``TokenPair.apart`` proves that on the
files, else texts stay whole). Such a cut is an offset at which both end. Segments not met before by a
worker are joined to one text, encoded and aligned together, and remembered up to ``MEMORY`` characters.

What is asked of the corpus is in how many documents an id pair is linked. Each task adds that up over
its texts, batch by batch, before the pairs are shuffled. Every document keeps its own pairs with their
number in a scratch table; the counts come back to it by a join, whose small side is sent whole if it
has at most ``SENT_PAIRS`` rows, counted first, and is shuffled beyond that. The number of pairs is
bounded by both vocabularies, but that bound alone is too large to send.

Edge cases. Texts that are null, empty, or that either tokenizer does not give back byte by byte (such as
one with U+2581) have no tokens: zeros and an empty digest; they hold no pair. Repeated rows and ids give
a row each and count as documents. An empty table gives no row. Other columns are not looked at. A text
without a cut, however long, is one segment.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.llm.rows import ranges, sliced
from ordertide.session import fits, settle

#: Characters of remembered segments of a worker, after which it starts afresh, and of texts handled together.
MEMORY, PART = 3_000_000, 1_000_000
#: Characters of new segments that are encoded and aligned as one text.
CHUNK = 50_000
#: Rows of pair counts that may be sent to every task.
SENT_PAIRS = 2_000_000
#: Text that is not cut inside: up to the next single space or line feed between other characters.
_SEGMENT = re.compile(r"[ \n]\s*\S*(?:(?![ \n]\S)\s+\S*)*")
#: What a byte-level tokenizer shows for the bytes that it does not show as themselves, in order from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
_SPACE = "▁"

_pairs: dict[tuple[str, str], TokenPair] = {}


def aligned(a: list[int], b: list[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Groups and links of the tokens that end at the rising offsets ``a`` and ``b``, the last being equal.

    Two lists say how many tokens of each side there are up to each group's end; two say which tokens are
    linked.
    """
    group_a: list[int] = []
    group_b: list[int] = []
    link_a: list[int] = []
    link_b: list[int] = []
    i = j = 0
    while i < len(a):
        start, shift, step = i, j - i, 1
        while a[i : i + step] == b[i + shift : i + shift + step] and i < len(a):
            i = min(i + step, len(a))
            step *= 2
        while step > 1:
            step //= 2
            if i + step <= len(a) and a[i : i + step] == b[i + shift : i + shift + step]:
                i += step
        j = i + shift
        if i > start:
            group_a += range(start + 1, i + 1)
            group_b += range(start + shift + 1, j + 1)
            link_a += range(start, i)
            link_b += range(start + shift, j)
        if i == len(a):
            break
        while a[i] != b[j]:
            link_a.append(i)
            link_b.append(j)
            if a[i] < b[j]:
                i += 1
            else:
                j += 1
        link_a.append(i)
        link_b.append(j)
        i, j = i + 1, j + 1
        group_a.append(i)
        group_b.append(j)
    return group_a, group_b, link_a, link_b


def default_tokenizers() -> tuple[str, str]:
    """The public byte-level and piece vocabularies; every operator takes the paths as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def token_pair(paths: tuple[str, str]) -> TokenPair:
    """The tokenizers of this worker for a byte-level file and a piece file."""
    if paths not in _pairs:
        _pairs[paths] = TokenPair(*paths)
    return _pairs[paths]


class TokenPair:
    """A byte-level tokenizer A, a piece tokenizer B, and the segments that they have aligned so far."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        shown = {chr(b): b for b in range(256) if b not in _HIDDEN} | {chr(256 + k): b for k, b in enumerate(_HIDDEN)}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(shown[c] for c in t) if all(c in shown for c in t) else t.encode() for t in names]
        self.pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        byte = re.compile("<0x([0-9A-F]{2})>")
        self.bytes_b = [
            bytes([int(m[1], 16)]) if (m := byte.fullmatch(p)) else p.replace(_SPACE, " ").encode() for p in self.pieces
        ]
        self.length_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.length_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.apart = self._apart(path_a)
        self.forget()

    def _apart(self, path_a: str) -> bool:
        """Whether both tokenizers give a text's segments the ids that they have alone."""
        with open(path_a, encoding="utf-8") as f:
            file = json.load(f)
        pre = file.get("pre_tokenizer") or {}
        if file.get("normalizer") or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space"):
            return False
        if not all(t["special"] for t in file.get("added_tokens", [])):
            return False
        if any(_SPACE in p.lstrip(_SPACE) or "\n" in p for p in self.pieces):
            return False
        probe = [" Apart", "\nword.", " x1,", " 's", " don't", "\né!!", " %%", " 7\t8", " Á"]
        whole = self._encode_b("".join(probe))
        return whole == [i for s in probe for i in self._encode_b(s)] and self._same_b(whole, "".join(probe))

    def _encode_b(self, text: str) -> list[int]:
        """Ids of a text that starts with white space, of which B itself adds a first space."""
        return self.b.encode(text[1:]) if text[0] == " " else self.b.encode(text)[1:]

    def _same_b(self, ids: list[int], text: str) -> bool:
        return b"".join(map(self.bytes_b.__getitem__, ids)) == text.encode()

    def forget(self) -> None:
        """Start afresh: no segment is known."""
        self.known: dict[str, int] = {}
        self.size = 0
        self.named: list[bytes] = []
        self.figures = np.zeros((0, 3), np.int64)
        self.first, self.pairs = np.zeros(1, np.int64), np.zeros(0, np.int64)

    def segments(self, text: str) -> list[str]:
        return _SEGMENT.findall(text) if self.apart else [text]

    def learn(self, segments: list[str]) -> None:
        """Encode and align segments not known yet, many at a time."""
        made: list[tuple[bytes, tuple[int, int, int], np.ndarray]] = []
        start = 0
        while start < len(segments):
            stop, size = start, 0
            while stop < len(segments) and (stop == start or size < CHUNK and self._joins(segments[stop - 1], segments[stop])):
                size += len(segments[stop])
                stop += 1
            made += self._chunk(segments[start:stop])
            start = stop
        n = len(self.known)
        self.known.update(zip(segments, range(n, n + len(segments)), strict=True))
        self.size += sum(map(len, segments))
        self.named += [m[0] for m in made]
        self.figures = np.concatenate([self.figures, np.array([m[1] for m in made], np.int64).reshape(-1, 3)])
        ends = self.first[-1] + np.cumsum([len(m[2]) for m in made])
        self.first = np.concatenate([self.first, ends.astype(np.int64)])
        self.pairs = np.concatenate([self.pairs, *[m[2] for m in made]])

    def _joins(self, before: str, segment: str) -> bool:
        """Whether the two may stand beside each other: not behind or before more white space."""
        return self.apart and not before[-1].isspace() and len(segment) > 1 and not segment[1].isspace()

    def _chunk(self, segments: list[str]) -> list[tuple[bytes, tuple[int, int, int], np.ndarray]]:
        """Groups as text, (tokens of A, tokens of B, groups) and linked pairs of each segment; -1: not the same bytes."""
        text = "".join(segments)
        data = text.encode()
        ids_a = self.a.encode(text, add_special_tokens=False).ids
        ids_b = self._encode_b(text)
        if not (self._same_b(ids_b, text) and b"".join(map(self.bytes_a.__getitem__, ids_a)) == data):
            if len(segments) > 1:
                return [x for s in segments for x in self._chunk([s])]
            return [(b"", (-1, 0, 0), np.zeros(0, np.int64))]
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        group_a, group_b, link_a, link_b = aligned(ends_a.tolist(), ends_b.tolist())
        pairs = a[link_a] * len(self.pieces) + b[link_b]
        names, x, y = [], 0, 0
        for p, q in zip(group_a, group_b):
            if p - x == 1 and q - y == 1:
                names.append(f"{ids_a[x]}|{ids_b[y]}")
            else:
                names.append(f"{','.join(map(str, ids_a[x:p]))}|{','.join(map(str, ids_b[y:q]))}")
            x, y = p, q
        lengths = [len(data)] if len(segments) == 1 else [len(s.encode()) for s in segments]
        cuts = np.cumsum(lengths)
        # A cut is an end of both, so of a group, and links are in the order of A's tokens.
        upto_a, upto_b = np.searchsorted(ends_a, cuts) + 1, np.searchsorted(ends_b, cuts) + 1
        upto_group = np.searchsorted(np.array(group_a), upto_a) + 1
        upto_link = np.searchsorted(np.array(link_a), upto_a)
        out, last = [], (0, 0, 0, 0)
        for now in zip(upto_a.tolist(), upto_b.tolist(), upto_group.tolist(), upto_link.tolist()):
            n_a, n_b, n_groups, _ = (p - q for p, q in zip(now, last))
            out.append((";".join(names[last[2] : now[2]]).encode(), (n_a, n_b, n_groups), pairs[last[3] : now[3]]))
            last = now
        return out

    def documents(self, texts: list[str | None]) -> dict:
        """Figures and digest of each text, and its pairs one after another with how often each is linked."""
        split = [self.segments(" " + t) if t else [] for t in texts]
        if self.size > MEMORY:
            self.forget()
        missing: dict[str, None] = {}
        for s in split:
            missing.update(dict.fromkeys(filterfalse(self.known.__contains__, s)))
        if missing:
            self.learn(list(missing))
        look = self.known.__getitem__
        index = [list(map(look, s)) for s in split]
        doc = np.repeat(np.arange(len(texts)), [len(x) for x in index])
        at = np.fromiter((k for x in index for k in x), np.int64, len(doc))
        bad = np.unique(doc[self.figures[at, 0] < 0])
        if len(bad):
            at, doc = at[~np.isin(doc, bad)], doc[~np.isin(doc, bad)]
        figures = np.zeros((len(texts), 3), np.int64)
        np.add.at(figures, doc, self.figures[at])
        digests, broken = [], set(bad.tolist())
        name = self.named.__getitem__
        for k, x in enumerate(index):
            digests.append(hashlib.sha256(b";".join(map(name, x))).hexdigest() if x and k not in broken else "")
        # Each segment of a document once, with its number, then each pair of it once.
        seen, times = np.unique(doc << 32 | at, return_counts=True)
        doc, at = seen >> 32, seen & 0xFFFFFFFF
        n = self.first[at + 1] - self.first[at]
        pairs = self.pairs[np.repeat(self.first[at], n) + ranges(n)]
        doc, times = np.repeat(doc, n), np.repeat(times, n)
        order = np.lexsort((pairs, doc))
        doc, pairs, times = doc[order], pairs[order], times[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pairs[1:] != pairs[:-1])
        starts = np.flatnonzero(new)
        return {
            "figures": figures, "digests": digests, "doc": doc[starts], "pairs": pairs[starts],
            "times": np.add.reduceat(times, starts) if len(starts) else times,
        }


_MADE = "uid bigint, id {id}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>, times array<int>, counted boolean"


def aligned_texts(df: DataFrame, id_col: str, text_col: str, paths: tuple[str, str]) -> DataFrame:
    """A row for each document with its pairs and their ``times``, and ``counted`` rows, in which ``times`` is
    the number of documents of a part that hold a pair."""
    kind = df.schema[id_col].dataType.simpleString()
    uid = F.monotonically_increasing_id()
    boxed = df.select(uid.alias("uid"), df[id_col].alias("id"), df[text_col].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, held, waiting = token_pair(paths), [], 0
        for batch in sliced(batches, "text", PART):
            made = both.documents(batch.column(2).to_pylist())
            figures, n = made["figures"], batch.num_rows
            upto = np.searchsorted(made["doc"], np.arange(n + 1)).astype(np.int32)
            pairs = pa.ListArray.from_arrays(pa.array(upto), pa.array(made["pairs"]))
            times = pa.ListArray.from_arrays(pa.array(upto), pa.array(made["times"].astype(np.int32)))
            columns = [batch.column(0), batch.column(1), *[pa.array(figures[:, k]) for k in range(3)], pa.array(made["digests"], pa.string()), pairs, times]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([False] * n)], names=names)
            held.append(np.unique(made["pairs"], return_counts=True))
            waiting += len(held[-1][0])
            if waiting > 2_000_000:
                held = [_added(held)]
                waiting = len(held[0][0])
                if waiting > 1_000_000:
                    yield counts(batch.schema.field(1).type, *held.pop())
                    waiting = 0
        if held:
            yield counts(batch.schema.field(1).type, *_added(held))

    names = ["uid", "id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times", "counted"]

    def counts(kind: pa.DataType, pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        # Rows of some thousand pairs each, so that none is large.
        cuts = pa.array(np.unique([*range(0, len(pairs), 10_000), len(pairs)]).astype(np.int32))
        rows = max(len(cuts) - 1, 0)
        none = pa.nulls(rows, pa.int64())
        lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (pairs, n.astype(np.int32))] if rows else [pa.nulls(0, pa.list_(t)) for t in (pa.int64(), pa.int32())]
        return pa.RecordBatch.from_arrays([none, pa.nulls(rows, kind), none, none, none, pa.nulls(rows, pa.string()), *lists, pa.array([True] * rows)], names=names)

    return boxed.mapInArrow(run, _MADE.format(id=kind))


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    pairs, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    return pairs, np.bincount(at, np.concatenate([h[1] for h in held]), len(pairs)).astype(np.int64)


def pair_counts(made: DataFrame, pieces: int) -> DataFrame:
    """``pair``, the documents that hold it, and whether that is the highest count of its A id."""
    parts = made.where("counted").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = parts.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("count"))
    counts = settle(counts, "pair-counts")
    first = F.floor(F.col("pair") / F.lit(pieces)).cast("bigint")
    highest = counts.groupBy(first.alias("a")).agg(F.max("count").alias("highest"))
    return counts.withColumn("a", first).join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def alignment_report(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", paths: tuple[str, str] | None = None,
    sent_pairs: int = SENT_PAIRS,
) -> DataFrame:
    """Tokens, groups and links of each document, and how common its links are in the whole table."""
    paths = paths or default_tokenizers()
    made = settle(aligned_texts(df, id_col, text_col, paths), "aligned")
    counts = settle(pair_counts(made, len(token_pair(paths).pieces)), "pair-counts")
    docs = made.where(~F.col("counted"))
    links = docs.select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("uid", "p.*")
    sent = F.broadcast(counts) if fits(counts, sent_pairs) else counts
    # The rows of a document are together, so that a task passes on one sum for each.
    sums = links.join(sent, links["pairs"] == counts["pair"]).groupBy("uid").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    whole = docs.select("uid", "id", "n_a", "n_b", "n_groups", "groups_sha256").join(sums, "uid", "left")
    none = F.lit(0).cast("bigint")
    return whole.select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"),
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
