"""Operator 6: best-fit packing of token pieces into sequences of a fixed length.

Bounded-space online best-fit: a packer keeps a fixed number of open bins, grouped by their free space.
A bitset has bit f set where some open bin has f free places, so the best fit for a piece of length n
is the lowest set bit at or above n. A piece that fits nowhere opens a bin; beyond the fixed number the
fullest bin closes first.

Documents are tokenized once, where they are read; only (document, piece, length) rows are shuffled.
They are dealt at random to as many packers as there are full sequences for, ``sequences_per_packer``
each, so that the last open bins of all packers are a fixed small share of the result at every size.
Within a packer pieces arrive longest first, which makes the online rule best-fit decreasing.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.llm.rows import sliced
from ordertide.llm.tokens import default_tokenizer, encoder
from ordertide.session import settle

CAPACITY = 4096
OPEN_BINS = 4096
SEQUENCES_PER_PACKER = 1500

PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary"


class Packer:
    """``place(length)`` gives the bin number and the offset in it."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.limit = capacity, open_bins
        self.free_bits, self.n_open, self.n_bins = 0, 0, 0
        self.by_free: dict[int, list[int]] = defaultdict(list)

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.free_bits >> length
        if fitting:
            free = (fitting & -fitting).bit_length() - 1 + length
            number = self._take(free)
        else:
            free, number = self.capacity, self.n_bins
            self.n_bins += 1
        left = free - length
        if left:
            self.by_free[left].append(number)
            self.free_bits |= 1 << left
            self.n_open += 1
            if self.n_open > self.limit:
                self._take((self.free_bits & -self.free_bits).bit_length() - 1)
        return number, self.capacity - free

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.free_bits &= ~(1 << free)
        self.n_open -= 1
        return number


def token_pieces(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = 1,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Each document (null text: empty) as ids and ``end_id``, cut into pieces of ``capacity`` ids.

    Only longer documents are cut; the last piece may be shorter. ``ids`` is null unless asked for.
    Repeated rows and rows without id are documents of their own. Other columns are not read.
    """
    tokenizer = tokenizer or default_tokenizer()
    taken = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    end, width = struct.pack("<I", end_id), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in sliced(batches, "text", 4_000_000):
            columns: list[list] = [[] for _ in names]
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1).to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), width)):
                    cut = ids[at : at + width]
                    row = (doc_id, k, at // 4, len(cut) // 4, zlib.crc32(cut), cut if with_ids else None)
                    for column, v in zip(columns, row):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return taken.mapInArrow(run, PIECE_SCHEMA)


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    open_bins: int = OPEN_BINS,
    sequences_per_packer: int = SEQUENCES_PER_PACKER,
) -> DataFrame:
    """``pieces`` (any columns, with ``length`` between 1 and ``capacity``), and sequence_id and offset.

    ``pieces`` is read twice, so hand in a stored table. A packer keeps ``open_bins`` bins and nothing
    of the bins it has closed. An empty table gives an empty result.
    """
    total = pieces.agg(F.coalesce(F.sum("length"), F.lit(0))).head()[0]
    packers = max(1, math.ceil(total / (capacity * sequences_per_packer)))
    payload = F.struct(*[pieces[c] for c in pieces.columns])
    dealt = pieces.select(pieces["length"].cast("long").alias("length"), F.xxhash64(*pieces.columns).alias("tie"), payload.alias("row"))
    dealt = dealt.withColumn("deal", F.rand(17)).repartition(packers, "deal") if packers > 1 else dealt.coalesce(1)
    dealt = dealt.sortWithinPartitions(F.desc("length"), "tie").select("length", "row", F.spark_partition_id().cast("long").alias("packer"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, open_bins)
        for batch in batches:
            lengths = batch.column(0).to_pylist()
            base = (batch.column(2)[0].as_py() if lengths else 0) << 40
            placed = np.array([packer.place(n) for n in lengths], np.int64).reshape(-1, 2)
            columns = [batch.column(1), pa.array(base + placed[:, 0]), pa.array(placed[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "sequence_id", "offset"])

    schema = T.StructType([dealt.schema["row"], *T.StructType.fromDDL("sequence_id bigint, offset bigint").fields])
    return dealt.mapInArrow(run, schema).select("row.*", "sequence_id", "offset")


def packed_sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, its doc_ids and its ids (binary), from pieces packed with their ids."""
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    whole = packed.groupBy("sequence_id").agg(held.alias("held"))
    joined = F.aggregate("held", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return whole.select("sequence_id", F.col("held.doc_id").alias("doc_ids"), joined.alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, **options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of ``docs``."""
    pieces = token_pieces(docs, tokenizer, capacity=capacity).drop("ids")
    return pack(settle(pieces, "pieces"), capacity, **options)
