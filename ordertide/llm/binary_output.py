"""Operator 8: token ids stored as bit planes.

A shard holds the ids of whole documents, back to back. Its ids are cut into blocks of a fixed size; a
block is transposed so that plane b holds bit b of every id (or, with ``planes="byte"``, byte b), and
each plane is compressed with zstandard on its own; a plane of zeros takes no bytes. A reader of one
block needs only that block's planes: a chunk index at the end gives the place of every plane.

Shard layout, little-endian::

    magic "BPS1", uint8 planes (1 bit, 8 byte), 3 bytes zero, uint32 block size, uint64 number of ids
    compressed planes, block after block
    chunk index: per block one uint32 length for each of its planes
    uint64 place of the chunk index

Shards are rows of a Parquet table in the shared folder, written by Spark's own committed writer, so a
lost executor costs a task, and any store that Spark reaches will do. Beside its bytes a shard has its
documents' ids and lengths.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.llm.rows import sliced
from ordertide.llm.tokens import default_tokenizer, encoder
from ordertide.session import scratch_path

MAGIC = b"BPS1"
HEAD = struct.Struct("<4sB3xIQ")
BLOCK = 1 << 16
#: A shard is closed at the first document end at or past so many ids.
SHARD_IDS = 1 << 19

SHARD_SCHEMA = "part int, shard int, first long, n_ids long, doc_ids array<bigint>, lengths array<bigint>, data binary"


def pack_shard(ids: np.ndarray, block: int = BLOCK, planes: str = "bit", level: int = 3) -> bytes:
    """The file bytes of unsigned 32-bit ``ids``."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=level).compress
    kind = {"bit": 1, "byte": 8}[planes]
    ids = np.ascontiguousarray(ids, "<u4")
    out, index = [HEAD.pack(MAGIC, kind, block, len(ids))], []
    for start in range(0, len(ids), block):
        part = ids[start : start + block]
        top = int(part.max()).bit_length()
        for b in range(0, 32, kind):
            if b >= top:
                index.append(0)
                continue
            if kind == 8:
                plane = (part >> np.uint32(b)).astype(np.uint8)
            else:
                plane = np.packbits((part >> np.uint32(b)) & np.uint32(1) != 0, bitorder="little")
            out.append(squeeze(plane.tobytes()))
            index.append(len(out[-1]))
    place = sum(map(len, out))
    out += [np.array(index, "<u4").tobytes(), struct.pack("<Q", place)]
    return b"".join(out)


def unpack_shard(data: bytes, blocks: range | None = None) -> np.ndarray:
    """The ids of a shard, or of the given blocks only."""
    import zstandard

    magic, kind, block, n = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a bit-plane shard")
    n_planes = 4 if kind == 8 else 32
    (place,) = struct.unpack_from("<Q", data, len(data) - 8)
    lengths = np.frombuffer(data, "<u4", (len(data) - 8 - place) // 4, place).astype(np.int64)
    starts = HEAD.size + np.cumsum(lengths) - lengths
    grow, out = zstandard.ZstdDecompressor(), []
    for k in range(-(-n // block)) if blocks is None else blocks:
        size = min(block, n - k * block)
        ids = np.zeros(size, "<u4")
        for b in range(n_planes):
            at = k * n_planes + b
            if lengths[at]:
                plane = np.frombuffer(grow.decompress(data[starts[at] : starts[at] + lengths[at]]), np.uint8)
                if kind == 1:
                    plane = np.unpackbits(plane, count=size, bitorder="little")
                ids |= plane.astype(np.uint32) << np.uint32(b * kind)
        out.append(ids)
    return np.concatenate(out) if out else np.empty(0, "<u4")


def write_token_shards(
    docs: DataFrame,
    path: str,
    tokenizer: str | None = None,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    planes: str = "bit",
    block: int = BLOCK,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Tokenize every text (null: empty), add ``end_id``, and write shards in ascending id order.

    Rows of one id stay in the order of the input; rows without id come first. An empty table gives
    no shards. Other columns are not read. Each task holds one shard and one batch of texts.
    """
    tokenizer = tokenizer or default_tokenizer()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    taken = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    # The ranges are drawn from ids and places alone, so that no text is read for them.
    taken = taken.withColumn("tie", F.monotonically_increasing_id())
    ordered = taken.repartitionByRange(n, "id", "tie").sortWithinPartitions("id", "tie")
    numbered = ordered.withColumn("part", F.spark_partition_id())
    schema = pa.schema([
        ("part", pa.int32()), ("shard", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("data", pa.binary()),
    ])
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        part, shard, first = 0, 0, 0
        doc_ids: list = []
        held: list[bytes] = []
        lengths: list[int] = []

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            row = [[part], [shard], [first], [len(ids)], [doc_ids], [lengths], [pack_shard(ids, block, planes)]]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, schema.types)], schema=schema)

        total = 0
        for batch in sliced(batches, "text", 4_000_000):
            part = batch.column("part")[0].as_py()
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(batch.column("id").to_pylist(), encode(texts)):
                doc_ids.append(doc_id)
                held.append(ids + end)
                lengths.append(len(ids) // 4 + 1)
                total += lengths[-1]
                if total >= shard_ids:
                    yield closed()
                    shard, first, total = shard + 1, first + total, 0
                    doc_ids, held, lengths = [], [], []
        if doc_ids:
            yield closed()

    numbered.select("part", "id", "text").mapInArrow(run, SHARD_SCHEMA).write.option("compression", "none").parquet(path)


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents before it), ids (binary).

    A part of the range order has one row in the table of part sizes, which is as short as the list of
    write tasks and is summed up by a window.
    """
    stored = spark.read.schema(SHARD_SCHEMA).parquet(path)
    parts = stored.groupBy("part").agg(F.sum("n_ids").alias("n_part"))
    before = F.sum("n_part").over(_by_part()) - F.col("n_part")
    parts = parts.select(F.col("part").alias("of"), before.alias("before"))
    placed = stored.join(F.broadcast(parts), stored["part"] == parts["of"])
    placed = placed.select((F.col("before") + F.col("first")).alias("first"), "doc_ids", "lengths", "data")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                first, doc_ids, lengths, data = (c[k].as_py() for c in batch.columns)
                ends = np.cumsum(lengths)
                raw = unpack_shard(data).tobytes()
                ids = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(first + ends - lengths, pa.int64()), pa.array(ids, pa.binary())],
                    schema=schema,
                )

    return placed.mapInArrow(run, "doc_id long, start long, ids binary")


def _by_part():
    from pyspark.sql import Window

    return Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def id_digests(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned crc32 of the ids that ``read_token_shards`` gave."""

    crc = F.crc32("ids")
    return stored.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), crc.alias("ids_crc32"))


def token_shards_round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write the shards of ``docs`` to a fresh shared folder and digest what comes back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-shards")
    write_token_shards(docs, path, **options)
    return id_digests(read_token_shards(spark, path))
