"""De-duplication for ever against a table of seen keys instead of the state store.

The table outlives checkpoints and holds any number of keys: each micro-batch reads only the part of it
that it may meet. Keys are dealt into buckets by their hash, and each batch adds a segment: a folder per
bucket with its new keys, and a Bloom filter per bucket. A batch asks the filters of all segments first.
Keys that no filter knows are new without a look at the table; buckets whose filters know none of the
batch's keys are not read; the few keys that are left are looked up exactly. Segments are folded into one
every ``fold_every`` batches.

A batch's segment is written after its output and replaced by a replay, which sees no segment of its own
batch or a later one. So output and table agree whatever write a failure cuts off. One query writes to a
table at a time; a query with a new checkpoint finds all keys of the earlier ones.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ordertide.operators.dedup import first_per_key, not_seen
from ordertide.session import recorded_scratch, remove_scratch, settle
from ordertide.sinks.segments import folders, has_parts, is_before, is_complete, query_id, remove, segment_name
from ordertide.sinks.streams import Sink, _writer

#: Bits of a filter for each key, and bits that a key sets: one foreign key in 100,000 is taken for known.
BITS, MARKS = 24, 12
HASH, BUCKET, MAYBE = "__hash", "__bucket", "__maybe"


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    h = hashes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    low, high = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return (low[:, None] + np.arange(MARKS, dtype=np.uint64) * high[:, None]) % np.uint64(bits)


def bloom_filter(hashes: np.ndarray) -> bytes:
    """The bits that 64-bit ``hashes`` set, ``BITS`` for each."""
    marks = np.zeros(-(-len(hashes) * BITS // 8) * 8, np.uint8)
    marks[_places(hashes, len(marks))] = 1
    return np.packbits(marks).tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of ``hashes`` may have been among those of the filter; those left out were not."""
    data = np.frombuffer(bits, np.uint8)
    places = _places(hashes, 8 * len(data))
    return ((data[places >> np.uint64(3)] >> (7 - (places & np.uint64(7))).astype(np.uint8)) & 1).all(1)


class SeenKeys:
    """The keys that a job has let through, in ``path``. A bucket's hashes must fit into one task."""

    def __init__(self, path: str, keys: Sequence[str], buckets: int = 64, fold_every: int = 20) -> None:
        self.path, self.keys, self.buckets, self.fold_every = path, list(keys), buckets, fold_every

    def _dealt(self, df: DataFrame) -> DataFrame:
        hashed = df.withColumn(HASH, F.xxhash64(*self.keys))
        return hashed.withColumn(BUCKET, F.pmod(HASH, F.lit(self.buckets)).cast("int"))

    def _folded(self, spark: SparkSession) -> tuple[str | None, set[str]]:
        """The newest complete fold, and the segments that it stands for."""
        for name in reversed(folders(spark, f"{self.path}/folds")):
            log = f"{self.path}/folds/{name}/log"
            if is_complete(spark, log):
                return name, {r["segment"] for r in spark.read.parquet(log).collect()}
        return None, set()

    def segments(self, spark: SparkSession, query: str | None = None, batch_id: int = 0) -> list[str]:
        """Folders whose keys count, for a batch of a query: its own and later ones do not."""
        fold, inside = self._folded(spark)
        names = [n for n in folders(spark, f"{self.path}/segments") if n not in inside]
        names = [n for n in names if query is None or is_before(n, query, batch_id)]
        paths = [f"{self.path}/segments/{n}" for n in names] + ([f"{self.path}/folds/{fold}"] if fold else [])
        return [p for p in paths if is_complete(spark, f"{p}/filters")]

    def _stored(self, spark: SparkSession, segments: Sequence[str], part: str) -> DataFrame:
        """``keys`` or ``filters`` of segments; a bucket is a folder of its own and is pruned as such."""
        return reduce(DataFrame.unionByName, [spark.read.parquet(f"{s}/{part}") for s in segments])

    def _holding(self, spark: SparkSession, segments: Sequence[str]) -> list[str]:
        """Those of ``segments`` that hold keys: a batch without new ones leaves no file to read a schema from."""
        return [s for s in segments if has_parts(spark, f"{s}/keys", BUCKET)]

    def known(self, spark: SparkSession) -> DataFrame | None:
        """All keys of the table, or None while there are none."""
        found = self._holding(spark, self.segments(spark))
        return self._stored(spark, found, "keys").select(*self.keys) if found else None

    def fresh(self, rows: DataFrame, query: str, batch_id: int) -> DataFrame:
        """Rows (one per key) whose key the table does not hold."""
        spark = rows.sparkSession
        found = self._holding(spark, self.segments(spark, query, batch_id))
        if not found:
            return rows
        dealt = self._dealt(rows)
        schema = T.StructType([*dealt.schema.fields, T.StructField(MAYBE, T.BooleanType())])

        def ask(table, filters):
            import pyarrow as pa

            hashes, hit = table.column(HASH).to_numpy(), np.zeros(len(table), bool)
            for bits in filters.column("bits").to_pylist():
                hit |= may_hold(bits, hashes)
            return table.append_column(MAYBE, pa.array(hit))

        filters = self._stored(spark, found, "filters").select(BUCKET, "bits")
        asked = dealt.groupBy(BUCKET).cogroup(filters.groupBy(BUCKET)).applyInArrow(ask, schema)
        asked = settle(asked, "asked")
        new, maybe = asked.where(f"NOT {MAYBE}"), asked.where(MAYBE)
        # At most one number a bucket.
        touched = [r[0] for r in maybe.select(BUCKET).distinct().collect()]
        if touched:
            stored = self._stored(spark, found, "keys").where(F.col(BUCKET).isin(touched))
            # The table is cut to the keys in question first, so that it need not be shuffled for a few.
            wanted = maybe.select(*[F.col(k).alias(f"__w_{k}") for k in self.keys])
            same = [F.col(k).eqNullSafe(F.col(f"__w_{k}")) for k in self.keys]
            new = new.unionByName(not_seen(maybe, stored.join(wanted, same, "left_semi"), self.keys))
        return new.select(*rows.columns)

    def _save(self, dealt: DataFrame, path: str) -> None:
        """Keys by bucket, then their filters, whose end makes the segment count."""
        spark = dealt.sparkSession
        spread = dealt.select(*self.keys, HASH, BUCKET).repartition(self.buckets, BUCKET)
        spread.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/keys")

        def build(table):
            import pyarrow as pa

            hashes = table.column(HASH).to_numpy()
            return pa.table({BUCKET: table.column(BUCKET)[:1], "n": [len(hashes)], "bits": [bloom_filter(hashes)]})

        written = spark.read.schema(spread.schema).parquet(f"{path}/keys")
        filters = written.select(HASH, BUCKET).groupBy(BUCKET).applyInArrow(build, f"{BUCKET} int, n bigint, bits binary")
        filters.write.mode("overwrite").parquet(f"{path}/filters")

    def add(self, rows: DataFrame, query: str, batch_id: int) -> None:
        """Take up the keys of ``rows`` as the segment of this batch, in place of what it had before."""
        self._save(self._dealt(rows.select(*self.keys)), f"{self.path}/segments/{segment_name(query, batch_id)}")

    def fold(self, spark: SparkSession, query: str, batch_id: int) -> bool:
        """Make one segment of those before this batch, if there are many; it counts once its log is written.

        Without any key among them the log alone stands for them.
        """
        found = self.segments(spark, query, batch_id)
        if len(found) <= self.fold_every:
            return False
        last, inside = self._folded(spark)
        path = f"{self.path}/folds/{0 if last is None else int(last) + 1:06d}"
        if holding := self._holding(spark, found):
            self._save(self._stored(spark, holding, "keys"), path)
        gone = {p.rsplit("/", 1)[1] for p in found if "/segments/" in p}
        log = spark.createDataFrame([(n,) for n in sorted(gone | inside)], "segment string")
        log.coalesce(1).write.mode("overwrite").parquet(f"{path}/log")
        remove(spark, *[f"{self.path}/segments/{n}" for n in gone], *([f"{self.path}/folds/{last}"] if last else []))
        return True


def to_sink_once(
    df: DataFrame, checkpoint: str, seen: SeenKeys, order_by: Sequence, sink: Sink, trigger: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataStreamWriter:
    """Rows whose key ``seen`` does not hold, the first of a batch by ``order_by``, to ``sink``.

    The stream itself is without state: the keys of a batch are added to ``seen`` once the sink has its
    rows, and a replay does both again with the same rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        query = query_id(batch)
        with recorded_scratch() as scratch:
            seen.fold(batch.sparkSession, query, batch_id)
            first = first_per_key(batch, seen.keys, order_by)
            fresh = settle(seen.fresh(first, query, batch_id), "fresh")
        # What the sink or a rate snapshot stores meanwhile is not this batch's to remove.
        sink(transform(fresh) if transform else fresh, query, batch_id)
        seen.add(fresh, query, batch_id)
        remove_scratch(batch.sparkSession, scratch)

    return _writer(df, checkpoint, trigger).foreachBatch(write)


# Workers get these functions by value and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
