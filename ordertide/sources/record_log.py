"""Offset questions asked of a stored record log: ``topic, partition, offset, timestamp (ms), value``.

A log has few (topic, partition) pairs and one of them may hold most records, so nothing here
shuffles records by that pair: pairs are aggregated before the shuffle, or their offsets broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.functions.scalars import to_millis
from ordertide.operators.rates import lookup
from ordertide.session import settle

NO_OFFSET = -1
PAIR = ("topic", "partition")


def offsets_for_time(log: DataFrame, t: int) -> DataFrame:
    """First offset at or after ``t`` (seconds or ms) of each partition, -1 when there is none."""
    ms = to_millis(t)
    late = F.col("timestamp") >= F.lit(ms) if ms != 0 else F.lit(False)
    return log.groupBy(*PAIR).agg(
        F.coalesce(F.min(F.when(late, F.col("offset"))), F.lit(NO_OFFSET)).alias("offset")
    )


def offsets_json(offsets: DataFrame) -> DataFrame:
    """Offsets as one JSON text ``{topic: {partition: offset}}``; its size is that of the topic list."""
    entry = F.struct(F.col("partition").cast("int").alias("p"), F.col("offset").cast("bigint").alias("o"))
    per_topic = offsets.groupBy("topic").agg(F.array_sort(F.collect_list(entry)).alias("es"))
    named = F.transform("es", lambda e: F.struct(e["p"].cast("string").alias("p"), e["o"].alias("o")))
    per_topic = per_topic.select("topic", F.to_json(F.map_from_entries(named)).alias("j"))
    quoted = F.concat(F.lit('"'), F.col("topic"), F.lit('":'), F.col("j"))
    return per_topic.groupBy().agg(
        F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(quoted)), ","), F.lit("}")).alias("offsets")
    )


def seek(log: DataFrame, offsets: int | Sequence[int | None] | DataFrame) -> DataFrame:
    """Records from the given start offsets on.

    ``offsets`` is one offset for all partitions, a list with one per partition number, or a table
    ``topic, partition, offset``. A partition without an offset (None, -1 or no row) gives nothing.
    """
    if isinstance(offsets, DataFrame):
        start = offsets.where(F.col("offset") >= 0).select(*PAIR, F.col("offset").alias("__start"))
        # The least start is redundant, but it is a plain predicate that reaches the scan.
        least = start.agg(F.min("__start")).head()[0]
        if least is None:
            return log.where(F.lit(False))
        found = lookup(log.where(F.col("offset") >= least), start, {c: c for c in PAIR}, ["__start"])
        return found.where(F.col("offset") >= F.col("__start")).drop("__start")
    if isinstance(offsets, int):
        return log.where(F.col("offset") >= offsets)
    known = [o for o in offsets if o is not None and o >= 0]
    if not known:
        return log.where(F.lit(False))
    starts = F.array(*[F.lit(o if o is not None and o >= 0 else None).cast("bigint") for o in offsets])
    # The smallest start is redundant, but it is a plain predicate that reaches the scan.
    return log.where(F.col("offset") >= min(known)).where(
        F.col("offset") >= F.get(starts, F.col("partition").cast("int"))
    )


def seek_to_beginning(log: DataFrame) -> DataFrame:
    return seek(log, 0)


def seek_from_time(log: DataFrame, t: int) -> DataFrame:
    """Records from the first offset at or after ``t`` of each partition on."""
    return seek(log, settle(offsets_for_time(log, t), "offsets"))


def last_offsets(log: DataFrame) -> DataFrame:
    """The next offset to be written, per partition."""
    return log.groupBy(*PAIR).agg((F.max("offset") + 1).alias("last_offset"))


def committed_offsets(progress: DataFrame) -> DataFrame:
    """The newest committed offset per partition of a table of commits ``topic, partition, offset``."""
    return progress.groupBy(*PAIR).agg(F.max("offset").alias("committed"))


def offset_lag(last: DataFrame, committed: DataFrame) -> DataFrame:
    """Records not yet consumed per topic: last offset less the committed one (0 if none), summed."""
    both = last.join(committed, list(PAIR), "left")
    behind = F.col("last_offset") - F.coalesce("committed", F.lit(0))
    return both.groupBy("topic").agg(F.sum(behind).alias("lag"))


def progress_offsets(progress: dict) -> dict[str, dict[str, int]]:
    """End offsets per source topic of a streaming query's ``lastProgress``."""
    out: dict[str, dict[str, int]] = {}
    for source in progress.get("sources", []):
        end = source.get("endOffset")
        if isinstance(end, dict):
            for topic, parts in end.items():
                if isinstance(parts, dict):
                    out.setdefault(topic, {}).update(parts)
    return out
