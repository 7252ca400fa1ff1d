"""A sparse index of a stored record log, by which offset questions choose their files.

One row for each file and (topic, partition) in it: least and greatest offset and time. A question first
asks the index, which is smaller than the log by the number of records in a file, and then reads only the
files that can hold its answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.functions.scalars import to_millis
from ordertide.session import settle
from ordertide.sinks.segments import folders
from ordertide.sources.record_log import NO_OFFSET, PAIR, seek

_FIGURES = "least_offset bigint, greatest_offset bigint, least_time bigint, greatest_time bigint, records bigint"


def file_name(uri: Column) -> Column:
    """One form of a file's URI, which Spark gives with one slash or three where the store has no host."""
    return F.regexp_replace(uri, r"^(\w[\w+.-]*):///", "$1:/")


def _names(log: DataFrame) -> list[str]:
    return [re.sub(r"^(\w[\w+.-]*):///", r"\1:/", f) for f in log.inputFiles()]


def file_figures(log: DataFrame) -> DataFrame:
    """The index rows of ``log``, a plain read of files; only their figures are shuffled."""
    offset, time = F.col("offset").cast("bigint"), F.col("timestamp").cast("bigint")
    return log.groupBy(file_name(F.col("_metadata.file_path")).alias("file"), *PAIR).agg(
        F.min(offset).alias("least_offset"), F.max(offset).alias("greatest_offset"),
        F.min(time).alias("least_time"), F.max(time).alias("greatest_time"), F.count(F.lit(1)).alias("records"),
    )


class LogIndex:
    """The index, in ``index_path``, of the Parquet log in ``log_path``; ``refresh`` adds files that are new."""

    def __init__(self, spark: SparkSession, log_path: str, index_path: str) -> None:
        self.spark, self.log_path, self.index_path = spark, log_path, index_path

    def _log(self) -> DataFrame:
        return self.spark.read.parquet(self.log_path)

    def _stored(self) -> DataFrame | None:
        return self.spark.read.parquet(self.index_path) if folders(self.spark, self.index_path) else None

    def refresh(self) -> int:
        """Index the files that are not in it yet; gives their number. Files of a log do not change."""
        stored, log = self._stored(), self._log()
        present = set(_names(log))
        done = {r["file"] for r in stored.select("file").distinct().collect()} if stored is not None else set()
        new = sorted(present - done)
        if new:
            figures = file_figures(self._files(new))
            # A refresh that is cut off leaves a folder without its end, which the next one replaces.
            name = f"refresh={len(folders(self.spark, self.index_path)):06d}"
            figures.coalesce(1).write.mode("overwrite").parquet(f"{self.index_path}/{name}")
        return len(new)

    def table(self) -> DataFrame:
        """Index rows of the files that are still in the log."""
        stored = self._stored()
        if stored is None:
            log = self._log()
            pair = ", ".join(f"`{c}` {log.schema[c].dataType.simpleString()}" for c in PAIR)
            return self.spark.createDataFrame([], f"file string, {pair}, {_FIGURES}")
        return stored.drop("refresh").where(F.col("file").isin(_names(self._log())))

    def _files(self, names: Iterable[str]) -> DataFrame:
        """The log's records in some of its files."""
        names, log = sorted(set(names)), self._log()
        return self.spark.read.schema(log.schema).parquet(*map(unquote, names)) if names else log.limit(0)

    def offsets_for_time(self, t: int) -> DataFrame:
        """``record_log.offsets_for_time``, for which only files that straddle ``t`` are read.

        A file that begins at or after ``t`` answers by its least offset. One that straddles ``t`` is read
        if it begins before the best of these answers.
        """
        ms, index = to_millis(t), self.table()
        pairs = index.groupBy(*PAIR).agg(F.min(F.when(F.col("least_time") >= ms, F.col("least_offset"))).alias("whole"))
        if ms == 0:
            return pairs.select(*PAIR, F.lit(NO_OFFSET).cast("bigint").alias("offset"))
        straddling = index.where((F.col("least_time") < ms) & (F.col("greatest_time") >= ms)).join(pairs, list(PAIR))
        straddling = straddling.where(F.col("whole").isNull() | (F.col("least_offset") < F.col("whole")))
        names = [r["file"] for r in straddling.select("file").distinct().collect()]
        read = self._files(names).where(F.col("timestamp") >= ms).groupBy(*PAIR).agg(F.min("offset").cast("bigint").alias("read"))
        found = F.least("whole", "read")  # skips nulls
        return pairs.join(read, list(PAIR), "left").select(*PAIR, F.coalesce(found, F.lit(NO_OFFSET)).cast("bigint").alias("offset"))

    def seek(self, offsets: int | Sequence[int | None] | DataFrame) -> DataFrame:
        """``record_log.seek`` over the files whose greatest offset reaches the start."""
        figures = self.table().withColumn("offset", F.col("greatest_offset"))
        names = [r["file"] for r in seek(figures, offsets).select("file").distinct().collect()]
        return seek(self._files(names), offsets)

    def seek_from_time(self, t: int) -> DataFrame:
        """Records from the first offset at or after ``t`` of each partition on."""
        return self.seek(settle(self.offsets_for_time(t), "offsets"))

    def last_offsets(self) -> DataFrame:
        """The next offset to be written, per partition; the log is not read."""
        return self.table().groupBy(*PAIR).agg((F.max("greatest_offset") + 1).alias("last_offset"))
