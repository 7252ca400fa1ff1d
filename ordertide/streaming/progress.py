"""How far a streaming query has come, read from its checkpoint: what its latest committed batch had taken in."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.sinks.segments import files
from ordertide.sources.log_index import LogIndex, file_name
from ordertide.sources.record_log import PAIR, offset_lag

_OFFSETS = "topic string, partition int, offset bigint"


def committed_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The number of the latest batch that is committed, None before the first. A batch that has begun does not count."""
    numbers = [int(n) for n in files(spark, f"{checkpoint}/commits") if n.isdigit()]
    return max(numbers, default=None)


def _source_offsets(spark: SparkSession, checkpoint: str) -> list[str]:
    """The end offset of each source in the latest committed batch, as the checkpoint has them: one line each."""
    batch = committed_batch(spark, checkpoint)
    if batch is None:
        return []
    (row,) = spark.read.text(f"{checkpoint}/offsets/{batch}", wholetext=True).collect()
    return row["value"].splitlines()[2:]  # behind the version and the batch's settings


def checkpoint_offsets(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``topic, partition, offset``: the next offset that a query over topics will read."""
    found = []
    for line in _source_offsets(spark, checkpoint):
        told = json.loads(line) if line != "-" else {}
        for topic, partitions in told.items():
            if isinstance(partitions, dict):
                found += [(topic, int(p), int(o)) for p, o in partitions.items()]
    return spark.createDataFrame(found, _OFFSETS)


def checkpoint_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``file``: those that a query over files has taken in, with its latest committed batch."""
    parts = []
    for number, line in enumerate(_source_offsets(spark, checkpoint)):
        told = json.loads(line) if line != "-" else {}
        if "logOffset" in told:
            entries = spark.read.schema("path string, batchId bigint").json(f"{checkpoint}/sources/{number}")
            parts.append(entries.where(F.col("path").isNotNull() & (F.col("batchId") <= told["logOffset"])).select(file_name(F.col("path")).alias("file")))
    out = spark.createDataFrame([], "file string")
    for p in parts:
        out = out.union(p)
    return out.distinct()


def topic_lag(last: DataFrame, spark: SparkSession, checkpoint: str) -> DataFrame:
    """Records per topic behind the ``last`` offsets of each partition, for a query over topics."""
    return offset_lag(last, checkpoint_offsets(spark, checkpoint).select(*PAIR, F.col("offset").alias("committed")))


def file_lag(index: LogIndex, checkpoint: str) -> DataFrame:
    """Records per topic in files that a query over a stored log has not committed. The log is not read."""
    done = checkpoint_files(index.spark, checkpoint).withColumn("done", F.lit(True))
    left = F.when(F.col("done").isNull(), F.col("records")).otherwise(0)
    return index.table().join(done, "file", "left").groupBy("topic").agg(F.sum(left).alias("lag"))
