"""Writers of bounded results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ordertide.operators.decode import encode_json
from ordertide.operators.rollup import with_hour
from ordertide.sinks.streams import kafka_sink_options
from ordertide.sources.kafka import KafkaAuth


def write_kafka(df: DataFrame, servers: str, topic: str, auth: KafkaAuth | None = None) -> None:
    encode_json(df).write.format("kafka").options(**kafka_sink_options(servers, topic, auth)).save()


def write_files(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet", mode: str = "overwrite"
) -> None:
    writer = df.write.mode(mode).format(fmt)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def write_rollup(rollup: DataFrame, path: str, mode: str = "overwrite", tasks: int | None = None) -> None:
    """The minute roll-up, partitioned by hour, with one file per hour.

    An hour holds at most 60 rows per combination of dimensions however many orders it had, so no
    hour is too large for the task that writes it.
    """
    tasks = tasks or rollup.sparkSession.sparkContext.defaultParallelism
    write_files(with_hour(rollup).repartition(tasks, "hour"), path, ["hour"], mode=mode)
