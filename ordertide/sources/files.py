"""Files as the transport: the same ``value, timestamp`` records as from a topic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def records(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``value`` as text and ``timestamp`` as epoch seconds, beside the ``keep`` columns."""
    return df.select(
        F.col("value").cast("string").alias("value"),
        F.unix_seconds(F.col("timestamp").cast("timestamp")).alias("timestamp"),
        *keep,
    )


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def stream_table(
    spark: SparkSession,
    sf_dir: str,
    name: str,
    schema: StructType | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A stored table as a stream. The file source wants a folder or a glob, so the path is a glob
    that matches the table alone, be it one file or a folder of them."""
    schema = schema or read_table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(f"{sf_dir}/{name}.parque[t]")


def read_values(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Text files with one JSON record per line, as records."""
    reader = spark.readStream if stream else spark.read
    return reader.text(path).select("value", F.unix_seconds(F.current_timestamp()).alias("timestamp"))
