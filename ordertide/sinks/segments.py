"""Tables that grow by one folder a micro-batch, in which a replayed batch replaces its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ordertide.session import remove_scratch


def _store(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    at, store = _store(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(at)) if store.exists(at) else []


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a ``path`` that holds nothing else but marks; none if there is no such path."""
    return [n for n in _names(spark, path) if n[0] not in "_."]


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a ``path`` without folders; none if there is no such path."""
    return [n for n in _names(spark, path) if n[0] not in "_."]


def has_parts(spark: SparkSession, path: str, column: str) -> bool:
    """Whether the table in ``path``, partitioned by ``column``, has any partition."""
    return any(n.startswith(f"{column}=") for n in _names(spark, path))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has ended."""
    at, store = _store(spark, f"{path}/_SUCCESS")
    return store.exists(at)


def remove(spark: SparkSession, *paths: str) -> None:
    remove_scratch(spark, paths)


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query that gives ``batch``; it lives as long as the checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def segment_name(query: str, batch_id: int) -> str:
    return f"{query}_{batch_id:012d}"


def is_before(name: str, query: str, batch_id: int) -> bool:
    """Whether the segment is not of this batch or, in a replay, of a later one of the same query."""
    other, _, number = name.rpartition("_")
    return other != query or int(number) < batch_id


def mark_complete(spark: SparkSession, path: str) -> None:
    """Say that ``path``, which holds nothing else, is done."""
    at, store = _store(spark, f"{path}/_SUCCESS")
    store.create(at, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, in place of one that is there."""
    at, store = _store(spark, path)
    out = store.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()
