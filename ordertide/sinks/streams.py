"""Stream writers. Each function gives an unstarted writer, so the caller decides how to run it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ordertide.operators.decode import encode_json
from ordertide.operators.dedup import first_per_key
from ordertide.sinks.segments import query_id
from ordertide.sources.kafka import KafkaAuth

#: Takes the rows of a micro-batch, the id of the query and the number of the batch. A replayed batch
#: comes again with the same query and number.
Sink = Callable[[DataFrame, str, int], None]


def _writer(df: DataFrame, checkpoint: str | None, trigger: str | None) -> DataStreamWriter:
    """Append writer; ``trigger`` is a processing-time interval, or None for all available data."""
    writer = df.writeStream.outputMode("append")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)


def kafka_sink_options(servers: str, topic: str, auth: KafkaAuth | None = None) -> dict[str, str]:
    out = {"kafka.bootstrap.servers": servers, "topic": topic}
    return {**out, **(auth.options() if auth else {})}


def to_kafka(
    df: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    trigger: str | None = "10 seconds",
    auth: KafkaAuth | None = None,
    keep_nulls: bool = False,
) -> DataStreamWriter:
    """All columns as one JSON ``value`` per record. The topic sees each record at least once."""
    writer = _writer(encode_json(df, keep_nulls=keep_nulls), checkpoint, trigger)
    return writer.format("kafka").options(**kafka_sink_options(servers, topic, auth))


def to_console(df: DataFrame, trigger: str | None = "10 seconds") -> DataStreamWriter:
    return _writer(df, None, trigger).format("console").option("truncate", "false")


def to_memory(df: DataFrame, name: str) -> DataStreamWriter:
    """A driver-side table, for small tests."""
    return _writer(df, None, None).format("memory").queryName(name)


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = None,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
) -> DataStreamWriter:
    """Exactly once: the sink's own log decides which files count."""
    writer = _writer(df, checkpoint, trigger).format(fmt).option("path", path)
    return writer.partitionBy(*partition_by) if partition_by else writer


def folder_sink(path: str, fmt: str = "parquet") -> Sink:
    """Every micro-batch owns the folder ``query_id=Q/batch_id=N`` and overwrites it in a replay.

    The query's id is that of its checkpoint: a new checkpoint on the same path starts at batch 0 again
    but cannot erase what an earlier one finished.
    """

    def write(rows: DataFrame, query: str, batch_id: int) -> None:
        rows.write.mode("overwrite").format(fmt).save(f"{path}/query_id={query}/batch_id={batch_id}")

    return write


def record_keys(rows: DataFrame, keys: Sequence[str], query: str, batch_id: int, keep_nulls: bool = False) -> DataFrame:
    """Rows as records ``key, value``: a row of a replayed batch has the key that it had before.

    The key is made of query, batch and the columns ``keys``, which must tell the rows of a batch apart; a
    number by position would not outlive a replay, which may deal rows out in another order.
    """
    parts = F.array(F.lit(query), F.lit(str(batch_id)), *[F.col(k).cast("string") for k in keys])
    return rows.select(F.to_json(parts).alias("key"), F.to_json(F.struct(*rows.columns), {"ignoreNullFields": str(not keep_nulls).lower()}).alias("value"))


def drop_replays(records: DataFrame) -> DataFrame:
    """Records of a topic that holds some batches twice, once: the first of each key by offset, if there is one."""
    if "offset" not in records.columns:
        return records.dropDuplicates(["key"])
    return first_per_key(records, ["key"], ["offset"])


def kafka_records_sink(servers: str, topic: str, keys: Sequence[str], auth: KafkaAuth | None = None, keep_nulls: bool = False) -> Sink:
    """Records with keys to a topic, which may see a batch more than once; ``drop_replays`` is for its readers."""

    def write(rows: DataFrame, query: str, batch_id: int) -> None:
        records = record_keys(rows, keys, query, batch_id, keep_nulls)
        records.write.format("kafka").options(**kafka_sink_options(servers, topic, auth)).save()

    return write


def file_records_sink(path: str, keys: Sequence[str], keep_nulls: bool = False) -> Sink:
    """Records with keys appended to a folder as to a topic: a replayed batch stands there twice."""

    def write(rows: DataFrame, query: str, batch_id: int) -> None:
        record_keys(rows, keys, query, batch_id, keep_nulls).write.mode("append").parquet(path)

    return write


def console_sink(rows_shown: int = 20) -> Sink:
    def write(rows: DataFrame, query: str, batch_id: int) -> None:
        print(f"batch {batch_id}")
        rows.show(rows_shown, truncate=False)

    return write


def sink_from(options: dict[str, str], keys: Sequence[str], auth: KafkaAuth | None = None) -> Sink:
    """The sink that ``options`` name by ``type``: ``folder``, ``records``, ``kafka`` or ``console``."""
    options = dict(options)
    kind = options.pop("type", None)
    made = {
        "folder": lambda path, format="parquet": folder_sink(path, format),
        "records": lambda path: file_records_sink(path, keys),
        "kafka": lambda servers, topic: kafka_records_sink(servers, topic, keys, auth),
        "console": lambda rows="20": console_sink(int(rows)),
    }
    if kind not in made:
        raise ValueError(f"a sink's type is one of {sorted(made)}, not {kind!r}")
    return made[kind](**options)


def to_sink(
    df: DataFrame,
    checkpoint: str,
    sink: Sink,
    trigger: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataStreamWriter:
    """Each micro-batch, seen by ``transform`` as a plain table, to ``sink``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sink(transform(batch) if transform else batch, query_id(batch), batch_id)

    return _writer(df, checkpoint, trigger).foreachBatch(write)


def to_batches(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    fmt: str = "parquet",
) -> DataStreamWriter:
    """Exactly once through ``foreachBatch`` and ``folder_sink``: a failure between write and commit leaves
    neither a gap nor a copy."""
    return to_sink(df, checkpoint, folder_sink(path, fmt), trigger, transform)
