"""Kafka as a source: option dictionaries, and the read itself."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ordertide.functions.scalars import to_millis
from ordertide.sources.files import records

# Start and end markers. Fixed values.
LATEST = -1
EARLIEST = -2


@dataclass(frozen=True)
class KafkaAuth:
    """SASL settings, passed to the client under its own property names."""

    protocol: str = "SASL_PLAINTEXT"
    mechanism: str = "PLAIN"
    jaas: str | None = None

    def options(self) -> dict[str, str]:
        out = {"kafka.security.protocol": self.protocol, "kafka.sasl.mechanism": self.mechanism}
        if self.jaas:
            out["kafka.sasl.jaas.config"] = self.jaas
        return out


def is_bounded(start: int, end: int) -> bool:
    """A read is bounded when its end is a time after its start."""
    return end > start and end > 0


def start_options(start: int, bounded: bool = False) -> dict[str, str]:
    """Where to begin: a time (seconds or ms), ``EARLIEST``, or ``LATEST`` (also any other value).

    A bounded read cannot begin at the latest offset, so there it begins at the earliest.
    """
    if start > 0:
        return {
            "startingTimestamp": str(to_millis(start)),
            "startingOffsetsByTimestampStrategy": "latest",
        }
    if start == EARLIEST or bounded:
        return {"startingOffsets": "earliest"}
    return {"startingOffsets": "latest"}


def end_options(end: int) -> dict[str, str]:
    """Where a bounded read ends: before a time (seconds or ms), else at the latest offset."""
    if end > 0:
        return {"endingTimestamp": str(to_millis(end))}
    return {"endingOffsets": "latest"}


def source_options(
    servers: str,
    topics: str,
    start: int = LATEST,
    end: int = LATEST,
    pattern: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    auth: KafkaAuth | None = None,
) -> dict[str, str]:
    """All reader options for a comma-separated topic list, or a topic pattern.

    Offsets that have expired do not fail the job. New partitions are found at every micro-batch.
    ``min_partitions`` splits large topic partitions into several read tasks.
    """
    bounded = is_bounded(start, end)
    out = {
        "kafka.bootstrap.servers": servers,
        "subscribePattern" if pattern else "subscribe": topics,
        "failOnDataLoss": "false",
        **start_options(start, bounded),
    }
    if bounded:
        out.update(end_options(end))
    elif max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        out["minPartitions"] = str(min_partitions)
    return {**out, **(auth.options() if auth else {})}


def read_kafka(
    spark: SparkSession, servers: str, topics: str, start: int = LATEST, end: int = LATEST, **options
) -> DataFrame:
    """Records ``value, timestamp`` (seconds): a table when ``[start, end)`` is bounded, else a stream."""
    keep = options.pop("keep", ())
    reader = spark.read if is_bounded(start, end) else spark.readStream
    df = reader.format("kafka").options(**source_options(servers, topics, start, end, **options)).load()
    return records(df, keep)
