"""Counts of a running query's micro-batches, kept as a table."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ordertide.sinks.segments import write_text

_SCHEMA = (
    "query_id string, run_id string, name string, batch_id bigint, time string, input_rows bigint, metric string, "
    "counts map<string,bigint>"
)


class BatchMetrics(StreamingQueryListener):
    """Writes the observed metrics of each micro-batch of a session's queries to a file of its own in ``path``.

    A replayed batch replaces its file. Metrics come after the batch, so that one cut off before its end
    has none.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}

    def start(self) -> BatchMetrics:
        self._spark.streams.addListener(self)
        return self

    def stop(self) -> None:
        self._spark.streams.removeListener(self)

    def _of(self, run_id) -> threading.Event:
        return self._ended.setdefault(str(run_id), threading.Event())

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until all batches of a query that has ended are written."""
        if not self._of(query.runId).wait(seconds):
            raise TimeoutError(f"no end of query {query.id} after {seconds} seconds")

    def onQueryStarted(self, event) -> None:
        self._of(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        found = [
            {
                "query_id": str(p.id), "run_id": str(p.runId), "name": p.name, "batch_id": p.batchId, "time": p.timestamp,
                "input_rows": p.numInputRows, "metric": metric, "counts": row.asDict(),
            }
            for metric, row in p.observedMetrics.items()
        ]
        if found:
            write_text(self._spark, f"{self.path}/{p.id}_{p.batchId:012d}.json", "\n".join(map(json.dumps, found)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._of(event.runId).set()


def batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row for each batch and metric: ``counts`` by name, beside query, batch and time."""
    return spark.read.schema(_SCHEMA).json(path)


def bad_record_counts(spark: SparkSession, path: str, metric: str) -> DataFrame:
    """Records and malformed ones of every batch that was observed under ``metric``."""
    counts = F.col("counts")
    return batch_metrics(spark, path).where(F.col("metric") == metric).select(
        "query_id", "batch_id", counts["records"].alias("records"), counts["malformed"].alias("malformed")
    )
