"""Run stream writers: until all available data is done, or with periodic re-planning."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ordertide.session import scratch_path
from ordertide.sinks.streams import to_batches, to_files


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Run an all-available-data writer to its end; its error, if any, is raised here."""
    query = writer.start()
    query.awaitTermination()
    return query


def run_with_refresh(
    make_writer: Callable[[], DataStreamWriter], refresh_seconds: float, rounds: int | None = None
) -> int:
    """Start, run for ``refresh_seconds``, stop, and start anew on the same checkpoint.

    ``make_writer`` is called for every round, so each round plans its query again and sees the
    current files of static side tables. ``rounds`` bounds the loop; None runs until the query
    ends by itself. Returns the number of rounds started.
    """
    done = 0
    while rounds is None or done < rounds:
        query = make_writer().start()
        done += 1
        if query.awaitTermination(refresh_seconds):
            break
        query.stop()
    return done


def drain_to_table(
    df: DataFrame,
    name: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Run a stream over all its available data into the shared folder and read the result back."""
    spark = df.sparkSession
    base = scratch_path(spark, name)
    out, checkpoint = f"{base}/out", f"{base}/checkpoint"
    if transform is None:
        run_available(to_files(df, out, checkpoint))
        return spark.read.schema(df.schema).parquet(out)
    run_available(to_batches(df, out, checkpoint, transform=transform))
    return spark.read.parquet(out).drop("query_id", "batch_id")
