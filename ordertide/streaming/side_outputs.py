"""One pass over the records of a topic for several outputs, each with its own sink and its own commit."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ordertide.functions.scalars import (
    DEFAULT_TZ,
    HOUR_MS,
    currency_to_country,
    event_date,
    is_calendar_time,
    now_millis,
    second_to_millisecond,
)
from ordertide.operators.decode import decode_orders
from ordertide.operators.routing import tag_routes
from ordertide.sinks.segments import is_complete, mark_complete, query_id, segment_name
from ordertide.sinks.streams import Sink, _writer

OUTPUT = "output"
#: Outputs of an order topic.
TXN, USER, LATE, FAR, MALFORMED, OTHER = "txn", "user", "late", "far_time", "malformed", "other"


def order_outputs(
    records: DataFrame, as_of: int | None = None, tz: str = DEFAULT_TZ, period_ms: int = HOUR_MS,
    keep: Sequence[str] = ("value",), observe: str | None = None,
) -> DataFrame:
    """Every record decoded once, as one row for each ``output`` that it belongs to.

    Paid orders go to ``txn`` and, as visits, to ``user``, unless they are older than ``period_ms`` (``late``)
    or their time has no calendar date (``far_time``, paid or not). ``malformed`` records and those of
    ``other`` databases keep what ``keep`` names of them, such as their text.
    """
    orders = decode_orders(records, "flag", keep=keep, observe=observe)
    time = second_to_millisecond(F.coalesce("create_time", F.lit(0)))
    rows = orders.withColumns({"event_time": time, "country": currency_to_country("currency")})
    good, far = F.col("routed") & ~F.col("is_bad"), ~is_calendar_time("event_time")
    paid = good & ~far & (F.col("order_status") == "paid")
    late = F.col("event_time") < now_millis(as_of) - F.lit(period_ms)
    tagged = tag_routes(rows, {
        TXN: paid & ~late, USER: paid & ~late, LATE: paid & late, FAR: good & far, MALFORMED: F.col("is_bad"),
        OTHER: ~F.col("routed") & ~F.col("is_bad"),
    }, OUTPUT)
    day = F.when(F.col(OUTPUT) == USER, event_date("event_time", tz))
    return tagged.select(OUTPUT, "gmv", "order_id", "user_id", "country", "event_time", day.alias("event_date"), *keep)


def to_side_outputs(
    df: DataFrame, path: str, checkpoint: str, sinks: dict[str, Sink], trigger: str | None = None,
    transforms: dict[str, Callable[[DataFrame], DataFrame]] | None = None, tag: str = OUTPUT,
) -> DataStreamWriter:
    """Each micro-batch of tagged rows written once below ``path``, and from there to the sink of each tag.

    The input is scanned once however many sinks there are. A sink that has its rows is marked, so that a
    replay goes on with those that have not, with the very rows that were written before. Tags without a
    sink stay in ``path``, where ``read_output`` finds them.
    """
    transforms = transforms or {}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, query = batch.sparkSession, query_id(batch)
        name = segment_name(query, batch_id)
        folder = f"{path}/batches/segment={name}"
        if not is_complete(spark, folder):
            batch.write.mode("overwrite").partitionBy(tag).parquet(folder)
        written = spark.read.schema(batch.schema).parquet(folder)
        for output, sink in sinks.items():
            done = f"{path}/commits/{name}/{output}"
            if not is_complete(spark, done):
                rows = written.where(F.col(tag) == output).drop(tag)
                sink(transforms[output](rows) if output in transforms else rows, query, batch_id)
                mark_complete(spark, done)

    return _writer(df, checkpoint, trigger).foreachBatch(write)


def read_output(spark: SparkSession, path: str, output: str, tag: str = OUTPUT) -> DataFrame:
    """What all batches below ``path`` hold of one output, with their ``segment``; other outputs are not read."""
    return spark.read.parquet(f"{path}/batches").where(F.col(tag) == output).drop(tag)
