"""Queries over streams that arrive in several micro-batches, and over what they store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.functions.scalars import HOUR_MS
from ordertide.operators.decode import decode_fields
from ordertide.operators.rollup import rollup_minute
from ordertide.plans.jobs import TXN, TXN_COLUMNS, run_job, txn_projection
from ordertide.session import scratch_path, streaming_session
from ordertide.sinks.rollup_store import RollupStore
from ordertide.sinks.streams import drop_replays, folder_sink, to_sink
from ordertide.sources.files import read_table
from ordertide.sources.log_index import LogIndex
from ordertide.streaming import dedup as stream_dedup
from ordertide.streaming.event_time import with_event_time
from ordertide.streaming.metrics import BatchMetrics, bad_record_counts
from ordertide.streaming.progress import file_lag
from ordertide.streaming.rates import RateSnapshot
from ordertide.streaming.run import run_available
from ordertide.streaming.seen_keys import SeenKeys, to_sink_once
from ordertide.streaming.side_outputs import order_outputs, read_output, to_side_outputs
from registry import feed
from registry.queries import AS_OF, SEEK_TIME, _money

#: Micro-batches in which the events arrive, by event id, and files of each.
BATCHES, FILES = 4, 2


def _arriving(session: SparkSession, sf: str, shuffled: bool = False) -> DataFrame:
    """All events as a stream in ``BATCHES`` micro-batches: one part of the time each or, ``shuffled``, some of
    every time, so that all but the first batch bring late rows. ``batch`` is the number of an event's."""
    events = read_table(session, sf, "events")
    ids = events.agg(F.max("event_id") + 1).head()[0] or 1
    batch = F.pmod("event_id", F.lit(BATCHES)) if shuffled else F.floor(F.col("event_id") * BATCHES / ids)
    events = events.withColumn("batch", batch.cast("int"))
    path = scratch_path(session, "arriving")
    for k in range(BATCHES):
        events.where(F.col("batch") == k).repartition(FILES).write.mode("append").parquet(path)
    stream = session.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES)
    return stream.parquet(path)


def _arriving_orders(session: SparkSession, sf: str, shuffled: bool = False) -> DataFrame:
    return feed.orders_from_events(_arriving(session, sf, shuffled))


def _home(session: SparkSession, name: str) -> tuple[str, str]:
    base = scratch_path(session, name)
    return f"{base}/out", f"{base}/checkpoint"


def _stored(session: SparkSession, out: str) -> DataFrame:
    """Result rows with the number of the micro-batch that gave them."""
    return session.read.parquet(out).drop("query_id").withColumn("batch_id", F.col("batch_id").cast("bigint"))


def stream_dedup_seen_table(spark, sf):
    """First row of each key over all micro-batches, against a table of seen keys."""
    session = streaming_session(spark)
    out, checkpoint = _home(session, "seen-out")
    rows = txn_projection(_arriving_orders(session, sf).where("database = 'order'"), keep=("offset",))
    rows = rows.select("country", "order_id", "offset")
    seen = SeenKeys(scratch_path(session, "seen"), ["country", "order_id"], buckets=8, fold_every=2)
    run_available(to_sink_once(rows, checkpoint, seen, ["offset"], folder_sink(out)))
    return _stored(session, out)


def stream_dedup_batches(spark, sf):
    """The keys that each micro-batch is the first to hold, by the state store."""
    session = streaming_session(spark)
    out, checkpoint = _home(session, "forever-out")
    rows = txn_projection(_arriving_orders(session, sf).where("database = 'order'")).select("country", "order_id")
    kept = stream_dedup.forever(rows, ["country", "order_id"], collapse=True)
    run_available(to_sink(kept, checkpoint, folder_sink(out)))
    return _stored(session, out)


def stream_dedup_ttl_batches(spark, sf):
    """First row of each key by offset within its micro-batch, with state that would live for a day."""
    session = streaming_session(spark, idle_batches=False)
    out, checkpoint = _home(session, "ttl-out")
    rows = txn_projection(_arriving_orders(session, sf, shuffled=True).where("database = 'order'"), keep=("offset",))
    kept = stream_dedup.with_ttl(rows.select("country", "order_id", "offset"), ["country", "order_id"], order_by="offset")
    run_available(to_sink(kept, checkpoint, folder_sink(out)))
    return _stored(session, out)


def stream_dedup_late(spark, sf):
    """Within the watermark, of which each micro-batch leaves rows that are too old for the next one."""
    session = streaming_session(spark)
    out, checkpoint = _home(session, "late-out")
    rows = txn_projection(_arriving_orders(session, sf, shuffled=True).where("database = 'order'"))
    rows = with_event_time(rows, "event_time", None).select("country", "order_id", "event_ts")
    kept = stream_dedup.within_watermark(rows, ["country", "order_id"], "event_ts", "10 days")
    run_available(to_sink(kept.select("country", "order_id"), checkpoint, folder_sink(out)))
    return _stored(session, out)


def stream_rollup_late(spark, sf):
    """Minutes by a window on event time, from several micro-batches: rows behind the watermark are left out,
    and so are minutes that it has not passed."""
    session = streaming_session(spark)
    out, checkpoint = _home(session, "rollup-late")
    rows = txn_projection(_arriving_orders(session, sf, shuffled=True).where("database = 'order'")).select("country", "event_time")
    run_available(to_sink(rollup_minute(rows, (), delay="10 days"), checkpoint, folder_sink(out)))
    return _stored(session, out).drop("batch_id")


def stream_rollup_stored(spark, sf):
    """De-duplication, the rates of each batch's time, and a stored roll-up that later batches correct."""
    session = streaming_session(spark)
    _, checkpoint = _home(session, "rollup-stored")
    store = RollupStore(scratch_path(session, "rollup-store"))
    rates = RateSnapshot(lambda: feed.rates_from_events(read_table(session, sf, "events")))

    def add(rows: DataFrame, query: str, batch_id: int) -> None:
        store.add(rows, query, batch_id)
        if batch_id == BATCHES - 2:  # the last batch corrects hours that are folded by then
            store.compact(session)

    seen = SeenKeys(scratch_path(session, "rollup-seen"), TXN.keys, buckets=8)
    run_available(TXN.write(
        feed.as_records(_arriving_orders(session, sf, shuffled=True)), checkpoint=checkpoint, rates=rates, as_of=AS_OF, rate_date="event",
        time_filter=False, sink=add, seen=seen, arrival=("offset",),
    ))
    store.compact(session)
    return _money(store.read(session), "gmv", "gmv_usd")


def _with_far_times(orders: DataFrame) -> DataFrame:
    """Some orders get a time in the year 14645."""
    far = F.pmod("offset", F.lit(97)) == 20
    return orders.withColumn("create_time", F.when(far, F.lit(400000000000000)).otherwise(F.col("create_time")))


def stream_side_outputs(spark, sf):
    """Every record in the outputs to which it belongs, from one scan; two of the outputs have sinks."""
    session = streaming_session(spark)
    out, checkpoint = _home(session, "side")
    records = feed.as_dirty_records(_with_far_times(_arriving_orders(session, sf)))
    rows = order_outputs(records, AS_OF - 10 * 24 * HOUR_MS, keep=("offset",))
    txn, far = scratch_path(session, "side-txn"), scratch_path(session, "side-far")
    run_available(to_side_outputs(rows, out, checkpoint, {"txn": folder_sink(txn), "far_time": folder_sink(far)}))
    sunk = [session.read.parquet(p).select(F.lit(o).alias("output"), "offset") for o, p in (("txn", txn), ("far_time", far))]
    left = [read_output(session, out, o).select(F.lit(o).alias("output"), "offset") for o in ("user", "late", "malformed", "other")]
    whole = sunk[0]
    for part in sunk[1:] + left:
        whole = whole.unionByName(part)
    return whole


def stream_bad_counts(spark, sf):
    """Malformed records of each micro-batch, counted as the job runs."""
    session = streaming_session(spark)
    out, checkpoint = _home(session, "counted")
    metrics = BatchMetrics(session, scratch_path(session, "metrics")).start()
    try:
        query = run_available(TXN.write(
            feed.as_dirty_records(_arriving_orders(session, sf)), out, checkpoint, as_of=AS_OF, observe="orders"
        ))
        metrics.wait(query)
    finally:
        metrics.stop()
    return bad_record_counts(session, metrics.path, "orders").where("records > 0").drop("query_id")


def stream_txn_records(spark, sf):
    """The transaction job to a topic of records with keys, in which one batch stands twice."""
    session = streaming_session(spark)
    _, checkpoint = _home(session, "records")
    topic = scratch_path(session, "topic")
    rates = feed.rates_from_events(read_table(session, sf, "events"))
    run_available(run_job(
        "txn", feed.as_dirty_records(_arriving_orders(session, sf)), checkpoint=checkpoint, as_of=AS_OF,
        rates=RateSnapshot(lambda: rates), sink={"type": "records", "path": topic},
        seen=SeenKeys(scratch_path(session, "records-seen"), TXN.keys, buckets=8), arrival=("offset",),
    ))
    sent = session.read.parquet(topic)
    again = sent.where(F.get_json_object("key", "$[1]") == "2")
    kinds = {"gmv": "double", "country": "string", "gmv_usd": "double"}
    fields = {c: (kinds.get(c, "bigint"), None) for c in TXN_COLUMNS}
    return decode_fields(drop_replays(sent.union(again)), fields)


# --- record log with an index ---------------------------------------------------------------------------


def _indexed(spark, sf) -> LogIndex:
    orders = feed.orders_from_events(read_table(spark, sf, "events"))
    log = orders.select("topic", "partition", "offset", "timestamp", F.col("order_id").alias("value"))
    path = scratch_path(spark, "log")
    log.repartitionByRange(8, "offset").sortWithinPartitions("offset").write.parquet(f"{path}/log")
    index = LogIndex(spark, f"{path}/log", f"{path}/index")
    index.refresh()
    return index


def log_index_offsets_for_time(spark, sf):
    return _indexed(spark, sf).offsets_for_time(SEEK_TIME)


def log_index_seek(spark, sf):
    return _indexed(spark, sf).seek([500, None, 900])


def log_index_seek_from_time(spark, sf):
    return _indexed(spark, sf).seek_from_time(SEEK_TIME)


def log_index_last_offset(spark, sf):
    return _indexed(spark, sf).last_offsets()


def log_lag_of_checkpoint(spark, sf):
    """Records that a query over a stored log has not committed: those that came after it had run."""
    path, (out, checkpoint) = scratch_path(spark, "lag-log"), _home(spark, "lag")
    orders = feed.orders_from_events(read_table(spark, sf, "events"))
    log = orders.select("topic", "partition", "offset", "timestamp")
    ids = log.agg(F.max("offset") + 1).head()[0] or 1
    last = F.floor(F.col("offset") * BATCHES / ids) == BATCHES - 1
    log.where(~last).repartition(FILES).write.parquet(path)
    run_available(to_sink(spark.readStream.schema(log.schema).parquet(path), checkpoint, folder_sink(out)))
    log.where(last).repartition(FILES).write.mode("append").parquet(path)
    index = LogIndex(spark, path, scratch_path(spark, "lag-index"))
    index.refresh()
    return file_lag(index, checkpoint)


QUERIES = {
    f.__name__: f
    for f in (
        stream_dedup_seen_table, stream_dedup_batches, stream_dedup_ttl_batches, stream_dedup_late, stream_rollup_late, stream_rollup_stored,
        stream_side_outputs, stream_bad_counts, stream_txn_records,
        log_index_offsets_for_time, log_index_seek, log_index_seek_from_time, log_index_last_offset, log_lag_of_checkpoint,
    )
}
