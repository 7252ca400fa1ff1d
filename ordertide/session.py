"""Where a job may keep shared scratch data, and how it proves that a table is small."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Scratch paths handed out in this thread since a ``recorded_scratch`` began.
_recorded: ContextVar[list[str] | None] = ContextVar("recorded_scratch", default=None)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own: on a cluster a
    machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so a rerun cannot meet old files."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    if (recorded := _recorded.get()) is not None:
        recorded.append(path)
    return path


@contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """The scratch paths that this thread takes meanwhile, for ``remove_scratch`` once nothing reads them."""
    outer, paths = _recorded.get(), []
    token = _recorded.set(paths)
    try:
        yield paths
    finally:
        _recorded.reset(token)
        if outer is not None:
            outer.extend(paths)


def remove_scratch(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete scratch tables that no DataFrame still in use reads, in whatever store they are."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """``df`` computed once into the shared folder and read back from there.

    For a small result that is read several times. Lost executors cost nothing already computed, and
    Spark knows the size of the files, so its own broadcast threshold judges the true size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; reads no more than one row beyond that."""
    return df.limit(max_rows + 1).count() <= max_rows


def streaming_session(
    spark: SparkSession, state_partitions: int | None = None, idle_batches: bool = True
) -> SparkSession:
    """A session for stateful queries whose number of state partitions is chosen, not inherited.

    The number is fixed for the life of a checkpoint, so it should follow the cluster's cores and
    not the shuffle setting that happens to be in force. ``idle_batches`` are micro-batches without
    data: they close windows once the watermark has passed. State with a processing-time TTL asks
    for them without end, so a TTL query that is to stop when its data is done must forgo them.
    """
    session = spark.newSession()
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(idle_batches).lower())
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return session
