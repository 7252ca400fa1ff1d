"""A stored roll-up that a stream adds to, late rows included, and that is read as one table.

Every micro-batch adds a segment of partial sums, and a replayed batch replaces its own. A late row is one
more partial sum of its hour. Reading adds up what an hour has: its current fold and the segments that no
fold has taken in for that hour. ``compact`` folds some hours. What it writes counts from the moment its
state is complete: a small table of each hour's current fold, beside one of the (hour, segment) pairs that
folds stand for. So an hour's segments are replaced at once, and are never read beside their fold.

Files are sorted by minute, so that a read of some hours leaves out the rest by the files' statistics.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.functions.scalars import ntz_literal, truncate_ntz_hour
from ordertide.operators.rollup import TXN_METRICS, reaggregate, rollup_minute
from ordertide.session import settle
from ordertide.sinks.segments import folders, is_complete, remove, segment_name

_HOUR, _SOURCE = "__hour", "__source"
_STATE = f"{_HOUR} timestamp_ntz, {_SOURCE} string"


class RollupStore:
    """The minute roll-up by ``dimensions`` in ``path``."""

    def __init__(
        self, path: str, metrics: Sequence[str] = TXN_METRICS, dimensions: Sequence[str] = ("country",),
        types: dict[str, str] | None = None,
    ) -> None:
        """``types`` are those of dimensions that are no strings and metrics that are no doubles."""
        self.path, self.metrics, self.dimensions = path, tuple(metrics), tuple(dimensions)
        types = types or {}
        self.schema = ", ".join([
            "minute_ts timestamp_ntz", *[f"`{d}` {types.get(d, 'string')}" for d in self.dimensions], "`count` bigint",
            *[f"`{m}` {types.get(m, 'double')}" for m in self.metrics],
        ])

    def add(self, rows: DataFrame, query: str, batch_id: int) -> None:
        """Take up the rows of a micro-batch as its segment, in place of what it had before.

        Rows without a calendar date are left out (``far_times`` gives them).
        """
        rollup = rollup_minute(rows, self.metrics, self.dimensions)
        rollup.sortWithinPartitions("minute_ts").write.mode("overwrite").parquet(f"{self.path}/deltas/{segment_name(query, batch_id)}")

    def _state(self, spark: SparkSession) -> tuple[str | None, DataFrame, DataFrame]:
        """The newest complete fold, each hour's current one, and the (hour, segment) pairs not to be read."""
        for name in reversed(folders(spark, f"{self.path}/folds")):
            fold = f"{self.path}/folds/{name}"
            if is_complete(spark, f"{fold}/current"):
                return name, *[spark.read.schema(_STATE).parquet(f"{fold}/{t}") for t in ("current", "inside")]
        none = spark.createDataFrame([], _STATE)
        return None, none, none

    def _part(self, spark: SparkSession, kind: str, name: str) -> DataFrame:
        path = f"{self.path}/{kind}/{name}" + ("/data" if kind == "folds" else "")
        rows = spark.read.schema(self.schema).parquet(path)
        return rows.withColumns({_HOUR: truncate_ntz_hour("minute_ts"), _SOURCE: F.lit(name)})

    def _sources(self, spark: SparkSession) -> tuple[DataFrame, list[str], list[str], str | None, DataFrame, DataFrame]:
        """All rows that count with their hour and source, and the segments, folds and state that they are from."""
        last, current, inside = self._state(spark)
        segments = [n for n in folders(spark, f"{self.path}/deltas") if is_complete(spark, f"{self.path}/deltas/{n}")]
        folds = [n for n in folders(spark, f"{self.path}/folds") if last is not None and n <= last]
        pair = [_HOUR, _SOURCE]
        same = lambda a, b: [a[c].eqNullSafe(b[c]) for c in pair]  # noqa: E731  rows without a time have a null hour
        parts = []
        if segments:
            deltas = reduce(DataFrame.union, [self._part(spark, "deltas", n) for n in segments])
            parts.append(deltas.join(F.broadcast(inside), same(deltas, inside), "left_anti"))
        if folds:
            folded = reduce(DataFrame.union, [self._part(spark, "folds", n) for n in folds])
            parts.append(folded.join(F.broadcast(current), same(folded, current), "left_semi"))
        if not parts:
            parts = [spark.createDataFrame([], f"{self.schema}, {_STATE}")]
        return reduce(DataFrame.unionByName, parts), segments, folds, last, current, inside

    def _sums(self, rows: DataFrame) -> DataFrame:
        return reaggregate(rows, ["minute_ts", *self.dimensions], self.metrics)

    def read(self, spark: SparkSession, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """The roll-up, or its minutes in ``[start, end)`` (UTC wall-clock values)."""
        rows = self._sources(spark)[0]
        for bound, outside in ((start, lambda m, b: m >= b), (end, lambda m, b: m < b)):
            if bound is not None:
                rows = rows.where(outside(F.col("minute_ts"), ntz_literal(bound)))
        return self._sums(rows)

    def compact(self, spark: SparkSession, before: datetime | None = None, least: int = 2) -> int:
        """Fold the hours that start before ``before`` and have at least ``least`` sources; gives their number.

        Segments and folds of which nothing counts any more are removed once the new state is complete. A
        reader that has planned its read before that must be done by then. One ``compact`` runs at a time;
        the job that adds segments may run on.
        """
        rows, segments, folds, last, current, inside = self._sources(spark)
        held = settle(rows.select(_HOUR, _SOURCE).distinct(), "held")
        many = held.groupBy(_HOUR).count().where(F.col("count") >= least).select(_HOUR)
        if before is not None:
            many = many.where(F.col(_HOUR) < ntz_literal(before))
        many = settle(many, "many")  # a row for each hour
        number = many.count()
        if not number:
            return 0
        name = f"{0 if last is None else int(last) + 1:06d}"
        path = f"{self.path}/folds/{name}"
        of_many = lambda df, how: df.join(F.broadcast(many), df[_HOUR].eqNullSafe(many[_HOUR]), how)
        sums = self._sums(of_many(rows, "left_semi"))
        sums.repartitionByRange("minute_ts").sortWithinPartitions("minute_ts").write.mode("overwrite").parquet(f"{path}/data")
        taken = of_many(held, "left_semi").where(F.col(_SOURCE).isin(segments))
        # Segments that are there now may outlive a removal that is cut off. One that is gone can come back only
        # as the replay of its query's last batch.
        pairs = inside.unionByName(taken).distinct()
        query = F.regexp_extract(_SOURCE, "^(.*)_", 1)
        newest = [r[0] for r in pairs.groupBy(query).agg(F.max(_SOURCE).alias(_SOURCE)).select(_SOURCE).collect()]
        left = {r[0] for r in of_many(held, "left_anti").select(_SOURCE).distinct().collect()}
        kept = sorted({*newest, *segments})
        pairs.where(F.col(_SOURCE).isin(kept)).coalesce(1).write.mode("overwrite").parquet(f"{path}/inside")
        now = of_many(current, "left_anti").unionByName(many.withColumn(_SOURCE, F.lit(name)))
        now.coalesce(1).write.mode("overwrite").parquet(f"{path}/current")
        # The state of a fold lies in its folder, so the newest one stays whatever it holds.
        gone = [f"{self.path}/deltas/{n}" for n in segments if n not in left] + [f"{self.path}/folds/{n}" for n in folds if n not in left]
        remove(spark, *gone)
        return number
