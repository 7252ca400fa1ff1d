"""Conditional writes in order: any number of compare-and-set requests for each key of a keyed table.

A request changes the cell to ``value`` if the cell equals ``expected`` at its turn. Requests of a key
depend on each other, and one key may have a third of them all. So requests and the cells that they meet
are sorted once by key and order into contiguous ranges, which part a busy key by order. Within a range
each key is a run. A run that begins behind the start of its key is first described without its start: as
a map from the cell at its start to the cell at its end, the identity for all cells not named. Read
backwards, a request adds one entry to it: what it expects ends where what it writes ends.

A key goes on over a range's edge at most once an edge, so there are no more such runs than ranges. Their
entries are cut to cells that an earlier run of the key can have left, and followed from run to run. With
the start of every run known, each range is replayed by itself.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from itertools import groupby

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordertide.operators.keyed_table import KEY, _with_rows, _write
from ordertide.session import checkpoint_root

#: Rows that a task passes on at once.
BATCH = 20_000
_BEGINS, _GOES_ON, _ENTRY = 0, 1, 2


def _same(x):
    """A cell as something that equals whatever Spark takes for the same value: NaN equals NaN."""
    return x if x == x else "NaN"


def folded(cell, requests: Iterator[tuple]) -> Iterator[tuple[bool, object]]:
    """Whether each (expected, value) applies, and the cell behind it."""
    for expected, value in requests:
        hit = _same(cell) == _same(expected)
        cell = value if hit else cell
        yield hit, cell


def run_map(requests: Sequence[tuple]) -> dict:
    """Cell at the start of a run of (expected, value) -> (cell at its start, cell at its end); others stay."""
    ends: dict = {}
    for expected, value in reversed(requests):
        ends[_same(expected)] = (expected, ends.get(_same(value), (value, value))[1])
    return ends


def _sorted_ranges(table: DataFrame, requests: DataFrame, column: str, order_by: Sequence[str], expected: str, value: str | None, key: str) -> DataFrame:
    """Cells (``at`` 0) before the requests (``at`` 1) of their key, in ranges that stay as they are."""
    kind = table.schema[column].dataType
    asked = requests.where(F.col(key).isNotNull())
    orders = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_by)]
    new = F.col(value) if value else F.lit(None)
    rows = asked.select(
        F.col(key).alias("k"), F.lit(1).alias("at"), *orders, F.col(expected).cast(kind).alias("e"),
        new.cast(kind).alias("v"), F.struct(*[F.col(c) for c in requests.columns]).alias("request"),
    )
    cells = table.select(F.col(key).alias("k"), F.col(column).alias("v")).join(asked.select(F.col(key).alias("k")).distinct(), "k", "left_semi")
    cells = cells.select(*[F.col(f.name) if f.name in ("k", "v") else F.lit(0 if f.name == "at" else None).cast(f.dataType).alias(f.name) for f in rows.schema])
    order = ["k", "at", *[f"o{i}" for i in range(len(order_by))]]
    checkpoint_root(table.sparkSession)
    return cells.union(rows).repartitionByRange(*order).sortWithinPartitions(*order).select("k", "at", "e", "v", "request").checkpoint()


def _runs(batches) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(key, its rows (at, expected, value, batch, row)) in the order of a range."""

    def rows():
        for batch in batches:
            k, at, e, v = (batch.column(i).to_pylist() for i in range(4))
            for i in range(batch.num_rows):
                yield k[i], (at[i], e[i], v[i], batch, i)

    for k, group in groupby(rows(), lambda r: r[0]):
        yield k, (r for _, r in group)


def _described(ranges: DataFrame) -> DataFrame:
    """How each range begins and ends: ``part, k, role, s, t``.

    ``_BEGINS`` is a run that starts its key (``t``: the cell at its end), ``_GOES_ON`` one that may be
    behind the edge of the range before, and ``_ENTRY`` maps a cell at such a run's start to its end.
    Only a range's first and last runs are told.
    """
    cell = ranges.schema["v"].dataType
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField("k", ranges.schema["k"].dataType),
        T.StructField("role", T.IntegerType()), T.StructField("s", cell), T.StructField("t", cell),
    ])

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        part, made, last = TaskContext.get().partitionId(), [], None
        for number, (k, rows) in enumerate(_runs(batches)):
            first = next(rows)
            if number == 0 and first[0] == 1:
                requests = [first[1:3], *[r[1:3] for r in rows]]
                made += [(part, k, _GOES_ON, None, None), *[(part, k, _ENTRY, s, t) for s, t in run_map(requests).values()]]
                continue
            state = first[2] if first[0] == 0 else None
            rest = (r[1:3] for r in rows)
            if first[0] == 1:
                _, state = next(folded(None, iter([first[1:3]])))
            for _, state in folded(state, rest):
                pass
            last = (part, k, _BEGINS, None, state)
        if last:
            made.append(last)
        fields = to_arrow_schema(schema)
        for i in range(0, len(made), BATCH):
            yield pa.RecordBatch.from_pylist([dict(zip(fields.names, r)) for r in made[i : i + BATCH]], fields)

    return ranges.mapInArrow(run, schema)


def _starts(ranges: DataFrame) -> dict[int, object]:
    """The cell at the start of every range whose first run goes on from the range before.

    The driver sees at most two runs a range, and the entries stay in the tasks.
    """
    told = _described(ranges).checkpoint()
    edges = told.where(F.col("role") < _ENTRY).orderBy("part", F.col("role").desc()).collect()
    going, open_key = [], None
    for r in edges:
        if r["role"] == _GOES_ON and open_key is not None and r["k"] == open_key:
            going.append(r["part"])
        open_key = r["k"]
    if not going:
        return {}
    runs = told.where(F.col("part").isin(going) & (F.col("role") != _BEGINS))
    begun = told.where(F.col("role") == _BEGINS)
    # A first run that goes on from nothing starts without a cell; the cell at its end is that of its map.
    fresh = told.where(~F.col("part").isin(going) & (F.col("role") != _BEGINS))
    fresh = fresh.groupBy("part", "k").agg(
        F.max(F.when(F.col("s").isNull() & (F.col("role") == _ENTRY), F.struct("t")))["t"].alias("t")
    ).select("part", "k", F.lit(_BEGINS).alias("role"), F.lit(None).cast(told.schema["s"].dataType).alias("s"), "t")
    begun = begun.unionByName(fresh).join(runs.select("k").distinct(), "k", "left_semi")
    entries = runs.where(F.col("role") == _ENTRY)
    left = begun.select("k", "part", "t").union(entries.select("k", "part", "t")).groupBy(F.col("k").alias("k2"), F.col("t").alias("t2")).agg(F.min("part").alias("since"))
    met = (F.col("k") == F.col("k2")) & F.col("s").eqNullSafe(F.col("t2")) & (F.col("since") < F.col("part"))
    entries = entries.join(left, met, "left_semi")
    rows = begun.unionByName(entries).unionByName(runs.where(F.col("role") == _GOES_ON))
    schema = T.StructType([told.schema["part"], T.StructField("start", told.schema["s"].dataType)])

    def follow(table):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        out, now = [], None
        ordered = sorted(table.select(["part", "role", "s", "t"]).to_pylist(), key=lambda r: r["part"])
        for part, group in groupby(ordered, lambda r: r["part"]):
            group = list(group)
            if group[0]["role"] == _BEGINS:
                now = group[0]["t"]
                continue
            out.append({"part": part, "start": now})
            now = {_same(r["s"]): r["t"] for r in group if r["role"] == _ENTRY}.get(_same(now), now)
        return pa.Table.from_pylist(out, to_arrow_schema(schema))

    return {r["part"]: r["start"] for r in rows.groupBy("k").applyInArrow(follow, schema).collect()}


def _replayed(ranges: DataFrame, starts: dict[int, object]) -> DataFrame:
    """Each request with ``applied``, and rows without a request: the last ``cell`` of a key that was written in a range."""
    kept = T.StructType([
        ranges.schema["request"], T.StructField("applied", T.BooleanType()), ranges.schema["k"],
        T.StructField("cell", ranges.schema["v"].dataType), T.StructField("part", T.IntegerType()),
    ])

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        part, fields = TaskContext.get().partitionId(), to_arrow_schema(kept)

        def told(held):
            """Requests of one source batch and what became of them."""
            source, rows, hits = held
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [source.column(4).take(pa.array(rows, pa.int32())), pa.array(hits, pa.bool_())]
                + [pa.nulls(n, fields.field(i).type) for i in (2, 3, 4)], schema=fields)

        held, finals = None, []
        for number, (k, rows) in enumerate(_runs(batches)):
            cell, changed = starts.get(part) if number == 0 else None, False
            for at, e, v, source, i in rows:
                if at == 0:
                    cell = v
                    continue
                hit = _same(cell) == _same(e)
                cell, changed = (v, True) if hit else (cell, changed)
                if held is None or held[0] is not source:
                    if held:
                        yield told(held)
                    held = (source, [], [])
                held[1].append(i)
                held[2].append(hit)
            if changed:
                finals.append({"k": k, "cell": cell, "part": part})
            if len(finals) >= BATCH:
                yield pa.RecordBatch.from_pylist(finals, fields)
                finals = []
        if held:
            yield told(held)
        if finals:
            yield pa.RecordBatch.from_pylist(finals, fields)

    return ranges.mapInArrow(run, kept)


def _in_order(table, requests, column, order_by, expected, value, key):
    ranges = _sorted_ranges(table, requests, column, order_by, expected, value, key)
    replayed = _replayed(ranges, _starts(ranges))
    results = replayed.where(F.col("request").isNotNull()).select("request.*", "applied")
    nobody = requests.where(F.col(key).isNull()).withColumn("applied", F.lit(False))
    # A key that goes on over an edge has a cell for each range; the last one counts.
    finals = replayed.where(F.col("request").isNull()).groupBy("k").agg(F.max_by(F.struct("cell"), "part").alias("last"))
    return _write(table, finals.select(F.col("k").alias(key), F.col("last.cell").alias(column)), column, key), results.unionByName(nobody)


def check_and_put_in_order(
    table: DataFrame, requests: DataFrame, column: str, order_by: Sequence[str],
    expected: str = "expected", value: str = "value", key: str = KEY,
) -> tuple[DataFrame, DataFrame]:
    """Each request in turn writes ``value`` where the cell then equals ``expected`` (null = no cell).

    ``order_by`` must tell the requests of a key apart; a key's requests are judged in that order. A
    ``value`` of null deletes the cell, so that puts and deletes can follow each other. Requests without
    a key are not applied. Returns the table afterwards and the requests with ``applied``.
    """
    after, results = _in_order(table, requests, column, order_by, expected, value, key)
    return _with_rows(after, key), results


def check_and_delete_in_order(
    table: DataFrame, requests: DataFrame, column: str, order_by: Sequence[str],
    expected: str = "expected", key: str = KEY,
) -> tuple[DataFrame, DataFrame]:
    """Each request in turn deletes the cell where it then equals ``expected``.

    An absent cell equals an ``expected`` of null: that request applies and changes nothing.
    """
    after, results = _in_order(table, requests, column, order_by, expected, None, key)
    return _with_rows(after, key), results


# Workers get these functions by value and need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
