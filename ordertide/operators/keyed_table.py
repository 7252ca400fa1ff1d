"""Reads and writes of a keyed table: one row per ``rowkey``, one column per cell, null = no cell.

Writes take a table of requests and give the table after them. Requests are cut to one row per key
before they meet the table, so a key that is asked for again and again is no hot key in the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordertide.operators.dedup import first_per_key

KEY = "rowkey"


def scan(table: DataFrame, column: str, key: str = KEY) -> DataFrame:
    """Key and cell of every row that has the cell."""
    return table.where(F.col(column).isNotNull()).select(key, column)


def get(keys: DataFrame, table: DataFrame, column: str, key: str = KEY) -> DataFrame:
    """The cell for each requested key, null when there is none. Keys may repeat."""
    cells = table.select(F.col(key).alias("__k"), column)
    return keys.join(cells, F.col(key) == F.col("__k"), "left").drop("__k")


def _with_rows(table: DataFrame, key: str) -> DataFrame:
    """Rows with at least one cell; a row without cells does not exist."""
    cells = [F.col(c) for c in table.columns if c != key]
    return table.where(F.coalesce(*[c.cast("string") for c in cells]).isNotNull())


def _write(table: DataFrame, puts: DataFrame, column: str, key: str) -> DataFrame:
    """Upsert one cell per key of ``puts`` (unique keys); other cells stay."""
    puts = puts.select(F.col(key).alias("__k"), F.col(column).alias("__v"), F.lit(True).alias("__hit"))
    joined = table.join(puts, F.col(key) == F.col("__k"), "full_outer")
    new = {
        key: F.coalesce(F.col(key), F.col("__k")),
        column: F.when(F.col("__hit"), F.col("__v")).otherwise(F.col(column)),
    }
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in table.columns])


def put(table: DataFrame, puts: DataFrame, column: str, order_by: Sequence, key: str = KEY) -> DataFrame:
    """Write ``column`` of ``puts`` into the table; the last put of a key by ``order_by`` wins."""
    return _write(table, first_per_key(puts, [key], order_by, largest=True), column, key)


def delete_rows(table: DataFrame, keys: DataFrame, key: str = KEY) -> DataFrame:
    """The table without the rows of ``keys``."""
    return table.join(keys.select(key).distinct(), key, "left_anti")


def delete_cells(table: DataFrame, keys: DataFrame, column: str, key: str = KEY) -> DataFrame:
    """The table without the cell ``column`` of the rows of ``keys``."""
    hit = keys.select(F.col(key).alias("__k")).distinct()
    joined = table.join(hit, F.col(key) == F.col("__k"), "left")
    cell = F.when(F.col("__k").isNull(), F.col(column)).alias(column)
    return _with_rows(joined.select(*[cell if c == column else c for c in table.columns]), key)


def put_if_absent(
    table: DataFrame, requests: DataFrame, column: str, order_by: Sequence[str], key: str = KEY
) -> tuple[DataFrame, DataFrame]:
    """Write the cell where the table has none; the first request of a key by ``order_by`` wins.

    Returns the table afterwards and the requests with ``applied``. ``order_by`` must tell the
    requests of a key apart. Winners are joined back on the key and the order together, which
    spreads the requests of one key over all tasks.
    """
    first = first_per_key(requests.select(key, column, *order_by), [key], order_by)
    wins = first.join(scan(table, column, key).select(key), key, "left_anti")
    mark = wins.select(
        F.col(key).alias("__k"), *[F.col(c).alias(f"__o_{c}") for c in order_by], F.lit(True).alias("__won")
    )
    same = [F.col(key) == F.col("__k"), *[F.col(c).eqNullSafe(F.col(f"__o_{c}")) for c in order_by]]
    results = requests.join(mark, same, "left").select(
        *requests.columns, F.coalesce("__won", F.lit(False)).alias("applied")
    )
    return _write(table, wins, column, key), results


def _one_per_key(requests: DataFrame, key: str) -> DataFrame:
    """The requests, stopping the job when a key has more than one of them."""
    cells = [c for c in requests.columns if c != key]
    grouped = requests.groupBy(key).agg(
        F.count(F.lit(1)).alias("__n"), *[F.min(F.struct(c)).alias(c) for c in cells]
    )
    message = F.concat(F.lit("more than one conditional request for key "), F.col(key).cast("string"))
    return grouped.select(
        F.when(F.col("__n") > 1, F.raise_error(message).cast(requests.schema[key].dataType))
        .otherwise(F.col(key)).alias(key),
        *[F.col(c)[c].alias(c) for c in cells],
    )


def _judged(table: DataFrame, requests: DataFrame, column: str, expected: str, key: str) -> DataFrame:
    """Requests with ``applied``: whether the current cell equals ``expected`` (null = no cell)."""
    current = table.select(F.col(key).alias("__k"), F.col(column).alias("__cur"))
    return (
        _one_per_key(requests, key)
        .join(current, F.col(key) == F.col("__k"), "left")
        .withColumn("applied", F.col("__cur").eqNullSafe(F.col(expected)))
        .select(*requests.columns, "applied")
    )


def check_and_put(
    table: DataFrame,
    requests: DataFrame,
    column: str,
    expected: str = "expected",
    value: str = "value",
    key: str = KEY,
) -> tuple[DataFrame, DataFrame]:
    """Write ``value`` where the cell equals ``expected``, with at most one request per key.

    Returns the table afterwards and the requests with ``applied``.
    """
    results = _judged(table, requests, column, expected, key)
    puts = results.where("applied").select(key, F.col(value).alias(column))
    return _write(table, puts, column, key), results


def check_and_delete(
    table: DataFrame, requests: DataFrame, column: str, expected: str = "expected", key: str = KEY
) -> tuple[DataFrame, DataFrame]:
    """Delete the cell where it equals ``expected``, with at most one request per key.

    Returns the table afterwards and the requests with ``applied``.
    """
    results = _judged(table, requests, column, expected, key)
    return delete_cells(table, results.where("applied"), column, key), results


def save_bucketed(table: DataFrame, name: str, buckets: int, key: str = KEY) -> None:
    """Store the table bucketed and sorted by key: later joins on the key do not shuffle it again."""
    table.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
