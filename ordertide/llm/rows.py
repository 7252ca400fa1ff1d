"""Running Arrow code over whole rows, and small array helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW, TEXT = "row", "text"


def with_text(df: DataFrame, text_col: str) -> DataFrame:
    """Each row as one struct beside its text, so that no column of the caller can clash with ours."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias(ROW), df[text_col].cast("string").alias(TEXT))


def map_texts(
    df: DataFrame, text_col: str, fn: Callable[[list], dict], schema: str, batch_chars: int = 4_000_000
) -> DataFrame:
    """``row`` and the columns of ``schema``, which ``fn`` makes from a list of texts (None: null).

    The list holds about ``batch_chars`` characters, or one text where that is longer.
    """
    boxed = with_text(df, text_col)
    fields = T.StructType.fromDDL(schema)
    out = T.StructType([boxed.schema[ROW], *fields.fields])
    arrow = [pa.field(f.name, arrow_type(f.dataType)) for f in fields.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, TEXT, batch_chars):
            made = fn(batch.column(1).to_pylist())
            columns = [batch.column(0), *[pa.array(made[f.name], f.type) for f in arrow]]
            yield pa.RecordBatch.from_arrays(columns, names=[ROW, *[f.name for f in arrow]])

    return boxed.mapInArrow(run, out)


def sliced(batches: Iterator[pa.RecordBatch], column: str, chars: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``chars`` bytes of ``column``."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(False)
        ends, start = np.cumsum(lengths), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + chars, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ranges(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each c of ``counts``, one after another."""
    counts = np.asarray(counts, np.int64)
    starts = np.cumsum(counts) - counts
    return np.arange(int(counts.sum()), dtype=np.int64) - np.repeat(starts, counts)


def unpacked(df: DataFrame, *extra: str) -> DataFrame:
    """The caller's columns again, and the named new ones."""
    return df.select(f"{ROW}.*", *[F.col(c) for c in extra])
