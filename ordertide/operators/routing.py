"""Send the records of one input to several outputs, and several inputs to one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def route(df: DataFrame, predicates: dict[str, Column]) -> dict[str, DataFrame]:
    """One DataFrame per tag. A record may satisfy several predicates and then goes to each."""
    return {tag: df.where(F.coalesce(p, F.lit(False))) for tag, p in predicates.items()}


def tag_routes(df: DataFrame, predicates: dict[str, Column], tag: str = "route") -> DataFrame:
    """All routes in one pass: one row per record and satisfied predicate, with its tag.

    For a sink that is partitioned by the tag, where one scan must feed every output.
    """
    tags = F.array(*[F.when(p, F.lit(name)) for name, p in predicates.items()])
    return df.withColumn(tag, F.explode(F.array_compact(tags)))


def union_sources(*sources: DataFrame) -> DataFrame:
    """Several topics or file sets read as one input."""
    return reduce(lambda a, b: a.unionByName(b), sources)
