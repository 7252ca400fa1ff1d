"""The training-data pipeline: quality rules, near-dedup, substring dedup, decontamination, packing."""

from __future__ import annotations

from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ordertide.llm import quality_rules, suffix_dedup
from ordertide.llm.decontamination import clean_documents
from ordertide.llm.near_dedup import without_near_duplicates
from ordertide.llm.packing import pack_documents
from ordertide.llm.queries import table
from ordertide.session import recorded_scratch, remove_scratch, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Work tables of the latest stage of this thread's pipeline.
_spent: ContextVar[tuple[str, ...]] = ContextVar("spent", default=())


def _stage(first: bool = False, last: bool = False) -> Callable[[Stage], Stage]:
    """A stage that removes the work tables of the one before it, whose result is written by then.

    The first stage removes nothing, and the last one's tables stay, as the caller still reads them.
    """

    def wrap(fn: Stage) -> Stage:
        @wraps(fn)
        def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            if not first:
                remove_scratch(spark, _spent.get())
            with recorded_scratch() as paths:
                result = fn(spark, docs, sf_dir)
            _spent.set(() if last else tuple(paths))
            return result

        return staged

    return wrap


@_stage(first=True)
def ngram_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the perplexity bands keep."""
    return quality_rules.kept_documents(docs)


@_stage()
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the least id, of each component of near-duplicates."""
    return without_near_duplicates(docs)


@_stage()
def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes of their strings that start elsewhere too; n_chars follows."""
    return suffix_dedup.without_repeats(docs)


@_stage()
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty is in a window of the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


@_stage(last=True)
def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of what is left, with its sequence and place."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", ngram_quality),
    ("MinHash near-dedup", near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL cannot say what a language model or a tokenizer does; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over what its predecessor kept, written and read again between stages."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settle(docs, f"stage-{k}")
    return docs
