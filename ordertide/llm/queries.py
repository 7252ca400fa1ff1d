"""One query per operator over its whole table, and the SQL it must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordertide.llm.binary_output import token_shards_round_trip
from ordertide.llm.centroids import cluster_report
from ordertide.llm.decontamination import contamination
from ordertide.llm.hidden_markov import likelihood_report
from ordertide.llm.html_text import extraction_report
from ordertide.llm.near_dedup import near_duplicate_report
from ordertide.llm.oracles import ORACLES as ORACLES
from ordertide.llm.packing import pack_documents
from ordertide.llm.paragraph_dedup import paragraph_report
from ordertide.llm.quality_classifier import classifier_report
from ordertide.llm.quality_rules import quality_report
from ordertide.llm.suffix_dedup import repeat_report
from ordertide.llm.token_alignment import alignment_report
from ordertide.llm.url_filter import url_report


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_paragraph_minhash(spark, sf_dir):
    return paragraph_report(table(spark, sf_dir, "documents"))


def op2_chosen_path_join(spark, sf_dir):
    return near_duplicate_report(table(spark, sf_dir, "documents"))


def op3_ngram_perplexity(spark, sf_dir):
    return quality_report(table(spark, sf_dir, "documents"))


def op4_tree_scoring(spark, sf_dir):
    return extraction_report(table(spark, sf_dir, "pages"))


def op5_host_segmentation(spark, sf_dir):
    return url_report(table(spark, sf_dir, "pages"))


def op6_best_fit_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_hash_suffix_sort(spark, sf_dir):
    return repeat_report(table(spark, sf_dir, "documents"))


def op8_bit_plane_output(spark, sf_dir):
    return token_shards_round_trip(table(spark, sf_dir, "documents"))


def op9_weak_label_classifier(spark, sf_dir):
    return classifier_report(table(spark, sf_dir, "documents"))


def op10_positional_index(spark, sf_dir):
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_hidden_markov(spark, sf_dir):
    return likelihood_report(table(spark, sf_dir, "documents"))


def op12_run_skipping(spark, sf_dir):
    return alignment_report(table(spark, sf_dir, "documents"))


def op13_centroid_expressions(spark, sf_dir):
    return cluster_report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_paragraph_minhash": op1_paragraph_minhash,
    "op2_chosen_path_join": op2_chosen_path_join,
    "op3_ngram_perplexity": op3_ngram_perplexity,
    "op4_tree_scoring": op4_tree_scoring,
    "op5_host_segmentation": op5_host_segmentation,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_hash_suffix_sort": op7_hash_suffix_sort,
    "op8_bit_plane_output": op8_bit_plane_output,
    "op9_weak_label_classifier": op9_weak_label_classifier,
    "op10_positional_index": op10_positional_index,
    "op11_hidden_markov": op11_hidden_markov,
    "op12_run_skipping": op12_run_skipping,
    "op13_centroid_expressions": op13_centroid_expressions,
}
