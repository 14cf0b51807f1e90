"""One query per operator, over its whole table, with its production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm import (
    byte_cnn,
    decontaminate,
    divergence,
    jaccard_join,
    mixing,
    nbsvm,
    periodic_runs,
    rule_ledger,
    semi_crf,
    suffix_dedup,
    token_files,
    topk_search,
    transcripts,
)
from daymark.llm.common import table
from daymark.llm.oracle import ORACLE_SQL  # noqa: F401

Query = Callable[[SparkSession, str], DataFrame]


def op1_semi_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semi_crf.personal_data(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_words", F.round("similarity", 9).alias("similarity"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixture(table(spark, sf_dir, "documents"))
    return rows.withColumns({c: F.round(c, 9) for c in ("weight", "exponent")})


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_cnn.identify(table(spark, sf_dir, "documents"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op8_transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.canonical(table(spark, sf_dir, "conversations"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(periodic_runs.planted(table(spark, sf_dir, "documents")))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ledger.quality_rules(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_semi_crf": op1_semi_crf,
    "op2_quality": op2_quality,
    "op3_decontaminate": op3_decontaminate,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_mixing": op5_mixing,
    "op6_language_id": op6_language_id,
    "op7_topk_search": op7_topk_search,
    "op8_transcripts": op8_transcripts,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_token_files": op10_token_files,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_quality_rules": op12_quality_rules,
    "op13_source_divergence": op13_source_divergence,
}
