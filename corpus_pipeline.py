"""A training corpus from raw documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it has kept.
``run`` writes what a stage returns as Parquet to the shared folder and reads it again for
the next one; so no stage is computed twice, and a lost executor costs one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm import byte_cnn, decontaminate, jaccard_join, mixing, token_files
from daymark.llm.common import stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Below this share of the best language a document is no text in a known language.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels know; the others go."""
    model = byte_cnn.train(docs, byte_cnn.fold("doc_id", 3) != 1)
    rows = byte_cnn.predict(docs.select(*COLUMNS), model)
    known = (F.col("lang_pred") != byte_cnn.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return rows.where(known).select(*COLUMNS)


def jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.one_of_each(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item in them."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, and those of small sources as often as their weight says."""
    return mixing.mixed_documents(docs).select(*COLUMNS)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, and per document of the mixture what they hold."""
    return token_files.token_files(docs)


STAGES = [
    ("language_id", language_id),
    ("jaccard_join", jaccard),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("token_files", token_output),
]
#: A trained network and a tokenizer have no SQL; the stages are tested one by one instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
