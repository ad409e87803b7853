"""From raw documents to token files: quality, near copies, benchmark passages, mixing, tokens.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read back as the
next one's docs. All but the last return the columns of documents.

Defined cases: an empty table passes through as one; rows of null text are texts without words;
columns beyond those of documents are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, mixing, near_dedup, quality_ranker, token_store
from quire.llm._common import cut, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_ranker.good_rows(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one of the smallest id. Shingles of five words, similarity 0.8 or more."""
    return near_dedup.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).filter("contaminated").select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(F.col("_found")), "left_anti")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are there as often as the mix takes their words."""
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and their digest by document."""
    return token_store.store_tokens(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixture),
    ("token_output", tokens),
]

#: A stage learns from labels, and others hash and draw: SQL can't express the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs
