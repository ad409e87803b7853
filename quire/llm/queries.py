"""The registered queries of the operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontaminate, filter_audit, html_extract, language_id, license_scan, line_quality, merkle_manifest, mixing, near_dedup, quality_ranker, quote_threads, token_store, toxicity
from quire.llm._common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ranker.rank_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_tokens(table(spark, sf_dir, "documents"))


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), near_dedup.Near(shingle=2))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_threads.quote_threads(table(spark, sf_dir, "conversations"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_html_extraction, op2_quality_rules, op3_decontamination, op4_mixing, op5_quality_classifier, op6_token_output, op7_minhash_dedup, op8_language_id, op9_toxicity, op10_chat_formatting, op11_merkle_manifest, op12_filter_audit, op13_license_scan)}


def oracle_sql() -> dict[str, str]:
    """The other operators learn, draw, hash or write; tests hold them against brute force, held-out rows or round trips."""
    return {"op2_quality_rules": line_quality.ORACLE_SQL, "op3_decontamination": decontaminate.ORACLE_SQL, "op10_chat_formatting": quote_threads.ORACLE_SQL, "op11_merkle_manifest": merkle_manifest.ORACLE_SQL, "op12_filter_audit": filter_audit.ORACLE_SQL, "op13_license_scan": license_scan.oracle_sql()}
