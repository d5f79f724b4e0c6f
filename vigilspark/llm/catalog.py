"""Registered queries of the operators over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (crf_pii, license_notices, piece_sampling, pitman_yor, prefix_trie, quality_ftrl, repeat_columns, rule_ledger,
               secret_automata, simhash_trie, toxicity, whitening, winnowing)
from .tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_pii.find(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.encode(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_key")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ledger.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_upper", "failures")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_columns.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_automata.find(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_ftrl.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_notices.license_labels(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(table(spark, sf_dir, "embeddings"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.report(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_pii, op2_sentencepiece, op3_decontamination, op4_quality_rules, op5_simhash, op6_toxicity, op7_suffix_dedup, op8_secrets, op9_quality,
    op10_licenses, op11_whitening, op12_lm_scoring, op13_prefix_trie)}
ORACLES = {"op3_decontamination": winnowing.SQL, "op4_quality_rules": rule_ledger.SQL, "op13_prefix_trie": prefix_trie.SQL}
