"""A corpus pipeline of five stages, each calling one operator.

``run`` applies the stages to ``documents``; every stage is written as Parquet in the shared
folder and read again as the next one's input.  All but the last return the input's columns.
A stage keeps extra columns as they are, works on empty tables, and treats a null text as an
empty one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vigilspark.llm import crf_pii, piece_sampling, quality_ftrl, simhash_trie, winnowing
from vigilspark.llm.tables import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored at the threshold or above."""
    model = quality_ftrl.train(docs, table(spark, sf_dir, "labels"))
    return quality_ftrl.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: that with the smallest doc_id, one row of it."""
    return simhash_trie.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return winnowing.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked."""
    return crf_pii.mask(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their sampled piece ids; the text is what the ids spell."""
    return piece_sampling.encode(docs, spell=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("pieces", pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
