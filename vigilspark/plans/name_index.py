"""Search of a mart by part of a name, without reading all of it.

``write_index`` stores the mart clustered by the name, the distinct names, and for every three
neighbouring characters of a name (upper case) a posting.  A search takes the postings of the
pattern's own trigrams, keeps the names that have all of them and compares only those with the
pattern.  Few names become a filter that the scan of the clustered mart pushes down to its row
groups; many (beyond ``FEW``) are joined.  A pattern without three literal characters in a row is
compared with the distinct names.  The result is that of the plain search, wildcards included.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import contains_ci
from ..sources.tables import write_clustered
from .consumers import search_signals

GRAM = 3
FEW = 1000


def write_index(mart: DataFrame, path: str, column: str = "drug_name") -> None:
    spark = mart.sparkSession
    write_clustered(mart, f"{path}/mart", column)
    names = spark.read.parquet(f"{path}/mart").select(F.col(column).alias("name")).where("name IS NOT NULL").distinct()
    write_clustered(names, f"{path}/names", "name")
    name = F.upper("name")
    starts = F.when(F.length(name) >= GRAM, F.sequence(F.lit(1), F.length(name) - (GRAM - 1))).otherwise(F.array().cast("array<int>"))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substring(name, i, GRAM)))
    postings = spark.read.parquet(f"{path}/names").select(F.explode(grams).alias("gram"), "name")
    write_clustered(postings, f"{path}/postings", "gram", "name")


def pattern_grams(spark: SparkSession, pattern: str) -> list[str]:
    """Trigrams that every match must have: those of the pattern's parts between wildcards, in upper case as Spark writes it."""
    upper = spark.range(1).select(F.upper(F.lit(pattern))).first()[0]
    return sorted({p[i:i + GRAM] for p in re.split("[%_]", upper) for i in range(len(p) - GRAM + 1)})


def matching_names(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(name) of the distinct names that contain the pattern, in either case."""
    grams = pattern_grams(spark, pattern)
    if grams:
        postings = spark.read.parquet(f"{path}/postings").where(F.col("gram").isin(grams))
        names = postings.groupBy("name").agg(F.count("*").alias("n")).where(F.col("n") == len(grams)).select("name")
    else:
        names = spark.read.parquet(f"{path}/names")
    return names.where(contains_ci("name", pattern))


def rows_by_name(spark: SparkSession, path: str, pattern: str, column: str = "drug_name", few: int = FEW) -> DataFrame:
    """The mart's rows whose name contains the pattern."""
    names = matching_names(spark, path, pattern)
    first = [r["name"] for r in names.limit(few + 1).collect()]      # a bounded look
    mart = spark.read.parquet(f"{path}/mart")
    if len(first) <= few:
        return mart.where(F.col(column).isin(first))
    return mart.join(names.select(F.col("name").alias(column)), column, "left_semi").select(*mart.columns)


def signals_by_name(spark: SparkSession, path: str, drug_name: str, limit: int = 100) -> DataFrame:
    """``consumers.signals_by_name`` over an indexed signal mart."""
    return search_signals(rows_by_name(spark, path, drug_name), limit=limit)
