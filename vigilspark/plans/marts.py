"""Pair and drug marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import risk_band
from ..schemas import HIGH_REPORTS, MEDIUM_REPORTS


def pair_report_counts(pairs: DataFrame) -> DataFrame:
    """Distinct reports per drug x reaction of a pair table, most frequent first.

    Repeats are removed first; counting the rest is then a plain count.
    """
    counts = (
        pairs.filter(F.col("report_id").isNotNull())
        .select("report_id", "drug_name", "reaction_term").distinct()
        .groupBy("drug_name", "reaction_term").agg(F.count("*").alias("report_count"))
    )
    return order_pairs(counts)


def order_pairs(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("report_count"), "drug_name", "reaction_term")


def drug_stats(drugs: DataFrame) -> DataFrame:
    """Reports and mean age per drug of the drug table.

    The mean runs over drug rows: a drug listed twice in a report weighs its
    age twice.  Ages are summed as decimals, so the result does not depend on
    the order of the rows.
    """
    return drugs.groupBy("drug_name").agg(
        F.countDistinct("report_id").alias("total_reports"),
        _mean(F.sum("patient_age"), F.count("patient_age")).alias("avg_age"))


def drug_totals(staged: DataFrame) -> DataFrame:
    """What the drug statistics of staged reports are made of: (drug_name, total_reports, age_sum, age_rows), all additive.

    One scan and one combined shuffle: each report sends a row per distinct drug (counted) and a row per
    listed drug (averaged).
    """
    listed = F.transform("drug_names", lambda n: F.struct(
        n.alias("drug_name"), F.lit(0).cast("long").alias("report")))
    distinct = F.transform(F.array_distinct("drug_names"), lambda n: F.struct(
        n.alias("drug_name"), F.lit(1).cast("long").alias("report")))
    rows = staged.select("patient_age", F.inline(F.concat(distinct, listed)))
    age = F.when(F.col("report") == 0, F.col("patient_age"))
    return rows.groupBy("drug_name").agg(
        F.sum("report").alias("total_reports"), F.sum(age).alias("age_sum"), F.count(age).alias("age_rows"))


def drug_stats_of_totals(totals: DataFrame) -> DataFrame:
    return totals.select("drug_name", "total_reports", _mean(F.col("age_sum"), F.col("age_rows")).alias("avg_age"))


def drug_stats_of_reports(staged: DataFrame) -> DataFrame:
    """Reports and mean age per drug, from staged reports."""
    return drug_stats_of_totals(drug_totals(staged))


def _mean(total: Column, n: Column) -> Column:
    return F.when(n > 0, total.cast("double") / n)


def summarise_drugs(stats: DataFrame, high: int = HIGH_REPORTS, medium: int = MEDIUM_REPORTS,
                    ordered: bool = True) -> DataFrame:
    """Drug mart: missing mean age shown as 0, and the risk band; ``ordered`` for display."""
    summary = stats.select(
        "drug_name", "total_reports", F.coalesce("avg_age", F.lit(0.0)).alias("avg_age"),
        risk_band(F.col("total_reports"), high, medium).alias("risk_level"))
    return summary.orderBy(F.desc("total_reports"), "drug_name") if ordered else summary


def drug_summary(drugs: DataFrame) -> DataFrame:
    return summarise_drugs(drug_stats(drugs))
