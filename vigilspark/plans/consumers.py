"""Queries users run on the marts.  All stay lazy and push their filters into the plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import all_of, at_least, contains_ci, equals_ci, in_band
from ..functions.scalars import round_display
from ..schemas import SEARCH_COLUMNS


def signals_topk(signals: DataFrame, limit: int = 100, nulls_first: bool = True) -> DataFrame:
    """Highest PRR first; an unknown PRR sorts first unless told otherwise."""
    if not 1 <= limit <= 1000:
        raise ValueError("limit must lie between 1 and 1000")
    prr = F.desc_nulls_first("prr") if nulls_first else F.desc_nulls_last("prr")
    return signals.orderBy(prr, "drug_name", "reaction_term").limit(limit)


def search_signals(signals: DataFrame, drug_name: str | None = None,
                   signal_strength: str | None = None, min_reports: int = 0, limit: int = 100,
                   nulls_first: bool = True) -> DataFrame:
    """Signals by part of a drug name, band and minimum reports; every filter is optional."""
    if min_reports < 0:
        raise ValueError("min_reports must not be negative")
    wanted = all_of(
        contains_ci("drug_name", drug_name) if drug_name else None,
        equals_ci("signal_strength", signal_strength) if signal_strength else None,
        at_least("report_count", min_reports),
    )
    found = signals.filter(wanted).withColumn(
        "is_significant_signal", F.col("is_significant_signal").cast("boolean"))
    return signals_topk(found.select(*SEARCH_COLUMNS), limit, nulls_first)


def signals_by_name(signals: DataFrame, drug_name: str, limit: int = 100) -> DataFrame:
    return search_signals(signals, drug_name=drug_name, limit=limit)


def signals_by_strength(signals: DataFrame, signal_strength: str, limit: int = 100) -> DataFrame:
    return search_signals(signals, signal_strength=signal_strength, limit=limit)


def signal_summary(signals: DataFrame) -> DataFrame:
    """One row of five numbers, zeros for an empty table."""
    return signals.agg(
        F.count("*").alias("total_pairs"),
        F.count_if(F.col("signal_strength") == "HIGH").alias("high_signals"),
        F.count_if(F.col("signal_strength") == "ELEVATED").alias("elevated_signals"),
        F.coalesce(F.sum("report_count"), F.lit(0)).alias("total_reports"),
        F.countDistinct("drug_name").alias("unique_drugs"),
    )


def filter_min_reports(df: DataFrame, n: int, col: str = "total_reports") -> DataFrame:
    return df.filter(all_of(at_least(col, n)))


def filter_risk_level(df: DataFrame, level: str = "All") -> DataFrame:
    return df.filter(all_of(in_band("risk_level", level)))


def selected_drugs(summary: DataFrame, level: str = "All", min_reports: int = 0) -> DataFrame:
    return filter_risk_level(filter_min_reports(summary, min_reports), level)


def drug_list(summary: DataFrame, level: str = "All", min_reports: int = 0) -> DataFrame:
    """Drug table as shown: mean age to one digit."""
    return selected_drugs(summary, level, min_reports).select(
        "drug_name", "total_reports", round_display(F.col("avg_age")).alias("avg_age"), "risk_level"
    ).orderBy(F.desc("total_reports"), "drug_name")


def dashboard_kpis(summary: DataFrame, level: str = "All", min_reports: int = 0) -> DataFrame:
    """Drugs, reports, mean of the drugs' mean ages, drugs in the chosen band; zeros when empty."""
    chosen = selected_drugs(summary, level, min_reports)
    in_level = F.count("*") if level == "All" else F.count_if(F.col("risk_level") == level)
    return chosen.agg(
        F.count("*").alias("total_drugs"),
        F.coalesce(F.sum("total_reports"), F.lit(0)).alias("total_reports"),
        F.coalesce(round_display(F.avg("avg_age")), F.lit(0.0)).alias("avg_age"),
        in_level.alias("risk_count"),
    )


def top_drugs(summary: DataFrame, k: int = 10) -> DataFrame:
    return summary.orderBy(F.desc("total_reports"), "drug_name").limit(k)


def _ranked_pairs(pairs: DataFrame, k: int) -> DataFrame:
    return pairs.orderBy(F.desc("report_count"), "drug_name", "reaction_term").limit(k)


def top_pairs(pairs: DataFrame, k: int = 30, show: int = 15) -> DataFrame:
    """The ``show`` most frequent of the ``k`` most frequent pairs."""
    return _ranked_pairs(pairs, min(k, show))


def semi_join_risk_drugs(pairs: DataFrame, drugs: DataFrame) -> DataFrame:
    """Pairs whose drug is in the given drug list; the drug without a name is one of them."""
    chosen = drugs.select(F.col("drug_name").alias("_chosen"))
    return pairs.join(chosen, F.col("drug_name").eqNullSafe(F.col("_chosen")), "left_semi")


def top_pairs_in_band(pairs: DataFrame, summary: DataFrame, level: str = "All", min_reports: int = 0,
                      k: int = 50, show: int = 15) -> DataFrame:
    """Top ``k`` pairs first, of these the drugs of the band, of these the first ``show``."""
    top = _ranked_pairs(pairs, k)
    if level != "All":
        top = semi_join_risk_drugs(top, selected_drugs(summary, level, min_reports))
    return _ranked_pairs(top, show)


# --- patient-risk table ----------------------------------------------------


def patient_kpis(patients: DataFrame) -> DataFrame:
    """Patients, high-risk patients and mean age in one pass."""
    return patients.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("risk_level") == "HIGH_RISK").alias("high_risk"),
        round_display(F.avg(F.col("age").cast("double"))).alias("avg_age"),
    )


def count_by_category(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col)


def filter_flag(patients: DataFrame) -> DataFrame:
    return patients.filter("high_risk_flag = 1")


def patient_top_scores(patients: DataFrame, k: int = 50) -> DataFrame:
    return patients.select(
        "patient_id", "age", "gender", "cancer_type", "risk_level", "pre_score"
    ).orderBy(F.desc_nulls_first("pre_score"), "patient_id").limit(k)


def patient_high_risk_top(patients: DataFrame, k: int = 20) -> DataFrame:
    return filter_flag(patients).select(
        "patient_id", "age", "gender", "cancer_type", "pre_score", "risk_factors_derived"
    ).orderBy(F.desc_nulls_first("pre_score"), "patient_id").limit(k)
