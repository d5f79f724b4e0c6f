"""Queries over the pair and drug marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import risk_band
from ..operators.tally import pair_counts
from ..plans import consumers as C
from ..plans import marts as M
from ..session import pin
from . import query
from .bindings import (
    DRUG, MARTS_SQL, REACTION, SPARSE_DRUG, SUMMARY_SQL, TAILED_DRUG, children_sql, drugs, line_pairs, reactions,
)
from .signals import PLAIN, tally

TAILED = f"WITH {children_sql(TAILED_DRUG)}, {SUMMARY_SQL}"
TAILED_PAIRS = f"WITH {children_sql(TAILED_DRUG)}, {SUMMARY_SQL}, {MARTS_SQL}"
PAIR_ORDER = "ORDER BY report_count DESC, drug_name NULLS FIRST, reaction_term"
DRUG_ORDER = "ORDER BY total_reports DESC, drug_name NULLS FIRST"


def summary(spark: SparkSession, sf_dir: str, drug: str = TAILED_DRUG) -> DataFrame:
    return M.drug_summary(drugs(spark, sf_dir, drug))


def pairs(spark: SparkSession, sf_dir: str, drug: str = DRUG, reaction: str = REACTION) -> DataFrame:
    return pair_counts(tally(spark, sf_dir, drug, reaction))


@query("pair_report_counts", f"{PLAIN} SELECT drug_name, reaction_term, report_count FROM pc")
def pair_report_counts(spark, sf_dir):
    return M.order_pairs(pairs(spark, sf_dir))


@query("drug_stats", f"{TAILED} SELECT drug_name, total_reports, avg_age FROM stats")
def drug_stats(spark, sf_dir):
    return M.drug_stats(drugs(spark, sf_dir, TAILED_DRUG))


@query("drug_summary", f"{TAILED} SELECT drug_name, total_reports, avg_age, risk_level FROM summary")
def drug_summary(spark, sf_dir):
    return summary(spark, sf_dir)


@query("risk_band", f"{TAILED} SELECT risk_level, count(*) AS n FROM summary GROUP BY 1")
def bands(spark, sf_dir):
    stats = M.drug_stats(drugs(spark, sf_dir, TAILED_DRUG))
    return stats.groupBy(risk_band(F.col("total_reports")).alias("risk_level")).agg(
        F.count("*").alias("n"))


@query("filter_risk_level", f"{TAILED} SELECT * FROM summary WHERE risk_level = 'MEDIUM'")
def filter_risk_level(spark, sf_dir):
    return C.filter_risk_level(summary(spark, sf_dir), "MEDIUM")


@query("drug_list", f"""{TAILED} SELECT drug_name, total_reports, round(avg_age, 1) AS avg_age, risk_level
  FROM summary WHERE total_reports >= 25 AND risk_level = 'MEDIUM'""")
def drug_list(spark, sf_dir):
    return C.drug_list(summary(spark, sf_dir), "MEDIUM", 25)


@query("dashboard_kpis", f"""{TAILED} SELECT count(*) AS total_drugs,
  cast(coalesce(sum(total_reports), 0) AS BIGINT) AS total_reports,
  coalesce(round(avg(avg_age), 1), 0.0) AS avg_age, count(*) AS risk_count
  FROM summary WHERE total_reports >= 5""")
def dashboard_kpis(spark, sf_dir):
    return C.dashboard_kpis(summary(spark, sf_dir), "All", 5)


@query("dashboard_kpis_in_band", f"""{TAILED} SELECT count(*) AS total_drugs,
  cast(coalesce(sum(total_reports), 0) AS BIGINT) AS total_reports,
  coalesce(round(avg(avg_age), 1), 0.0) AS avg_age, count(*) AS risk_count
  FROM summary WHERE risk_level = 'LOW'""")
def dashboard_kpis_in_band(spark, sf_dir):
    return C.dashboard_kpis(summary(spark, sf_dir), "LOW")


@query("top_drugs", f"{TAILED} SELECT * FROM summary {DRUG_ORDER} LIMIT 10")
def top_drugs(spark, sf_dir):
    return C.top_drugs(summary(spark, sf_dir))


@query("top_pairs", f"""{PLAIN} SELECT * FROM (SELECT drug_name, reaction_term, report_count FROM pc
  {PAIR_ORDER} LIMIT 30) {PAIR_ORDER} LIMIT 15""")
def top_pairs(spark, sf_dir):
    return C.top_pairs(pairs(spark, sf_dir))


@query("semi_join_risk_drugs", f"""{TAILED_PAIRS} SELECT drug_name, reaction_term, report_count FROM pc
  WHERE EXISTS (SELECT 1 FROM summary s WHERE risk_level = 'HIGH' AND s.drug_name IS NOT DISTINCT FROM pc.drug_name)""")
def semi_join_risk_drugs(spark, sf_dir):
    chosen = C.filter_risk_level(summary(spark, sf_dir), "HIGH")
    return C.semi_join_risk_drugs(pairs(spark, sf_dir, TAILED_DRUG), chosen)


@query("top_pairs_in_band", f"""{TAILED_PAIRS}, top AS (SELECT drug_name, reaction_term, report_count
  FROM pc {PAIR_ORDER} LIMIT 50)
  SELECT * FROM top WHERE EXISTS (SELECT 1 FROM summary s
    WHERE risk_level = 'HIGH' AND total_reports >= 60 AND s.drug_name IS NOT DISTINCT FROM top.drug_name)
  {PAIR_ORDER} LIMIT 15""")
def top_pairs_in_band(spark, sf_dir):
    counts = pin(pairs(spark, sf_dir, TAILED_DRUG))
    return C.top_pairs_in_band(counts, summary(spark, sf_dir), "HIGH", 60)


SPARSE = f"WITH {children_sql(SPARSE_DRUG)}, {SUMMARY_SQL}, {MARTS_SQL}"


@query("top_pairs_in_band_unnamed", f"""{SPARSE}, top AS (SELECT drug_name, reaction_term, report_count
  FROM pc {PAIR_ORDER} LIMIT 50)
  SELECT * FROM top WHERE EXISTS (SELECT 1 FROM summary s
    WHERE risk_level = 'HIGH' AND s.drug_name IS NOT DISTINCT FROM top.drug_name) {PAIR_ORDER} LIMIT 15""")
def top_pairs_in_band_unnamed(spark, sf_dir):
    """A brand's drugs have no name: their group is kept like any other."""
    counts = pin(pairs(spark, sf_dir, SPARSE_DRUG))
    return C.top_pairs_in_band(counts, summary(spark, sf_dir, SPARSE_DRUG), "HIGH")


@query("pair_report_counts_of_pairs", f"{PLAIN} SELECT drug_name, reaction_term, report_count FROM pc")
def pair_report_counts_of_pairs(spark, sf_dir):
    """The pair mart from a stored pair table (one row per report, drug and reaction, with repeats)."""
    return M.pair_report_counts(line_pairs(spark, sf_dir))
