"""Queries over a patient-risk table, seen in the customer table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans import consumers as C
from . import query
from .bindings import table

PATIENTS_SQL = """patients AS (
  SELECT cast(c_custkey AS VARCHAR) AS patient_id, cast(c_custkey % 90 AS INTEGER) AS age,
    CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender, c_mktsegment AS cancer_type,
    CASE WHEN c_acctbal > 7000 THEN 'HIGH_RISK' WHEN c_acctbal > 3000 THEN 'MEDIUM_RISK'
         ELSE 'LOW_RISK' END AS risk_level,
    c_acctbal AS pre_score, CASE WHEN c_acctbal > 7000 THEN 1 ELSE 0 END AS high_risk_flag,
    'nation-' || c_nationkey AS risk_factors_derived
  FROM customer)"""
SCORE_ORDER = "ORDER BY pre_score DESC NULLS FIRST, patient_id"


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey AS string) AS patient_id", "cast(c_custkey % 90 AS int) AS age",
        "if(c_custkey % 2 = 0, 'F', 'M') AS gender", "c_mktsegment AS cancer_type",
        "CASE WHEN c_acctbal > 7000 THEN 'HIGH_RISK' WHEN c_acctbal > 3000 THEN 'MEDIUM_RISK' "
        "ELSE 'LOW_RISK' END AS risk_level",
        "c_acctbal AS pre_score", "if(c_acctbal > 7000, 1, 0) AS high_risk_flag",
        "concat('nation-', c_nationkey) AS risk_factors_derived")


@query("patient_kpis", f"""WITH {PATIENTS_SQL} SELECT count(*) AS total,
  count(*) FILTER (WHERE risk_level = 'HIGH_RISK') AS high_risk, round(avg(age::DOUBLE), 1) AS avg_age
  FROM patients""")
def patient_kpis(spark, sf_dir):
    return C.patient_kpis(patients(spark, sf_dir))


@query("count_by_category", f"WITH {PATIENTS_SQL} SELECT cancer_type, count(*) AS n FROM patients GROUP BY 1")
def count_by_cancer_type(spark, sf_dir):
    return C.count_by_category(patients(spark, sf_dir), "cancer_type")


@query("count_by_risk_level", f"WITH {PATIENTS_SQL} SELECT risk_level, count(*) AS n FROM patients GROUP BY 1")
def count_by_risk_level(spark, sf_dir):
    return C.count_by_category(patients(spark, sf_dir), "risk_level")


@query("filter_flag", f"WITH {PATIENTS_SQL} SELECT * FROM patients WHERE high_risk_flag = 1")
def filter_flag(spark, sf_dir):
    return C.filter_flag(patients(spark, sf_dir))


@query("patient_top_scores", f"""WITH {PATIENTS_SQL} SELECT patient_id, age, gender, cancer_type,
  risk_level, pre_score FROM patients {SCORE_ORDER} LIMIT 50""")
def patient_top_scores(spark, sf_dir):
    return C.patient_top_scores(patients(spark, sf_dir))


@query("patient_high_risk_top", f"""WITH {PATIENTS_SQL} SELECT patient_id, age, gender, cancer_type,
  pre_score, risk_factors_derived FROM patients WHERE high_risk_flag = 1 {SCORE_ORDER} LIMIT 20""")
def patient_high_risk_top(spark, sf_dir):
    return C.patient_high_risk_top(patients(spark, sf_dir))
