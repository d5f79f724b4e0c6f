"""Data-quality queries: single rules and the declared suite."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..plans import reports as R
from ..plans.signals import risk_signals_of_reports
from ..session import scratch_path
from . import query
from .bindings import DOC_CHILDREN_SQL, DOCS_SQL, MARTS_SQL, raw, table
from .documents import REPORT_SQL, staged

STG = f"WITH {DOCS_SQL}"
AS_OF = "2001-09-11 06:00:00"


@query("dq_not_null", f"{STG} SELECT report_id, source_file FROM (SELECT {REPORT_SQL} FROM stg) WHERE received_date IS NULL")
def dq_not_null(spark, sf_dir):
    return Q.dq_not_null(staged(spark, sf_dir), "received_date").select("report_id", "source_file")


@query("dq_unique", f"""{STG} SELECT report_id, count(*) AS n_records FROM typed
  WHERE report_id IS NOT NULL AND loaded_at > '1900-01-01' GROUP BY report_id HAVING count(*) > 1""")
def dq_unique(spark, sf_dir):
    """Report ids that were loaded in more than one version."""
    return Q.dq_unique(R.extract_report(raw(spark, sf_dir)), "report_id", Q.LOADED)


@query("dq_accepted_values", f"{STG} SELECT report_id, patient_sex FROM stg WHERE patient_sex NOT IN (0, 1)")
def dq_accepted_values(spark, sf_dir):
    return Q.dq_accepted(staged(spark, sf_dir), "patient_sex", [0, 1]).select("report_id", "patient_sex")


@query("dq_relationships", """SELECT o_custkey, count(*) AS n_records FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
  GROUP BY o_custkey""")
def dq_relationships(spark, sf_dir):
    """Orders whose customer is not among the customers outside one segment."""
    parents = table(spark, sf_dir, "customer").filter("c_mktsegment <> 'MACHINERY'")
    return Q.dq_rel(table(spark, sf_dir, "orders"), "o_custkey", parents, "c_custkey")


@query("dq_expression", f"{STG} SELECT report_id, patient_age FROM stg WHERE NOT (patient_age BETWEEN 0 AND 120)")
def dq_expression(spark, sf_dir):
    return Q.dq_expr(staged(spark, sf_dir), "patient_age", "BETWEEN 0 AND 120").select(
        "report_id", F.col("patient_age").cast("double"))


@query("dq_not_negative", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0")
def dq_not_negative(spark, sf_dir):
    return Q.dq_not_negative(table(spark, sf_dir, "customer"), "c_acctbal").select("c_custkey", "c_acctbal")


@query("dq_freshness", """SELECT *, CASE WHEN age_hours > 48 THEN 'ERROR' WHEN age_hours > 24 THEN 'WARN'
  ELSE 'PASS' END AS status FROM (
  SELECT event_type, (epoch_us(TIMESTAMP '2024-02-01 12:00:00') - epoch_us(max(ts))) / 3600000000 AS age_hours
  FROM events GROUP BY event_type)""")
def dq_freshness(spark, sf_dir):
    """Freshness of each kind of event, from one scan."""
    return Q.dq_fresh(table(spark, sf_dir, "events"), "ts", as_of="2024-02-01 12:00:00", by=("event_type",)).drop("max_loaded_at")


def _rule_sql(rule: Q.Rule) -> str:
    """One declared rule as SQL over the tables of SUITE_TABLES."""
    t, c = rule.table, rule.column
    if rule.kind == "not_null":
        failures = f"SELECT count(*) FROM {t} WHERE {c} IS NULL"
    elif rule.kind == "unique":
        failures = f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
    elif rule.kind == "relationships":
        failures = f"SELECT count(*) FROM {t} WHERE {c} NOT IN (SELECT {rule.parent[1]} FROM {rule.parent[0]})"
    elif rule.kind == "not_negative":
        failures = f"SELECT count(*) FROM {t} WHERE {c} < 0"
    elif rule.kind == "expression":
        bound = ">= 50" if c == "report_count" else "BETWEEN 0 AND 120"
        failures = f"SELECT count(*) FROM {t} WHERE NOT ({c} {bound})"
    else:
        allowed = {
            "file_status": "'PENDING', 'PROCESSED'", "patient_sex": "0, 1, 2",
            "drug_characterization": "1, 2, 3", "signal_strength": "'HIGH', 'ELEVATED', 'BASELINE'",
        }[c]
        failures = f"SELECT count(*) FROM {t} WHERE {c} NOT IN ({allowed})"
    return (f"SELECT '{rule.kind}' AS rule, '{t}' AS table_name, '{c}' AS column_name, "
            f"({failures}) AS failures")


SUITE_SQL = f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}, {MARTS_SQL},
raw AS (SELECT doc_key AS file_id, file_name, loaded_at AS ingestion_timestamp, 1 AS raw_json,
               'PROCESSED' AS file_status FROM docs),
reports AS (SELECT {REPORT_SQL} FROM stg),
report_drugs AS (SELECT *, report_id || '-' || drug_sequence AS report_drug_id FROM drg),
report_reactions AS (SELECT *, report_id || '-react-' || reaction_sequence AS report_reaction_id FROM rct),
pairs AS (SELECT *, report_id || '-' || report_drug_id || '-' || report_reaction_id AS drug_reaction_pair_id
          FROM allpairs),
signals AS (SELECT * FROM sig),
results AS ({' UNION ALL '.join(_rule_sql(r) for r in Q.RULES)}),
age AS (SELECT (epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(max(ingestion_timestamp))) / 3600000000 AS h FROM raw)
SELECT *, CASE WHEN failures > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM results
UNION ALL
SELECT 'freshness', 'raw', 'ingestion_timestamp', CASE WHEN h <= 24 THEN 0 ELSE 1 END,
  CASE WHEN h > 48 THEN 'ERROR' WHEN h > 24 THEN 'WARN' ELSE 'PASS' END FROM age"""


@query("dq_suite", SUITE_SQL)
def dq_suite(spark, sf_dir):
    """All rules over stored tables; the row-local ones are counted while the tables are written."""
    tables, counted = {}, {}

    def kept(name, df):
        path = scratch_path(spark, name)
        counted[name] = Q.write_checked(df, path, name)
        tables[name] = spark.read.schema(df.schema).parquet(path)
        return tables[name]

    reports = kept("reports", R.stage_reports(kept("raw", raw(spark, sf_dir))))
    kept("report_drugs", R.report_drugs(reports))
    kept("report_reactions", R.report_reactions(reports))
    kept("pairs", R.pairs_of_reports(reports))
    kept("signals", risk_signals_of_reports(reports))
    return Q.dq_suite(tables, as_of=AS_OF, counted=counted)
