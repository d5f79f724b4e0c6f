"""The driver's tables seen as safety reports.

Relational views: a report is an order, its drugs and reactions come from its
lines (drug = part name, reaction = part size).  Document view: each order is
one or two versions of a JSON report with up to three drugs and reactions, built
so that every branch of the extraction occurs.  ``*_SQL`` constants are the same
views for the SQL side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semistructured import parse


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- relational views --------------------------------------------------------

DRUG, REACTION = "p_name", "cast(p_size AS string)"
# no name for one brand; one drug has a reaction of its own
SPARSE_DRUG = "CASE WHEN p_brand <> 'Brand#1' THEN p_name END"
SPARSE_REACTION = "CASE WHEN p_name = 'blue anvil' THEN 'only-anvil' ELSE cast(p_size AS string) END"
# a few frequent and many rare names
TAILED_DRUG = "CASE WHEN p_size <= 25 THEN p_name ELSE cast(p_partkey AS string) END"


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("report_id"))


BROADCAST_PARTS = 1_000_000      # rows; the copy that is broadcast is built in the driver's memory


def line_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their part.  Spark would broadcast parts by the size of their files, a few bytes a row: beyond
    ``BROADCAST_PARTS`` rows (the file footers know their number) they are joined by sorting, and none reach the driver.
    """
    parts = table(spark, sf_dir, "part")
    if parts.count() > BROADCAST_PARTS:
        parts = parts.hint("merge")
    return table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))


def drugs(spark: SparkSession, sf_dir: str, name: str = DRUG) -> DataFrame:
    return line_parts(spark, sf_dir).select(
        F.col("l_orderkey").alias("report_id"), F.expr(name).alias("drug_name"),
        F.expr("cast(l_orderkey % 100 AS decimal(5,2))").alias("patient_age"))


def reactions(spark: SparkSession, sf_dir: str, term: str = REACTION) -> DataFrame:
    return line_parts(spark, sf_dir).select(
        F.col("l_orderkey").alias("report_id"), F.expr(term).alias("reaction_term"))


LINES_PER_TASK = 100_000


def line_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(report_id, drug_name, reaction_term)``: every drug line with every reaction line of its report, repeats included.

    Both sides are dealt out by report into partitions that grow in number with the lines.  What follows is grouped
    inside reports and needs no further shuffle.
    """
    n = tasks_for(table(spark, sf_dir, "lineitem"), LINES_PER_TASK)
    d = drugs(spark, sf_dir).select("report_id", "drug_name").repartition(n, "report_id")
    r = reactions(spark, sf_dir).repartition(n, "report_id")
    return d.join(r, "report_id").select("report_id", "drug_name", "reaction_term")


def children_sql(drug: str = DRUG, reaction: str = REACTION) -> str:
    """CTEs ``rep``, ``drg``, ``rct`` and ``prs`` (distinct report x drug x reaction)."""
    return f"""
rep AS (SELECT o_orderkey AS report_id FROM orders),
drg AS (SELECT l_orderkey AS report_id, {drug} AS drug_name, l_orderkey % 100 AS patient_age
        FROM lineitem JOIN part ON l_partkey = p_partkey),
rct AS (SELECT l_orderkey AS report_id, {reaction} AS reaction_term
        FROM lineitem JOIN part ON l_partkey = p_partkey),
prs AS (SELECT d.report_id, drug_name, reaction_term
        FROM (SELECT DISTINCT report_id, drug_name FROM drg) d
        JOIN (SELECT DISTINCT report_id, reaction_term FROM rct WHERE reaction_term IS NOT NULL) r
          ON d.report_id = r.report_id)"""


# marts over any CTEs named rep(report_id) and prs(report_id, drug_name, reaction_term)
MARTS_SQL = """
pc AS (SELECT drug_name, reaction_term, count(DISTINCT report_id) AS report_count
       FROM prs GROUP BY drug_name, reaction_term),
dc AS (SELECT drug_name, count(DISTINCT report_id) AS reports_with_drug FROM prs GROUP BY drug_name),
rc AS (SELECT reaction_term, count(DISTINCT report_id) AS reports_with_reaction
       FROM prs GROUP BY reaction_term),
tr AS (SELECT count(DISTINCT report_id) AS total_report_count FROM rep),
cells AS (
  SELECT pc.drug_name, pc.reaction_term, report_count,
         reports_with_drug - report_count AS b_count,
         reports_with_reaction - report_count AS c_count,
         total_report_count - reports_with_drug - reports_with_reaction + report_count AS d_count
  FROM pc JOIN dc ON pc.drug_name = dc.drug_name
          JOIN rc ON pc.reaction_term = rc.reaction_term CROSS JOIN tr),
metrics AS (
  SELECT *,
    CASE WHEN b_count > 0 AND c_count > 0 AND d_count > 0
         THEN (report_count::DOUBLE * d_count::DOUBLE) / (b_count::DOUBLE * c_count::DOUBLE) END AS ror,
    CASE WHEN report_count + b_count > 0 AND c_count + d_count > 0 AND c_count > 0
         THEN (report_count / (report_count + b_count)) / (c_count / (c_count + d_count)) END AS prr,
    CASE WHEN b_count > 0 AND c_count > 0 AND d_count > 0
         THEN (report_count / b_count) / (c_count / d_count) END AS ror_simple
  FROM cells),
sig AS (
  SELECT *,
    CASE WHEN prr > 2.0 THEN 'HIGH' WHEN prr > 1.0 THEN 'ELEVATED' ELSE 'BASELINE' END AS signal_strength,
    coalesce(prr > 2.0 AND report_count >= 50, false) AS is_significant_signal
  FROM metrics WHERE report_count >= 50)"""

# drug mart over a CTE drg(report_id, drug_name, patient_age)
SUMMARY_SQL = """
stats AS (SELECT drug_name, count(DISTINCT report_id) AS total_reports,
                 CASE WHEN count(patient_age) > 0
                      THEN sum(patient_age::DECIMAL(5,2))::DOUBLE / count(patient_age) END AS avg_age
          FROM drg GROUP BY drug_name),
summary AS (SELECT drug_name, total_reports, coalesce(avg_age, 0) AS avg_age,
                   CASE WHEN total_reports >= 50 THEN 'HIGH' WHEN total_reports >= 20 THEN 'MEDIUM'
                        ELSE 'LOW' END AS risk_level
            FROM stats)"""


# --- document view -----------------------------------------------------------

_DOSE = "cast((k % 100000) * 0.125BD AS decimal(12,3))"
_DRUGS = f"""
array(
  named_struct('drgname', p, 'medicinalproduct', concat('X', s),
    'medicinalproductname', cast(NULL AS string),
    'drgcode', cast(NULL AS array<struct<value:string,codingSystem:string>>),
    'activesubstancename', cast(NULL AS string), 'drugcharacterization', k % 3 + 1,
    'drugdosageform', concat('form-', k % 5), 'drugdosage', cast(NULL AS string),
    'drugadministrationroute', array(named_struct('routecode', concat('0', k % 7))),
    'drugauthorizationnumber', cast(NULL AS string),
    'drugindication', cast(NULL AS array<struct<value:string,codingSystem:string>>),
    'drugcumulativedose', array(named_struct('value', {_DOSE}, 'doseunit', 'mg')),
    'timeintervalunitofmeasure', cast(NULL AS string)),
  named_struct('drgname', cast(NULL AS string), 'medicinalproduct', concat('prod-', c % 40),
    'medicinalproductname', concat('long-', c % 40),
    'drgcode', array(named_struct('value', cast(c % 10 AS string), 'codingSystem', 'MPID')),
    'activesubstancename', concat('subst-', c % 5), 'drugcharacterization', 2L,
    'drugdosageform', cast(NULL AS string), 'drugdosage', concat('daily ', k % 3),
    'drugadministrationroute', cast(NULL AS array<struct<routecode:string>>),
    'drugauthorizationnumber', concat('A', c),
    'drugindication', array(named_struct('value', concat('ind-', c % 6), 'codingSystem', 'MedDRA')),
    'drugcumulativedose', cast(NULL AS array<struct<value:decimal(12,3),doseunit:string>>),
    'timeintervalunitofmeasure', '804'),
  named_struct('drgname', cast(NULL AS string), 'medicinalproduct', cast(NULL AS string),
    'medicinalproductname', CASE WHEN k div 4 % 2 = 1 THEN p END,
    'drgcode', cast(NULL AS array<struct<value:string,codingSystem:string>>),
    'activesubstancename', CASE WHEN k div 4 % 2 = 0 THEN concat('subst-', c % 5) END,
    'drugcharacterization', cast(NULL AS bigint),
    'drugdosageform', cast(NULL AS string), 'drugdosage', cast(NULL AS string),
    'drugadministrationroute', cast(NULL AS array<struct<routecode:string>>),
    'drugauthorizationnumber', cast(NULL AS string),
    'drugindication', cast(NULL AS array<struct<value:string,codingSystem:string>>),
    'drugcumulativedose', cast(NULL AS array<struct<value:decimal(12,3),doseunit:string>>),
    'timeintervalunitofmeasure', cast(NULL AS string)))"""
_REACTIONS = """
array(
  named_struct('reactionmeddraversionpt', '24.1', 'primarysourcereaction', cast(NULL AS string),
    'reactionmeddrapt', concat('rx-', k % 12), 'reactionmeddrallt', cast(NULL AS string),
    'reactionoutcome', array(named_struct('value', k % 6 + 1, 'codingSystem', 'E2B'))),
  named_struct('reactionmeddraversionpt', cast(NULL AS string),
    'primarysourcereaction', concat('src ', c % 3),
    'reactionmeddrapt', concat('rx-', c % 12), 'reactionmeddrallt', concat('llt-', k % 4),
    'reactionoutcome', cast(NULL AS array<struct<value:bigint,codingSystem:string>>)),
  named_struct('reactionmeddraversionpt', cast(NULL AS string),
    'primarysourcereaction', cast(NULL AS string),
    'reactionmeddrapt', cast(NULL AS string), 'reactionmeddrallt', concat('llt-', k % 4),
    'reactionoutcome', cast(NULL AS array<struct<value:bigint,codingSystem:string>>)))"""
_PATIENT = f"""
named_struct(
  'age', array(named_struct(
     'value', CASE WHEN c % 17 <> 0 THEN cast((c % 1000) * 0.125BD AS decimal(10,3)) END,
     'agedays', c % 1000 * 30, 'ageyears', cast(c % 100 AS string))),
  'sex', k % 3,
  'onsetdate', array(CASE k % 4 WHEN 0 THEN date_format(dt, 'yyyy-MM-dd') WHEN 1 THEN 'unknown' END),
  'weight', array(named_struct('weight', cast((k % 2000) * 0.125BD AS decimal(10,3)))),
  'height', array(named_struct('height', cast(100 + (c % 100) * 0.25BD AS decimal(10,2)))),
  'drug', slice({_DRUGS}, 1, cast(greatest(k % 4 - (ver - 1), 0) AS int)),
  'reaction', CASE WHEN c % 4 > 0 THEN slice({_REACTIONS}, 1, cast(c % 4 AS int)) END)"""


# Always true.  Lambdas keep an expression out of whole-stage code, which would make one method of the whole
# document, too long for the JIT compiler; outside it Spark cuts the code into methods that are compiled.
_APART = "forall(array(ver), v -> v IS NOT NULL)"


def _report(patient: str) -> str:
    return f"""to_json(named_struct('safetyreport', array(named_struct(
  'safetyreportid', CASE WHEN k % 7 <> 0 AND k % 11 <> 0 THEN cast(k AS string) END,
  'id', CASE WHEN k % 11 = 0 THEN NULL WHEN k % 7 = 0 THEN cast(k AS string)
             ELSE concat('alt-', k) END,
  'receivedate', CASE WHEN k % 13 = 0 THEN '20240231' WHEN k % 3 = 1 THEN date_format(dt, 'yyyy-MM-dd')
                      ELSE date_format(dt, 'yyyyMMdd') END,
  'safetyreportversion', CASE WHEN k % 23 = 0 THEN 'n/a' ELSE cast(k % 9 + ver AS string) END,
  'transmissiondate', date_format(dt, CASE WHEN k % 2 = 0 THEN 'yyyyMMdd' ELSE 'yyyy-MM-dd' END),
  'primarysource', array(named_struct('reportercountry', s)),
  'patient', {patient}))))"""


ROWS_PER_TASK = 50_000       # orders that one task makes into documents


def tasks_for(df: DataFrame, rows_per_task: int) -> int:
    """Tasks for a stored table, so that each has at most ``rows_per_task`` rows: the file footers know their number."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))


def spread(df: DataFrame) -> DataFrame:
    """Input dealt out evenly, at most ``ROWS_PER_TASK`` rows a task: building documents is CPU work, and a document
    is many times the size of its order.  Tasks grow in number with the input, not in size.
    """
    tasks = tasks_for(df, ROWS_PER_TASK)
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def dealt(df: DataFrame) -> DataFrame:
    """Input dealt out evenly with the number of its task as ``slot``: what is grouped by ``slot`` later stays where it is."""
    tasks = tasks_for(df, ROWS_PER_TASK)
    return df.withColumn("slot", (F.monotonically_increasing_id() % tasks).cast("int")).repartitionById(tasks, "slot")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_key, file_name, loaded_at, content)``: one JSON report per order version."""
    return _documents(spread(table(spark, sf_dir, "orders")))


def dealt_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents with ``slot``, see :func:`dealt`: orders travel, documents need not."""
    return _documents(dealt(table(spark, sf_dir, "orders")), "slot")


def _documents(orders: DataFrame, *carried: str) -> DataFrame:
    base = orders.selectExpr(
        "o_orderkey AS k", "o_custkey AS c", "o_orderstatus AS s", "o_orderpriority AS p",
        "cast(o_orderdate AS date) AS dt", "o_orderdate",
        "explode(CASE WHEN o_orderkey % 5 = 0 THEN array(1, 2) ELSE array(1) END) AS ver", *carried)
    return base.selectExpr(
        *carried,
        "k * 2 + ver AS doc_key",
        "concat(CASE ver WHEN 1 THEN 'load-' ELSE 'reload-' END, date_format(dt, 'yyyyMM'), '.json')"
        " AS file_name",
        "o_orderdate + CASE ver WHEN 1 THEN INTERVAL '0' DAY ELSE INTERVAL '40' DAY END AS loaded_at",
        f"CASE WHEN {_APART} AND k % 19 = 0 THEN {_report(_PATIENT)} ELSE {_report(f'array({_PATIENT})')} END"
        " AS content")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a raw table; ``doc_key`` serves as the id."""
    return documents(spark, sf_dir).select(
        F.col("doc_key").alias("file_id"), "file_name",
        F.col("loaded_at").alias("ingestion_timestamp"), parse("content").alias("raw_json"),
        F.lit("PROCESSED").alias("file_status"))


# CTEs docs (every version) and stg (newest per report) with plain columns
DOCS_SQL = """
src AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, o_orderpriority AS p,
               o_orderdate, cast(o_orderdate AS DATE) AS dt, ver
        FROM orders CROSS JOIN (VALUES (1), (2)) v(ver) WHERE ver = 1 OR o_orderkey % 5 = 0),
docs AS (
  SELECT *, k * 2 + ver AS doc_key,
    CASE WHEN k % 11 <> 0 THEN cast(k AS VARCHAR) END AS report_id,
    CASE WHEN ver = 1 THEN 'load-' ELSE 'reload-' END || strftime(dt, '%Y%m') || '.json' AS file_name,
    CASE WHEN ver = 1 THEN o_orderdate ELSE o_orderdate + INTERVAL 40 DAY END AS loaded_at,
    CASE WHEN k % 13 = 0 THEN '20240231' WHEN k % 3 = 1 THEN strftime(dt, '%Y-%m-%d')
         ELSE strftime(dt, '%Y%m%d') END AS date_text,
    k % 19 <> 0 AS has_patient,
    CASE WHEN k % 19 = 0 THEN 0 ELSE greatest(k % 4 - (ver - 1), 0) END AS n_drugs,
    CASE WHEN k % 19 = 0 THEN 0 ELSE c % 4 END AS n_reactions
  FROM src),
typed AS (
  SELECT *, CASE WHEN k % 13 <> 0 THEN dt END AS received_date,
    CASE WHEN k % 2 = 0 THEN dt END AS transmission_date,
    CASE WHEN k % 23 <> 0 THEN cast(k % 9 + ver AS INTEGER) END AS safety_report_version,
    CASE WHEN has_patient AND c % 17 <> 0 THEN ((c % 1000 * 125 + 5) // 10)::DOUBLE / 100 END
      AS patient_age,
    CASE WHEN has_patient THEN cast(c % 1000 * 30 AS INTEGER) END AS patient_age_days,
    CASE WHEN has_patient THEN cast(c % 100 AS INTEGER) END AS patient_age_years,
    CASE WHEN has_patient THEN cast(k % 3 AS INTEGER) END AS patient_sex,
    CASE WHEN has_patient AND k % 4 = 0 THEN dt END AS reaction_onset_date,
    CASE WHEN has_patient THEN ((k % 2000 * 125 + 5) // 10)::DOUBLE / 100 END AS patient_weight_kg,
    CASE WHEN has_patient THEN ((10000 + c % 100 * 25 + 5) // 10)::DOUBLE / 10 END
      AS patient_height_cm
  FROM docs),
stg AS (SELECT * FROM (
          SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY loaded_at DESC, doc_key DESC) AS rn
          FROM typed WHERE report_id IS NOT NULL) q WHERE rn = 1)"""

# child rows of the staged reports
DOC_CHILDREN_SQL = """
dose AS (SELECT *, ((k % 100000) * 125 + 5) // 10 AS dose_hundredths FROM stg),
drg AS (
  SELECT report_id, received_date, patient_sex, patient_age, loaded_at,
    p AS drug_name, NULL AS drug_code, NULL AS drug_coding_system, NULL AS active_substance_name,
    'X' || s AS medicinal_product_name, cast(k % 3 + 1 AS INTEGER) AS drug_characterization,
    'form-' || (k % 5) AS drug_dosage_form, NULL AS drug_dosage_text, '0' || (k % 7) AS route_code,
    NULL AS authorization_number, NULL AS drug_indication, NULL AS indication_coding_system,
    dose_hundredths::DOUBLE / 100 AS cumulative_dose_value, 'mg' AS cumulative_dose_unit,
    NULL AS dose_time_unit, 0 AS drug_sequence
  FROM dose WHERE n_drugs >= 1
  UNION ALL
  SELECT report_id, received_date, patient_sex, patient_age, loaded_at,
    'prod-' || (c % 40), cast(c % 10 AS VARCHAR), 'MPID', 'subst-' || (c % 5),
    'prod-' || (c % 40), 2, NULL, 'daily ' || (k % 3), NULL, 'A' || c, 'ind-' || (c % 6), 'MedDRA',
    NULL, NULL, '804', 1
  FROM dose WHERE n_drugs >= 2
  UNION ALL
  SELECT report_id, received_date, patient_sex, patient_age, loaded_at,
    CASE WHEN k // 4 % 2 = 1 THEN p END, NULL, NULL, CASE WHEN k // 4 % 2 = 0 THEN 'subst-' || (c % 5) END,
    NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 2
  FROM dose WHERE n_drugs >= 3),
rct AS (
  SELECT report_id, received_date, loaded_at, '24.1' AS reaction_meddra_version,
    NULL AS reaction_primary_source, 'rx-' || (k % 12) AS reaction_term, NULL AS reaction_term_allt,
    'E2B' AS outcome_coding_system, cast(k % 6 + 1 AS INTEGER) AS outcome_code, 0 AS reaction_sequence
  FROM stg WHERE n_reactions >= 1
  UNION ALL
  SELECT report_id, received_date, loaded_at, NULL, 'src ' || (c % 3), 'rx-' || (c % 12),
    'llt-' || (k % 4), NULL, NULL, 1
  FROM stg WHERE n_reactions >= 2),
allpairs AS (
  SELECT d.report_id, drug_name, drug_characterization, drug_sequence,
    d.report_id || '-' || drug_sequence AS report_drug_id, reaction_term, reaction_sequence,
    d.report_id || '-react-' || reaction_sequence AS report_reaction_id,
    least(d.loaded_at, r.loaded_at) AS src_ld_ts
  FROM drg d JOIN rct r ON d.report_id = r.report_id),
rep AS (SELECT report_id FROM stg),
prs AS (SELECT DISTINCT report_id, drug_name, reaction_term FROM allpairs)"""
