"""Queries over the document view: extraction, staging and child tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semistructured import elements, first_path, flatten, parse, path
from ..operators.latest import dedupe_latest
from ..operators.tally import tally_reports
from ..plans import reports as R
from ..plans.marts import drug_stats_of_reports, summarise_drugs
from ..plans.signals import risk_signals_of_reports
from ..session import stored
from ..schemas import (
    DRUG_ARRAY_PATH, PAIR_COLUMNS, REACTION_ARRAY_PATH, REPORT_ID_PATHS,
)
from . import query
from .bindings import DOC_CHILDREN_SQL, DOCS_SQL, MARTS_SQL, SUMMARY_SQL, raw, table

REPORT_SQL = """report_id, received_date::VARCHAR AS received_date,
  NULL::VARCHAR AS reception_date, safety_report_version,
  transmission_date::VARCHAR AS transmission_date, patient_age, patient_age_days, patient_age_years, patient_sex,
  reaction_onset_date::VARCHAR AS reaction_onset_date, patient_weight_kg, patient_height_cm, s AS source_country,
  loaded_at AS src_ld_ts, loaded_at::DATE::VARCHAR AS src_ld_date, file_name AS source_file"""


def plain(df: DataFrame) -> DataFrame:
    """Decimals shown as doubles, to compare across engines."""
    return df.select(*[
        F.col(f.name).cast("double") if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in df.schema])


def staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.stage_reports(raw(spark, sf_dir))


@query("stage_reports", f"WITH {DOCS_SQL} SELECT {REPORT_SQL} FROM stg")
def stage_reports(spark, sf_dir):
    return plain(R.reports(staged(spark, sf_dir)))


@query("json_path_extract", f"""WITH {DOCS_SQL} SELECT doc_key AS file_id, {REPORT_SQL}
  FROM (SELECT * FROM typed)""")
def json_path_extract(spark, sf_dir):
    return plain(R.extract_report(raw(spark, sf_dir)).select("file_id", *R.REPORT_COLUMNS))


@query("cast_errors", f"""WITH {DOCS_SQL}
  SELECT doc_key AS file_id, file_name, 'received_date' AS column_name, NULL::INT AS position, date_text AS value
  FROM typed WHERE k % 13 = 0
  UNION ALL
  SELECT doc_key, file_name, 'transmission_date', NULL, strftime(dt, '%Y-%m-%d') FROM typed WHERE k % 2 = 1
  UNION ALL
  SELECT doc_key, file_name, 'safety_report_version', NULL, 'n/a' FROM typed WHERE k % 23 = 0
  UNION ALL
  SELECT doc_key, file_name, 'reaction_onset_date', NULL, 'unknown' FROM typed WHERE has_patient AND k % 4 = 1""")
def cast_errors(spark, sf_dir):
    return R.cast_errors(raw(spark, sf_dir))


@query("cast_errors_children", """SELECT event_id AS file_id, 'drug_characterization' AS column_name, 1 AS position, 'main' AS value
  FROM events WHERE event_id % 3 = 0
  UNION ALL SELECT event_id, 'cumulative_dose_value', 0, '1 cup' FROM events WHERE event_id % 4 = 0
  UNION ALL SELECT event_id, 'outcome_code', 0, 'none' FROM events WHERE event_id % 5 = 0
  UNION ALL SELECT event_id, 'reaction_onset_date', NULL, '2024' FROM events WHERE event_id % 7 = 0""")
def cast_errors_children(spark, sf_dir):
    """Reports with misfits planted in drugs and reactions, and a date that is only a year."""
    report = """to_json(named_struct('id', cast(event_id AS string), 'patient', array(named_struct(
      'onsetdate', array(IF(event_id % 7 = 0, '2024', '2024-01-02')),
      'drug', array(
        named_struct('medicinalproduct', event_type, 'drugcharacterization', '1',
          'drugcumulativedose', array(named_struct('value', IF(event_id % 4 = 0, '1 cup', '1.5')))),
        named_struct('medicinalproduct', 'other', 'drugcharacterization', IF(event_id % 3 = 0, 'main', '2'),
          'drugcumulativedose', array(named_struct('value', '2')))),
      'reaction', array(named_struct('reactionmeddrapt', event_type,
        'reactionoutcome', array(named_struct('value', IF(event_id % 5 = 0, 'none', '1')))))))))"""
    docs = table(spark, sf_dir, "events").selectExpr(
        "event_id AS file_id", "'f' AS file_name", f"""parse_json(concat('{{"safetyreport":[', {report}, ']}}')) AS raw_json""")
    return R.cast_errors(docs).drop("file_name")


@query("json_coalesce_paths", f"""WITH {DOCS_SQL}
  SELECT doc_key, report_id, CASE WHEN n_drugs >= 1 THEN p END AS first_drug FROM docs""")
def json_coalesce_paths(spark, sf_dir):
    drug = DRUG_ARRAY_PATH + "[0]."
    return raw(spark, sf_dir).select(
        F.col("file_id").alias("doc_key"),
        first_path("raw_json", *REPORT_ID_PATHS).alias("report_id"),
        first_path("raw_json", drug + "drgname", drug + "medicinalproduct",
                   drug + "medicinalproductname").alias("first_drug"))


@query("json_array_index", f"""WITH {DOCS_SQL}
  SELECT doc_key, CASE WHEN n_drugs >= 2 THEN 'prod-' || (c % 40) END AS second_product,
    cast(NULL AS VARCHAR) AS beyond, has_patient AS patient_is_array FROM docs""")
def json_array_index(spark, sf_dir):
    return raw(spark, sf_dir).select(
        F.col("file_id").alias("doc_key"),
        path("raw_json", DRUG_ARRAY_PATH + "[1].medicinalproduct").alias("second_product"),
        path("raw_json", DRUG_ARRAY_PATH + "[9].medicinalproduct").alias("beyond"),
        elements("raw_json", "$.safetyreport[0].patient").isNotNull().alias("patient_is_array"))


@query("json_parse", """SELECT event_id, cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
  false AS cut_text_parses FROM events""")
def json_parse(spark, sf_dir):
    cut = F.expr("substr(props, 1, length(props) - 1)")
    return table(spark, sf_dir, "events").select(
        "event_id", path(parse("props"), "$.k", "int").alias("k"),
        parse(cut).isNotNull().alias("cut_text_parses"))


# every version of a document, with an empty or missing array kept as one row
def _flat_sql(n: str) -> str:
    return f"""WITH {DOCS_SQL}
  SELECT doc_key, i AS index FROM docs JOIN (VALUES (0), (1), (2)) v(i) ON i < {n}
  UNION ALL SELECT doc_key, NULL FROM docs WHERE {n} = 0"""


@query("flatten_drugs", _flat_sql("n_drugs"))
def flatten_drugs(spark, sf_dir):
    docs = raw(spark, sf_dir).select(
        F.col("file_id").alias("doc_key"), elements("raw_json", DRUG_ARRAY_PATH).alias("drugs"))
    return flatten(docs, "drugs").select("doc_key", "index")


@query("flatten_reactions", _flat_sql("n_reactions"))
def flatten_reactions(spark, sf_dir):
    docs = raw(spark, sf_dir).select(
        F.col("file_id").alias("doc_key"),
        elements("raw_json", REACTION_ARRAY_PATH).alias("reactions"))
    return flatten(docs, "reactions").select("doc_key", "index")


@query("lateral_flatten_join", f"""WITH {DOCS_SQL}
  SELECT doc_key, report_id, i AS index, CASE i WHEN 0 THEN 'X' || s WHEN 1 THEN 'prod-' || (c % 40) END
    AS medicinal_product_name
  FROM docs JOIN (VALUES (0), (1), (2)) v(i) ON i < n_drugs
  UNION ALL SELECT doc_key, report_id, NULL, NULL FROM docs WHERE n_drugs = 0""")
def lateral_flatten_join(spark, sf_dir):
    """Columns of the document next to those of each of its drugs."""
    docs = raw(spark, sf_dir).select(
        F.col("file_id").alias("doc_key"), R.report_id("raw_json").alias("report_id"),
        elements("raw_json", DRUG_ARRAY_PATH).alias("drugs"))
    return flatten(docs, "drugs").select(
        "doc_key", "report_id", "index",
        path("element", "$.medicinalproduct").alias("medicinal_product_name"))


@query("filter_report_id", f"""WITH {DOCS_SQL}
  SELECT count(*) AS documents, count(report_id) AS with_id, count(DISTINCT report_id) AS reports FROM docs""")
def filter_report_id(spark, sf_dir):
    """Documents, those with an id, and the reports that staging keeps."""
    documents = stored(raw(spark, sf_dir), "raw")
    kept = R.stage_reports(documents).agg(F.count("*").alias("reports"))
    return documents.agg(
        F.count("*").alias("documents"), F.count(R.report_id("raw_json")).alias("with_id")
    ).crossJoin(F.broadcast(kept))


DRUG_SQL = """drug_name, drug_code, drug_coding_system, active_substance_name, medicinal_product_name,
  drug_characterization, drug_dosage_form, drug_dosage_text, route_code, authorization_number,
  drug_indication, indication_coding_system, cumulative_dose_value, cumulative_dose_unit,
  dose_time_unit, drug_sequence"""
REACTION_SQL = """reaction_meddra_version, reaction_primary_source, reaction_term,
  reaction_term_allt, outcome_coding_system, outcome_code, reaction_sequence"""


@query("json_path_extract_drug", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT report_id, {DRUG_SQL} FROM drg""")
def json_path_extract_drug(spark, sf_dir):
    newest = dedupe_latest(
        raw(spark, sf_dir).withColumn("report_id", R.report_id("raw_json")),
        newest=("ingestion_timestamp", "file_id"))
    rows = flatten(newest.select("report_id", elements("raw_json", DRUG_ARRAY_PATH).alias("drugs")),
                   "drugs", outer=False, index="drug_sequence").drop("drugs")
    return plain(R.filter_named_drugs(R.extract_drug(rows)))


@query("json_path_extract_reaction", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT report_id, {REACTION_SQL} FROM rct
  UNION ALL SELECT report_id, NULL, NULL, NULL, 'llt-' || (k % 4), NULL, NULL, 2
  FROM stg WHERE n_reactions >= 3""")
def json_path_extract_reaction(spark, sf_dir):
    newest = dedupe_latest(
        raw(spark, sf_dir).withColumn("report_id", R.report_id("raw_json")),
        newest=("ingestion_timestamp", "file_id"))
    rows = flatten(
        newest.select("report_id", elements("raw_json", REACTION_ARRAY_PATH).alias("reactions")),
        "reactions", outer=False, index="reaction_sequence").drop("reactions")
    return R.extract_reaction(rows)


@query("extraction_preview", f"""WITH {DOCS_SQL}
  SELECT report_id, date_text AS received_date_str, CASE WHEN n_drugs >= 1 THEN 'X' || s END AS drug,
    CASE WHEN n_reactions >= 1 THEN 'rx-' || (k % 12) END AS reaction
  FROM docs ORDER BY report_id NULLS FIRST, received_date_str NULLS FIRST, drug NULLS FIRST,
    reaction NULLS FIRST LIMIT 5""")
def extraction_preview(spark, sf_dir):
    return R.extraction_preview(raw(spark, sf_dir))


@query("dedupe_latest", """SELECT event_id, user_id, ts, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1""")
def dedupe_latest_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    return dedupe_latest(events, "user_id", ("ts", "event_id"))


@query("join_raw_to_staged", f"""WITH {DOCS_SQL} SELECT report_id, doc_key AS file_id, received_date::VARCHAR AS received_date,
  patient_sex, patient_age, loaded_at AS src_ld_ts FROM stg""")
def join_raw_to_staged(spark, sf_dir):
    documents = stored(raw(spark, sf_dir), "raw")
    joined = R.join_raw_to_staged(documents, R.stage_reports(documents))
    return plain(joined.select("report_id", "file_id", "received_date", "patient_sex", "patient_age",
                               "src_ld_ts"))


@query("report_drugs", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT report_id || '-' || drug_sequence AS report_drug_id, report_id, received_date::VARCHAR AS received_date, patient_sex,
    patient_age, {DRUG_SQL}, loaded_at AS src_ld_ts, loaded_at::DATE::VARCHAR AS src_ld_date FROM drg""")
def report_drugs(spark, sf_dir):
    return plain(R.report_drugs(staged(spark, sf_dir)))


@query("report_reactions", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT report_id || '-react-' || reaction_sequence AS report_reaction_id, report_id,
    received_date::VARCHAR AS received_date, {REACTION_SQL}, loaded_at AS src_ld_ts,
    loaded_at::DATE::VARCHAR AS src_ld_date FROM rct""")
def report_reactions(spark, sf_dir):
    return R.report_reactions(staged(spark, sf_dir))


PAIRS_SQL = f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT report_id || '-' || report_drug_id || '-' || report_reaction_id AS drug_reaction_pair_id, *
  FROM allpairs"""


@query("drug_reaction_pairs", PAIRS_SQL)
def drug_reaction_pairs(spark, sf_dir):
    return R.pairs_of_arrays(stored(R.pair_arrays(staged(spark, sf_dir)), "pair-arrays")).select(*PAIR_COLUMNS)


@query("report_pairs", PAIRS_SQL)
def report_pairs(spark, sf_dir):
    """The same pairs by joining the two child tables."""
    reports = stored(staged(spark, sf_dir), "staged")
    return R.drug_reaction_pairs(R.report_drugs(reports), R.report_reactions(reports), longest=R.longest_list(reports))


@query("filter_named_drugs", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT drug_name IS NULL AS substance_only, count(*) AS n FROM drg GROUP BY 1""")
def filter_named_drugs(spark, sf_dir):
    named = R.filter_named_drugs(R.report_drugs(staged(spark, sf_dir)))
    return named.groupBy(F.col("drug_name").isNull().alias("substance_only")).agg(
        F.count("*").alias("n"))


@query("filter_reaction_present", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT reaction_sequence, count(*) AS n FROM rct GROUP BY 1""")
def filter_reaction_present(spark, sf_dir):
    rows = flatten(staged(spark, sf_dir).select("reactions"), "reactions", outer=False)
    rows = rows.select(F.col("index").alias("reaction_sequence"),
                       F.col("element.reactionmeddrapt").alias("reaction_term"))
    return R.filter_reaction_present(rows).groupBy("reaction_sequence").agg(F.count("*").alias("n"))


@query("pair_tally_of_reports", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}, {MARTS_SQL}
  SELECT drug_name, reaction_term, report_count FROM pc""")
def pair_tally_of_reports(spark, sf_dir):
    return tally_reports(stored(staged(spark, sf_dir), "staged")).select("drug_name", "reaction_term", "report_count")


@query("drug_summary_of_reports", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}, {SUMMARY_SQL}
  SELECT drug_name, total_reports, avg_age, risk_level FROM summary""")
def drug_summary_of_reports(spark, sf_dir):
    return summarise_drugs(drug_stats_of_reports(staged(spark, sf_dir)))


@query("risk_signals_of_reports", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}, {MARTS_SQL}
  SELECT drug_name, reaction_term, report_count, b_count, c_count, d_count, ror, prr, ror_simple,
    signal_strength, is_significant_signal FROM sig""")
def signals_of_reports(spark, sf_dir):
    needed = staged(spark, sf_dir).select("report_id", "drug_names", "reaction_terms", "pair_volume")
    return risk_signals_of_reports(stored(needed, "needed")).drop("signal_generated_at")
