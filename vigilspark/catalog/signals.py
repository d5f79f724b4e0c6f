"""Queries over the relational views: tallies, cells, metrics, signals and their consumers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.numbering import number_rows
from ..operators.tally import (
    drug_counts, pair_counts, reaction_counts, tally_children, tally_pairs, total_reports,
)
from ..plans import consumers as C
from ..plans import name_index as N
from ..plans import signals as P
from ..session import pin, scratch_path
from . import query
from .bindings import (
    DRUG, MARTS_SQL, REACTION, SPARSE_DRUG, SPARSE_REACTION, children_sql, drugs, line_pairs, reactions, reports,
)

PLAIN = f"WITH {children_sql()}, {MARTS_SQL}"
SPARSE = f"WITH {children_sql(SPARSE_DRUG, SPARSE_REACTION)}, {MARTS_SQL}"
SIGNAL_SQL = """drug_name, reaction_term, report_count, b_count, c_count, d_count, ror, prr, ror_simple,
  signal_strength, is_significant_signal"""
SEARCH_SQL = "drug_name, reaction_term, report_count, prr, ror, signal_strength, is_significant_signal"
PRR_ORDER = "ORDER BY prr DESC NULLS FIRST, drug_name, reaction_term"


def tally(spark: SparkSession, sf_dir: str, drug: str = DRUG, reaction: str = REACTION) -> DataFrame:
    return tally_children(drugs(spark, sf_dir, drug), reactions(spark, sf_dir, reaction))


def sparse_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally(spark, sf_dir, SPARSE_DRUG, SPARSE_REACTION)


def signals(spark: SparkSession, sf_dir: str, drug: str = DRUG, reaction: str = REACTION) -> DataFrame:
    made = P.signals_from_tally(pin(tally(spark, sf_dir, drug, reaction)), reports(spark, sf_dir))
    return made.drop("signal_generated_at")


def sparse_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir, SPARSE_DRUG, SPARSE_REACTION)


@query("risk_signals", f"{PLAIN} SELECT {SIGNAL_SQL} FROM sig")
def risk_signals(spark, sf_dir):
    """Flagship: pairs, margins, cells, PRR / ROR, bands and order."""
    made = P.risk_signals(drugs(spark, sf_dir), reactions(spark, sf_dir), reports(spark, sf_dir))
    return made.drop("signal_generated_at")


@query("risk_signals_sparse", f"{SPARSE} SELECT {SIGNAL_SQL} FROM sig")
def risk_signals_sparse(spark, sf_dir):
    """With unnamed drugs and a reaction that only one drug has."""
    return P.order_signals(sparse_signals(spark, sf_dir))


@query("order_signals", f"""{SPARSE} SELECT row_number() OVER (ORDER BY is_significant_signal DESC,
  ror DESC NULLS FIRST, report_count DESC, drug_name, reaction_term) AS position,
  drug_name, reaction_term FROM sig""")
def order_signals(spark, sf_dir):
    """Every signal with its place in the order."""
    placed = number_rows(sparse_signals(spark, sf_dir), "position", order_by=P.signal_order())
    return placed.select("position", "drug_name", "reaction_term")


@query("drug_margin_counts", f"{SPARSE} SELECT drug_name, reports_with_drug FROM dc")
def drug_margin_counts(spark, sf_dir):
    return drug_counts(sparse_tally(spark, sf_dir))


@query("reaction_margin_counts", f"{SPARSE} SELECT reaction_term, reports_with_reaction FROM rc")
def reaction_margin_counts(spark, sf_dir):
    return reaction_counts(sparse_tally(spark, sf_dir))


@query("total_reports", "SELECT count(DISTINCT o_orderkey) AS total_report_count FROM orders")
def all_reports(spark, sf_dir):
    return total_reports(reports(spark, sf_dir))


@query("filter_min_pair_reports",
       f"{PLAIN} SELECT drug_name, reaction_term, report_count FROM pc WHERE report_count >= 50")
def filter_min_pair_reports(spark, sf_dir):
    return P.filter_min_pair_reports(pair_counts(tally(spark, sf_dir)))


@query("join_drug_margin", f"""{SPARSE} SELECT pc.drug_name, reaction_term, report_count,
  reports_with_drug FROM pc JOIN dc ON pc.drug_name = dc.drug_name""")
def join_drug_margin(spark, sf_dir):
    counts = pin(sparse_tally(spark, sf_dir))
    return P.join_drug_margin(pair_counts(counts), drug_counts(counts))


@query("join_reaction_margin", f"""{SPARSE} SELECT drug_name, pc.reaction_term, report_count,
  reports_with_reaction FROM pc JOIN rc ON pc.reaction_term = rc.reaction_term""")
def join_reaction_margin(spark, sf_dir):
    counts = pin(sparse_tally(spark, sf_dir))
    return P.join_reaction_margin(pair_counts(counts), reaction_counts(counts))


@query("cross_join_total", f"{PLAIN} SELECT drug_name, reports_with_drug, total_report_count FROM dc, tr")
def cross_join_total(spark, sf_dir):
    return P.cross_join_total(drug_counts(tally(spark, sf_dir)), total_reports(reports(spark, sf_dir)))


CELLS = "drug_name, reaction_term, report_count, b_count, c_count, d_count"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.contingency_cells(pin(sparse_tally(spark, sf_dir)), reports(spark, sf_dir))


@query("contingency_cells", f"{SPARSE} SELECT {CELLS} FROM cells")
def contingency_cells(spark, sf_dir):
    return cells(spark, sf_dir)


def _metric(name: str, fn) -> None:
    @query(f"metric_{name}", f"{SPARSE} SELECT drug_name, reaction_term, {name} FROM metrics")
    def metric(spark, sf_dir):
        abcd = [F.col(c) for c in ("report_count", "b_count", "c_count", "d_count")]
        return cells(spark, sf_dir).select("drug_name", "reaction_term", fn(*abcd).alias(name))


_metric("ror", S.ror)
_metric("prr", S.prr)
_metric("ror_simple", S.ror_simple)


@query("guarded_ratio", f"""{SPARSE} SELECT drug_name, reaction_term,
  CASE WHEN c_count > 0 THEN report_count::DOUBLE / c_count END AS a_per_c FROM cells""")
def guarded_ratio(spark, sf_dir):
    guarded = S.ratio(F.col("report_count"), F.col("c_count"), F.col("c_count") > 0)
    return cells(spark, sf_dir).select("drug_name", "reaction_term", guarded.alias("a_per_c"))


@query("signal_band", f"""{SPARSE} SELECT CASE WHEN prr > 2.0 THEN 'HIGH' WHEN prr > 1.0 THEN 'ELEVATED'
  ELSE 'BASELINE' END AS signal_strength, count(*) AS n FROM metrics GROUP BY 1""")
def signal_band(spark, sf_dir):
    metrics = P.with_metrics(cells(spark, sf_dir))
    return metrics.groupBy(S.signal_band(F.col("prr")).alias("signal_strength")).agg(
        F.count("*").alias("n"))


@query("significance_flag", f"""{SPARSE} SELECT coalesce(prr > 2.0 AND report_count >= 50, false)
  AS is_significant_signal, count(*) AS n FROM metrics GROUP BY 1""")
def significance_flag(spark, sf_dir):
    metrics = P.with_metrics(cells(spark, sf_dir))
    flag = S.significant(F.col("prr"), F.col("report_count"))
    return metrics.groupBy(flag.alias("is_significant_signal")).agg(F.count("*").alias("n"))


# --- consumers ---------------------------------------------------------------


@query("signals_topk", f"{SPARSE} SELECT {SIGNAL_SQL} FROM sig {PRR_ORDER} LIMIT 100")
def signals_topk(spark, sf_dir):
    return C.signals_topk(sparse_signals(spark, sf_dir))


@query("signals_search", f"""{PLAIN} SELECT {SEARCH_SQL} FROM sig
  WHERE upper(drug_name) LIKE upper('%Bolt%') AND upper(signal_strength) = upper('elevated')
    AND report_count >= 60 {PRR_ORDER} LIMIT 100""")
def signals_search(spark, sf_dir):
    return C.search_signals(signals(spark, sf_dir), "Bolt", "elevated", 60)


@query("signals_by_name", f"""{SPARSE} SELECT {SEARCH_SQL} FROM sig
  WHERE upper(drug_name) LIKE upper('%blue_an%') {PRR_ORDER} LIMIT 1000""")
def signals_by_name(spark, sf_dir):
    return C.signals_by_name(sparse_signals(spark, sf_dir), "blue_an", 1000)


@query("signals_by_name_indexed", f"""{SPARSE} SELECT {SEARCH_SQL} FROM sig
  WHERE upper(drug_name) LIKE upper('%blue_an%') {PRR_ORDER} LIMIT 1000""")
def signals_by_name_indexed(spark, sf_dir):
    """The same search over a stored mart with an index of its names."""
    path = scratch_path(spark, "name-index")
    N.write_index(sparse_signals(spark, sf_dir), path)
    return N.signals_by_name(spark, path, "blue_an", 1000)


@query("signals_by_strength", f"""{SPARSE} SELECT {SEARCH_SQL} FROM sig
  WHERE upper(signal_strength) = upper('baseline') {PRR_ORDER} LIMIT 50""")
def signals_by_strength(spark, sf_dir):
    return C.signals_by_strength(sparse_signals(spark, sf_dir), "baseline", 50)


@query("signal_summary", f"""{SPARSE} SELECT count(*) AS total_pairs,
  cast(coalesce(sum(CASE WHEN signal_strength = 'HIGH' THEN 1 ELSE 0 END), 0) AS BIGINT) AS high_signals,
  cast(coalesce(sum(CASE WHEN signal_strength = 'ELEVATED' THEN 1 ELSE 0 END), 0) AS BIGINT)
    AS elevated_signals,
  cast(coalesce(sum(report_count), 0) AS BIGINT) AS total_reports,
  count(DISTINCT drug_name) AS unique_drugs FROM sig""")
def signal_summary(spark, sf_dir):
    return C.signal_summary(sparse_signals(spark, sf_dir))


@query("null_default", f"""{SPARSE} SELECT cast(coalesce(sum(report_count), 0) AS BIGINT) AS total_reports
  FROM sig WHERE drug_name = 'no such drug'""")
def null_default(spark, sf_dir):
    none = sparse_signals(spark, sf_dir).filter("drug_name = 'no such drug'")
    return C.signal_summary(none).select("total_reports")


@query("filter_min_reports", f"{SPARSE} SELECT {CELLS} FROM cells WHERE report_count >= 20")
def filter_min_reports(spark, sf_dir):
    return C.filter_min_reports(cells(spark, sf_dir), 20, "report_count")


@query("risk_signals_of_pairs", f"{PLAIN} SELECT {SIGNAL_SQL} FROM sig")
def risk_signals_of_pairs(spark, sf_dir):
    """Signals from a stored pair table instead of the child tables."""
    made = P.signals_from_tally(pin(tally_pairs(line_pairs(spark, sf_dir))), reports(spark, sf_dir))
    return P.order_signals(made).drop("signal_generated_at")


@query("run_timestamp", f"""{PLAIN} SELECT drug_name, reaction_term, '2024-03-01 06:00:00' AS generated_at FROM sig""")
def run_timestamp(spark, sf_dir):
    """The time of the run next to every signal."""
    made = P.signals_from_tally(pin(tally(spark, sf_dir)), reports(spark, sf_dir), as_of="2024-03-01 06:00:00")
    return made.select("drug_name", "reaction_term",
                       F.date_format("signal_generated_at", "yyyy-MM-dd HH:mm:ss").alias("generated_at"))
