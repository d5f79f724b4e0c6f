"""Disproportionality signals from a pair tally.

Over distinct reports, for a drug x reaction pair: A both, B drug without the
reaction, C reaction without the drug, D neither.  All four follow from one row
(A, drug reports, reaction reports, all reports), so no self-joins are needed.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators.tally import (
    drug_counts, pair_counts, reaction_counts, tally_children, tally_reports, total_reports,
)
from ..schemas import (
    ELEVATED_PRR, HIGH_PRR, MIN_PAIR_REPORTS, SIGNAL_COLUMNS,
)
from ..session import pin


def filter_min_pair_reports(pairs: DataFrame, n: int = MIN_PAIR_REPORTS) -> DataFrame:
    return pairs.filter(F.col("report_count") >= n)


def join_drug_margin(pairs: DataFrame, drugs: DataFrame) -> DataFrame:
    """Pairs with the reports of their drug; pairs without a drug name drop out."""
    return pairs.join(drugs, "drug_name")


def join_reaction_margin(pairs: DataFrame, reactions: DataFrame) -> DataFrame:
    return pairs.join(reactions, "reaction_term")


def cross_join_total(df: DataFrame, total: DataFrame) -> DataFrame:
    """``total`` is an aggregate without keys, hence one row: the broadcast is bounded."""
    return df.crossJoin(F.broadcast(total))


def contingency_cells(tally: DataFrame, reports: DataFrame | None, min_reports: int = 0,
                      staged: bool = False, total: DataFrame | None = None) -> DataFrame:
    """A, B, C, D per named pair; ``staged`` reports have one row per id.

    ``total`` is a stored count of the reports (one row), used instead of counting them.
    ``min_reports`` drops rare pairs before the margin joins; the margins
    themselves always see every pair.
    """
    pairs = pair_counts(tally).filter(F.col("drug_name").isNotNull())
    if min_reports > 0:
        pairs = filter_min_pair_reports(pairs, min_reports)
    named_drugs = drug_counts(tally.filter(F.col("drug_name").isNotNull()))
    joined = join_reaction_margin(join_drug_margin(pairs, named_drugs), reaction_counts(tally))
    a, dn, rn = F.col("report_count"), F.col("reports_with_drug"), F.col("reports_with_reaction")
    n = F.col("total_report_count")
    return cross_join_total(joined, total_reports(reports, staged) if total is None else total).select(
        "drug_name", "reaction_term", "report_count",
        (dn - a).alias("b_count"), (rn - a).alias("c_count"), (n - dn - rn + a).alias("d_count"))


def with_metrics(cells: DataFrame) -> DataFrame:
    """ROR, PRR and simple ROR next to the cells."""
    abcd = [F.col(c) for c in ("report_count", "b_count", "c_count", "d_count")]
    return cells.withColumns({
        "ror": S.ror(*abcd), "prr": S.prr(*abcd), "ror_simple": S.ror_simple(*abcd)})


def signals_from_tally(tally: DataFrame, reports: DataFrame | None, min_reports: int = MIN_PAIR_REPORTS,
                       high: float = HIGH_PRR, elevated: float = ELEVATED_PRR,
                       significant_reports: int = MIN_PAIR_REPORTS,
                       as_of: datetime | str | None = None, staged: bool = False,
                       total: DataFrame | None = None) -> DataFrame:
    """Signal table, unordered.  The tally is read for pairs and both margins:
    pass a stored or pinned one."""
    metrics = with_metrics(contingency_cells(tally, reports, min_reports, staged, total))
    return metrics.withColumns({
        "signal_strength": S.signal_band(F.col("prr"), high, elevated),
        "is_significant_signal": S.significant(
            F.col("prr"), F.col("report_count"), high, significant_reports),
        "signal_generated_at": S.run_timestamp(as_of),
    }).select(*SIGNAL_COLUMNS)


def signal_order(nulls_first: bool = True) -> list[Column]:
    """Significant first, then by ROR and count, completed to a total order."""
    ror = F.desc_nulls_first("ror") if nulls_first else F.desc_nulls_last("ror")
    return [F.desc("is_significant_signal"), ror, F.desc("report_count"),
            F.asc("drug_name"), F.asc("reaction_term")]


def order_signals(signals: DataFrame, nulls_first: bool = True) -> DataFrame:
    return signals.orderBy(*signal_order(nulls_first))


def risk_signals(drugs: DataFrame, reactions: DataFrame, reports: DataFrame,
                 min_reports: int = MIN_PAIR_REPORTS, as_of: datetime | str | None = None) -> DataFrame:
    """Ordered signals from the child tables, which are read twice: pass stored ones."""
    tally = pin(tally_children(drugs, reactions))
    return order_signals(signals_from_tally(tally, reports, min_reports, as_of=as_of))


def risk_signals_of_reports(staged: DataFrame, min_reports: int = MIN_PAIR_REPORTS,
                            as_of: datetime | str | None = None) -> DataFrame:
    """Ordered signals straight from staged reports, which are read twice: pass stored ones."""
    tally = pin(tally_reports(staged))
    return order_signals(signals_from_tally(tally, staged, min_reports, as_of=as_of, staged=True))
