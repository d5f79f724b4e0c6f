"""The pair tally: one row per drug x reaction from which every count follows.

``report_count``    distinct reports with both (cell A)
``drug_share``      reports in which this reaction is the report's first one
``reaction_share``  reports in which this drug is the report's first one

A report lists each of its drugs once under its first reaction, so summing
``drug_share`` over the reactions of a drug counts its reports exactly once;
likewise for reactions.  The margins become plain sums over a small aggregated
table, and the report-level data is joined and shuffled once, not three times.
A NULL drug name is a drug of its own here: it counts for reaction margins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .within import BLOCK, array_grid, grid_join, large_keys

PAIR = ["drug_name", "reaction_term"]
COUNTS = ["report_count", "drug_share", "reaction_share"]


def _sum_up(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(*PAIR).agg(
        F.count("*").alias("report_count"),
        F.sum(F.col("first_reaction").cast("long")).alias("drug_share"),
        F.sum(F.col("first_drug").cast("long")).alias("reaction_share"),
    )


def tally_reports(staged: DataFrame, block: int = BLOCK) -> DataFrame:
    """Tally of staged reports (one row per report, see ``plans.reports``).

    The arrays of a report sit in its row, so pairs are formed without a
    shuffle and only partial pair counts travel.  Only a report with very many
    pairs is cut up and spread.
    """
    arrays = staged.select(
        "report_id", "pair_volume", F.array_distinct("drug_names").alias("drugs"),
        F.array_distinct("reaction_terms").alias("terms"))
    cells = array_grid(arrays, "drugs", "terms", "pair_volume", "report_id", block)
    drugs = cells.select("left_from", "right_from", "terms",
                         F.posexplode("drugs").alias("_d", "drug_name"))
    pairs = drugs.select(
        "drug_name", (F.col("left_from") + F.col("_d") == 0).alias("first_drug"), "right_from",
        F.posexplode("terms").alias("_r", "reaction_term"))
    return _sum_up(pairs.withColumn("first_reaction", F.col("right_from") + F.col("_r") == 0))


def tally_children(drugs: DataFrame, reactions: DataFrame, block: int = BLOCK) -> DataFrame:
    """Tally of the child tables (one row per report and drug / reaction).

    Reports of at most ``block`` rows a side, usually all of them, travel once,
    to the layout their join needs; repeats are dropped and the first row is
    found on the sorted rows there.  Larger reports have their repeats combined
    before they travel and are spread over the grid of :mod:`within`.
    """
    key = "report_id"
    d = drugs.select(key, "drug_name").filter(F.col(key).isNotNull())
    r = reactions.select(key, "reaction_term").filter(
        F.col(key).isNotNull() & F.col("reaction_term").isNotNull())

    def numbered(df: DataFrame, col: str, flag: str) -> DataFrame:
        order = Window.partitionBy(key).orderBy(col)
        ranked = df.withColumns({
            flag: F.row_number().over(order) == 1,
            "_repeat": F.col(col).eqNullSafe(F.lag(col).over(order))})
        return ranked.filter(F.col(flag) | ~F.col("_repeat")).drop("_repeat")

    def compared(df: DataFrame, col: str, flag: str) -> DataFrame:
        # min() skips NULL, so NULL is first only where it is the only value
        first = df.groupBy(key).agg(F.min(col).alias("_first"))
        return df.join(first, key).withColumn(flag, F.col(col).eqNullSafe(F.col("_first"))).drop("_first")

    def joined(d: DataFrame, r: DataFrame) -> DataFrame:
        return numbered(d, "drug_name", "first_drug").join(
            numbered(r, "reaction_term", "first_reaction"), key)

    large = large_keys(d, r, key, block)
    if large is None:
        return _sum_up(joined(d, r))
    small = joined(d.join(large, key, "left_anti"), r.join(large, key, "left_anti"))
    paired = large.filter("left_stripes > 0 AND right_stripes > 0")     # others make no pairs
    hot = grid_join(
        compared(d.join(paired, key, "left_semi").distinct(), "drug_name", "first_drug"),
        compared(r.join(paired, key, "left_semi").distinct(), "reaction_term", "first_reaction"),
        key, large)
    return _sum_up(small.unionByName(hot))


def tally_pairs(pairs: DataFrame) -> DataFrame:
    """Tally of an existing pair table (one row per report x drug x reaction, repeats allowed).

    The first reaction is taken per report and drug, the first drug per report
    and reaction, so the table need not hold every combination of a report.  Every step groups inside a report: a
    table that lies by report is not shuffled again before its pairs are summed up, and of any other only rows of one
    report and name have to meet.
    """
    key = "report_id"
    triples = pairs.filter(F.col(key).isNotNull()).select(key, *PAIR).distinct()

    def first(col: str, other: str):
        # min() skips NULL, so NULL is first only where it is the only value
        return F.col(col).eqNullSafe(F.min(col).over(Window.partitionBy(key, other)))

    return _sum_up(triples.withColumn("first_reaction", first("reaction_term", "drug_name"))
                   .withColumn("first_drug", first("drug_name", "reaction_term")))


def tally_change(stored: DataFrame | None, added: DataFrame, removed: DataFrame) -> DataFrame:
    """A stored tally with the tally of new report versions added and that of the versions they replace taken off.

    Every column is a sum over reports, so the result is the tally of the reports as they are now; pairs
    without a report left drop out.
    """
    signed = added.unionByName(removed.select(*PAIR, *[(-F.col(c)).alias(c) for c in COUNTS]))
    if stored is not None:
        signed = stored.unionByName(signed)
    sums = signed.groupBy(*PAIR).agg(*[F.sum(c).alias(c) for c in COUNTS])
    return sums.where("report_count <> 0")


def pair_counts(tally: DataFrame) -> DataFrame:
    """Distinct reports per pair."""
    return tally.select(*PAIR, "report_count")


def drug_counts(tally: DataFrame) -> DataFrame:
    """Distinct reports per drug, over reports that have a reaction."""
    return tally.groupBy("drug_name").agg(F.sum("drug_share").alias("reports_with_drug"))


def reaction_counts(tally: DataFrame) -> DataFrame:
    """Distinct reports per reaction, over reports that have a drug (named or not)."""
    return tally.groupBy("reaction_term").agg(F.sum("reaction_share").alias("reports_with_reaction"))


def total_reports(reports: DataFrame, staged: bool = False) -> DataFrame:
    """Distinct reports in the universe, as one row.

    ``staged`` reports hold one row per id already: their ids are counted, not shuffled.
    """
    count = F.count("report_id") if staged else F.countDistinct("report_id")
    return reports.agg(count.alias("total_report_count"))
