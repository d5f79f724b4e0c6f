"""Data-quality rules.  Each rule returns its failing rows (or values)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import run_timestamp
from ..schemas import FILE_STATUSES, MIN_PAIR_REPORTS, SIGNAL_STRENGTHS
from ..session import one_row

LOADED = "src_ld_ts > '1900-01-01'"


# --- failing rows ----------------------------------------------------------


def dq_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def dq_unique(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    """Non-NULL values that occur more than once, with their number of rows.

    NULLs are dropped after the count, in a condition that also needs it: a plain null check would be moved below
    the projection that extracts the value and make Spark extract it twice.
    """
    rows = df.filter(where) if where else df
    repeats = F.col("n_records") > 1
    return rows.groupBy(col).agg(F.count("*").alias("n_records")).filter(F.when(F.col(col).isNotNull(), repeats))


def dq_unique_by_hash(df: DataFrame, col: str, where: str | None = None) -> DataFrame:
    """The same values, found by two scans: hashes travel, not the values, and only rows whose hash repeats are compared."""
    rows = df.filter(where) if where else df
    rows = rows.filter(F.col(col).isNotNull()).select(col, F.xxhash64(col).alias("_h"))
    suspect = rows.groupBy("_h").agg(F.count("*").alias("_n")).filter("_n > 1").select("_h")
    return dq_unique(rows.join(suspect, "_h", "left_semi"), col)


def dq_accepted(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows with a value outside the list; NULL passes."""
    return df.filter(~F.col(col).isin(values))


def dq_rel(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL child keys without a parent, with their number of rows.

    Child keys are counted before the join, so a frequent key is one row in it.
    """
    keys = child.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n_records"))
    parents = parent.select(F.col(field).alias(col)).distinct()
    return keys.join(parents, col, "left_anti")


def dq_expr(df: DataFrame, col: str, expression: str) -> DataFrame:
    """Rows for which ``col <expression>`` is false; NULL passes."""
    return df.filter(f"NOT ({col} {expression})")


def dq_not_negative(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) < 0)


def dq_fresh(df: DataFrame, ts: str, warn_h: int = 24, error_h: int = 48,
             as_of: datetime | str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Age of the newest load in hours and PASS / WARN / ERROR, for the table or each group ``by``.

    An empty table is an ERROR.
    """
    newest = df.groupBy(*by).agg(F.max(F.col(ts).cast("timestamp")).alias("max_loaded_at"))
    age = (F.unix_micros(run_timestamp(as_of)) - F.unix_micros("max_loaded_at")) / F.lit(3_600_000_000)
    return newest.select(*by, "max_loaded_at", age.alias("age_hours")).withColumn(
        "status",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_h), "ERROR")
        .when(F.col("age_hours") > warn_h, "WARN").otherwise("PASS"))


# --- the declared suite ----------------------------------------------------


@dataclass(frozen=True)
class Rule:
    kind: str
    table: str
    column: str
    bad: Callable[[str], Column] | None = None   # row-local rules
    where: str | None = None                     # unique
    parent: tuple[str, str] | None = None        # relationships


def _not_null(table: str, *cols: str) -> list[Rule]:
    return [Rule("not_null", table, c, lambda x: F.col(x).isNull()) for c in cols]


def _accepted(table: str, col: str, values: list) -> Rule:
    return Rule("accepted_values", table, col, lambda x: ~F.col(x).isin(values))


def _between(table: str, col: str, low: int, high: int) -> Rule:
    return Rule("expression", table, col, lambda x: ~F.col(x).between(low, high))


def _not_negative(table: str, col: str) -> Rule:
    return Rule("not_negative", table, col, lambda x: F.col(x) < 0)


# The declared assertions of the raw, report, child and signal tables.
RULES: list[Rule] = [
    Rule("unique", "raw", "file_id"),
    *_not_null("raw", "file_id", "file_name", "ingestion_timestamp", "raw_json"),
    _accepted("raw", "file_status", FILE_STATUSES),
    Rule("unique", "reports", "report_id", where=LOADED),
    *_not_null("reports", "report_id", "received_date"),
    _between("reports", "patient_age", 0, 120),
    _between("reports", "patient_age_years", 0, 120),
    *_not_null("reports", "patient_sex"),
    _accepted("reports", "patient_sex", [0, 1, 2]),
    *_not_null("reports", "src_ld_ts", "source_file"),
    Rule("unique", "report_drugs", "report_drug_id", where=LOADED),
    *_not_null("report_drugs", "report_drug_id", "report_id"),
    Rule("relationships", "report_drugs", "report_id", parent=("reports", "report_id")),
    *_not_null("report_drugs", "drug_name"),
    _accepted("report_drugs", "drug_characterization", [1, 2, 3]),
    *_not_null("report_drugs", "drug_sequence"),
    Rule("unique", "report_reactions", "report_reaction_id", where=LOADED),
    *_not_null("report_reactions", "report_reaction_id", "report_id", "reaction_term",
               "reaction_sequence"),
    Rule("unique", "pairs", "drug_reaction_pair_id", where=LOADED),
    *_not_null("pairs", "drug_reaction_pair_id", "report_id", "drug_name", "reaction_term"),
    *_not_null("signals", "drug_name", "reaction_term", "report_count"),
    Rule("expression", "signals", "report_count", lambda x: ~(F.col(x) >= MIN_PAIR_REPORTS)),
    _not_negative("signals", "ror"),
    _not_negative("signals", "prr"),
    _accepted("signals", "signal_strength", SIGNAL_STRENGTHS),
    *_not_null("signals", "is_significant_signal"),
]


def _outcome(kind: Column, table: str, column: Column, failures: Column) -> list[Column]:
    return [kind.alias("rule"), F.lit(table).alias("table_name"), column.alias("column_name"),
            failures.cast("long").alias("failures")]


def _row_local(df: DataFrame, table: str, rules: list[Rule]) -> DataFrame:
    """All row-local rules of a table from one scan."""
    counts = df.agg(*[F.count_if(r.bad(r.column)).alias(f"_{i}") for i, r in enumerate(rules)])
    rows = F.array(*[
        F.struct(*_outcome(F.lit(r.kind), table, F.lit(r.column), F.col(f"_{i}")))
        for i, r in enumerate(rules)])
    return counts.select(F.inline(rows))


def write_checked(df: DataFrame, path: str, table: str, rules: list[Rule] | None = None) -> dict[str, int]:
    """Write ``df`` as the stored ``table`` and count the failures of its row-local rules on the way.

    Returns ``{"kind column": failures}`` for :func:`dq_suite`: the rules cost no scan of their own.
    The counts are those of the write's own job, so they hold for the rows that were written.
    """
    local = [r for r in (rules or RULES) if r.table == table and r.bad is not None]
    if not local:
        df.write.parquet(path)
        return {}
    seen = Observation(f"rules of {table}")
    counts = [F.count_if(r.bad(r.column)).alias(f"_{i}") for i, r in enumerate(local)]
    df.observe(seen, *counts).write.parquet(path)
    return {_named(r): seen.get[f"_{i}"] for i, r in enumerate(local)}


def _named(rule: Rule) -> str:
    return f"{rule.kind} {rule.column}"


def _counted(spark: SparkSession, table: str, rules: list[Rule], counts: dict[str, int]) -> DataFrame:
    rows = [F.struct(*_outcome(F.lit(r.kind), table, F.lit(r.column), F.lit(counts[_named(r)]))) for r in rules]
    return one_row(spark, rows=F.array(*rows)).select(F.inline("rows"))


def dq_suite(tables: dict[str, DataFrame], as_of: datetime | str | None = None,
             rules: list[Rule] | None = None, counted: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """``(rule, table_name, column_name, failures, status)`` over the given tables.

    ``counted`` holds, by table, the failures that :func:`write_checked` has counted; the row-local
    rules of other tables take one scan each.  Tables absent from ``tables`` are left out together with their rules; the
    load-time rule runs when the raw table is given.
    """
    rules = [r for r in (rules or RULES) if r.table in tables]
    parts: list[DataFrame] = []
    for table, df in tables.items():
        local = [r for r in rules if r.table == table and r.bad is not None]
        if local and table in (counted or {}):
            parts.append(_counted(df.sparkSession, table, local, counted[table]))
        elif local:
            parts.append(_row_local(df, table, local))
        for r in rules:
            if r.table != table or r.bad is not None:
                continue
            if r.kind == "unique":
                failing = dq_unique_by_hash(df, r.column, r.where)
            else:
                parent, field = r.parent
                if parent not in tables:
                    continue
                failing = dq_rel(df, r.column, tables[parent], field)
            n = F.count("*") if r.kind == "unique" else F.coalesce(F.sum("n_records"), F.lit(0))
            parts.append(failing.agg(n.alias("_n")).select(
                *_outcome(F.lit(r.kind), table, F.lit(r.column), F.col("_n"))))
    results = reduce(DataFrame.unionByName, parts).withColumn(
        "status", F.when(F.col("failures") > 0, "FAIL").otherwise("PASS"))
    if "raw" in tables:
        fresh = dq_fresh(tables["raw"], "ingestion_timestamp", as_of=as_of)
        results = results.unionByName(fresh.select(
            F.lit("freshness").alias("rule"), F.lit("raw").alias("table_name"),
            F.lit("ingestion_timestamp").alias("column_name"),
            F.when(F.col("status") == "PASS", 0).otherwise(1).cast("long").alias("failures"),
            "status"))
    return results
