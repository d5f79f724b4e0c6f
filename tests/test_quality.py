"""Each rule passes clean tables and finds its planted violation."""

import pytest
from pyspark.sql import functions as F

from samples import doc, raw, rows
from vigilspark.operators import quality as Q
from vigilspark.plans import reports as R
from vigilspark.plans.signals import risk_signals_of_reports

AS_OF = "2024-02-01 12:00:00"


@pytest.fixture(scope="module")
def clean(spark):
    docs = [doc(f"A{i}", [{"medicinalproduct": "x", "drugcharacterization": 1}], ["r"]) for i in range(55)]
    docs += [doc(f"B{i}", ["y"], ["r"]) for i in range(5)]
    table = raw(spark, docs).cache()
    staged = R.stage_reports(table).cache()
    return {"raw": table, "reports": R.reports(staged).cache(), "report_drugs": R.report_drugs(staged).cache(),
            "report_reactions": R.report_reactions(staged).cache(), "pairs": R.pairs_of_reports(staged).cache(),
            "signals": risk_signals_of_reports(staged).cache()}


def failing(tables):
    return {(r.rule, r.table_name, r.column_name): r.failures
            for r in Q.dq_suite(tables, AS_OF).collect() if r.status != "PASS"}


def test_declared_rules():
    kinds = [r.kind for r in Q.RULES]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 25, "unique": 5, "accepted_values": 4, "relationships": 1, "expression": 3, "not_negative": 2}


def test_clean_tables_pass(clean):
    assert Q.dq_suite(clean, AS_OF).count() == 41
    assert failing(clean) == {}


def violate(rule, df):
    """One bad row added to a table (for unique: one row repeated)."""
    if rule.kind == "unique":
        return df.unionByName(df.limit(1))
    value = {"not_null": F.lit(None), "accepted_values": F.lit("9"), "expression": F.lit("-1"),
             "relationships": F.lit("nobody"), "not_negative": F.lit("-0.5")}[rule.kind]
    type_ = df.schema[rule.column].dataType
    bad = df.limit(1).withColumn(rule.column, value.cast(type_))
    keep = [r.column for r in Q.RULES if r.kind == "unique" and r.table == rule.table]
    for key in keep:
        if key != rule.column:
            bad = bad.withColumn(key, F.lit("777").cast(df.schema[key].dataType))
    return df.unionByName(bad)


@pytest.mark.parametrize("rule", Q.RULES, ids=lambda r: f"{r.table}-{r.column}-{r.kind}")
def test_planted_violation_is_found(clean, rule):
    tables = {rule.table: violate(rule, clean[rule.table])}
    if rule.parent:
        tables[rule.parent[0]] = clean[rule.parent[0]]
    found = failing(tables)
    assert found.get((rule.kind, rule.table, rule.column)) == 1


def test_where_limits_uniqueness(spark):
    df = spark.createDataFrame([("a", "1800-01-01"), ("a", "1800-01-01"), ("b", "2024-01-01")],
                               "k string, t string").withColumn("src_ld_ts", F.col("t").cast("timestamp"))
    assert rows(Q.dq_unique(df, "k")) == [("a", 2)]
    assert Q.dq_unique(df, "k", Q.LOADED).count() == 0


def test_nulls_pass_value_rules(spark):
    df = spark.createDataFrame([(None,), (1,), (500,)], "v int")
    assert rows(Q.dq_accepted(df, "v", [1])) == [(500,)]
    assert rows(Q.dq_expr(df, "v", "BETWEEN 0 AND 120")) == [(500,)]
    assert Q.dq_not_negative(df, "v").count() == 0
    assert rows(Q.dq_not_null(df, "v")) == [(None,)]


def test_relationship_rows(spark):
    child = spark.createDataFrame([("a",), ("z",), ("z",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    assert rows(Q.dq_rel(child, "k", parent, "id")) == [("z", 2)]


@pytest.mark.parametrize("hours, status", [(23, "PASS"), (24, "PASS"), (25, "WARN"), (48, "WARN"), (49, "ERROR")])
def test_freshness(spark, hours, status):
    df = spark.sql(f"SELECT timestamp'2024-02-01 00:00:00' - INTERVAL '{hours}' HOUR AS t")
    assert Q.dq_fresh(df, "t", as_of="2024-02-01 00:00:00").first().status == status
    assert Q.dq_fresh(df.limit(0), "t", as_of="2024-02-01").first().status == "ERROR"


def test_row_local_rules_are_counted_while_a_table_is_written(clean, tmp_path):
    """Same outcomes as by scans, planted violations among them, and no scan for them in the plan."""
    for n, rule in enumerate([r for r in Q.RULES if r.bad is not None][::6]):
        df = violate(rule, clean[rule.table])
        path = f"{tmp_path}/{n}"
        counts = Q.write_checked(df, path, rule.table)
        written = df.sparkSession.read.schema(df.schema).parquet(path)
        rules = [r for r in Q.RULES if r.bad is not None]
        got = Q.dq_suite({rule.table: written}, rules=rules, counted={rule.table: counts}, as_of="2024-02-01")
        assert rows(got) == rows(Q.dq_suite({rule.table: written}, rules=rules, as_of="2024-02-01"))
        assert counts[f"{rule.kind} {rule.column}"] == 1
        if rule.table != "raw":
            assert "Scan parquet" not in got._jdf.queryExecution().executedPlan().toString()


def test_uniqueness_by_hash(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), (None, 5), ("c", 6), ("c", 7), ("c", 8)], "k string, v int")
    assert rows(Q.dq_unique_by_hash(df, "k")) == rows(Q.dq_unique(df, "k")) == [("a", 2), ("c", 3)]
    assert rows(Q.dq_unique_by_hash(df, "k", "v > 1")) == [("c", 3)]
