"""One order and one part hold a third of the lines; one user a third of the events."""

import duckdb
import pytest

import oracle
from vigilspark.operators.tally import tally_children
from vigilspark.operators.within import join_within, large_keys

SOURCE = "/root/testdata/sf0.01"
HOT = {
    "lineitem": """CASE WHEN hash(l_extendedprice, l_suppkey) % 3 = 0 THEN 0 ELSE l_orderkey END AS l_orderkey,
                   CASE WHEN hash(l_tax, l_extendedprice) % 3 = 0 THEN 1 ELSE l_partkey END AS l_partkey""",
    "events": "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END AS user_id",
    "orders": """CASE WHEN o_orderkey % 3 = 1 THEN TIMESTAMP '1997-01-07' ELSE o_orderdate END
                 AS o_orderdate""",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in oracle.TABLES:
        replaced = f"* REPLACE ({HOT[name]})" if name in HOT else "*"
        con.execute(f"COPY (SELECT {replaced} FROM '{SOURCE}/{name}.parquet') "
                    f"TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", [
    "risk_signals", "risk_signals_sparse", "pair_report_counts", "drug_summary", "reaction_margin_counts",
    "dedupe_latest", "merge_upsert", "clustered_layout", "latest_file_id", "stream_stage_upsert"])
def test_hot_keys(spark, skewed, name):
    _, difference = oracle.compare(spark, oracle.connect(skewed), name, skewed)
    assert difference is None, difference


def test_a_report_large_on_one_side_meets_no_window(spark):
    """A third of all drug rows lie in a report without reactions."""
    drugs = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id % 500 END AS report_id", "concat('d', id % 7) AS drug_name")
    reactions = spark.range(1000).selectExpr("id % 500 AS report_id", "concat('r', id % 5) AS reaction_term")
    assert -1 in {r.report_id for r in large_keys(drugs, reactions, "report_id", 100).collect()}
    want = sorted(map(tuple, tally_children(drugs, reactions, block=1 << 30).collect()))
    assert sorted(map(tuple, tally_children(drugs, reactions, block=100).collect())) == want
    joined = join_within(drugs, reactions, "report_id", block=100)
    assert joined.count() == drugs.join(reactions, "report_id").count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = join_within(drugs, reactions, "report_id", block=100)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ENSURE_REQUIREMENTS" in plan
