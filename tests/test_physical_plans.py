"""Plans that must hold at scale."""

from vigilspark.catalog import bindings as b
from vigilspark.catalog import documents as D
from vigilspark.catalog import signals as G
from vigilspark.operators.tally import tally_reports
from vigilspark.plans import consumers as C
from vigilspark.plans import marts as M
from vigilspark.plans import reports as R
from vigilspark.plans.signals import contingency_cells
from vigilspark.session import pin

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "CartesianProduct" not in text
    return text


def test_newest_row_is_limited_before_the_shuffle(spark):
    text = plan(D.staged(spark, SF))
    final, partial = text.index("row_number(), 1, Final"), text.index("row_number(), 1, Partial")
    assert final < text.index("Exchange hashpartitioning(report_id") < partial
    assert text.count("parseJson") == 1


def test_tally_of_stored_reports_reads_two_arrays_and_shuffles_pairs_once(spark, tmp_path):
    D.staged(spark, SF).write.parquet(f"{tmp_path}/staged")
    text = plan(tally_reports(spark.read.parquet(f"{tmp_path}/staged")))
    # one shuffle of partial counts, one for reports that are cut up (skipped by file statistics)
    assert text.count("Exchange hashpartitioning(drug_name") == 1 and text.count("Exchange") == 2
    assert "PushedFilters: [IsNotNull(pair_volume), GreaterThan(pair_volume,4194304)]" in text
    assert "ReadSchema: struct<drug_names:array<string>,reaction_terms:array<string>,pair_volume:bigint>" in text
    children = plan(R.report_drugs(spark.read.parquet(f"{tmp_path}/staged")).select("report_id", "drug_name"))
    assert "Exchange" not in children and "reactions" not in children


def test_tally_of_children_shuffles_each_side_once(spark):
    text = plan(G.tally(spark, SF))
    assert text.count("Join") == 3  # two lookups of the part, one join inside the report
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    assert text.count("Exchange hashpartitioning(report_id") == 2
    assert text.count("Exchange hashpartitioning(drug_name") == 1 and text.count("partial_count") == 1


def test_cells_use_small_joins_only(spark):
    text = plan(contingency_cells(pin(G.tally(spark, SF)), b.reports(spark, SF), 50))
    assert "SortMergeJoin" in text or "BroadcastHashJoin" in text
    assert "lineitem" not in text


def test_top_k_and_pushdown(spark, tmp_path):
    G.signals(spark, SF).write.parquet(f"{tmp_path}/s")
    text = plan(C.search_signals(spark.read.parquet(f"{tmp_path}/s"), min_reports=60))
    assert "TakeOrderedAndProject" in text and "GreaterThanOrEqual(report_count,60)" in text


def test_drug_stats_shuffle_partial_sums(spark):
    assert plan(M.drug_stats_of_reports(D.staged(spark, SF))).count("Exchange hashpartitioning(drug_name") == 1
