"""Registered queries: names, SQL, whole tables."""

import pytest

import __spark_entry__ as entry
import oracle

SF = "/root/testdata/sf0.001"


def test_names():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} <= {q.split("_")[0] + "_" for q in names}
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op3_decontamination", "op4_quality_rules", "op13_prefix_trie"])
def test_matches_sql(spark, name):
    _, difference = oracle.compare(spark, oracle.connect(SF), name, SF)
    assert difference is None, difference


@pytest.mark.parametrize("name", ["op1_pii", "op2_sentencepiece", "op5_simhash", "op7_suffix_dedup", "op8_secrets", "op10_licenses", "op12_lm_scoring"])
def test_one_row_per_document(spark, name):
    df = entry.queries()[name](spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert df.count() == n == df.select("doc_id").distinct().count()


@pytest.mark.parametrize("name", ["op3_decontamination", "op4_quality_rules"])
def test_native_plans_hold_no_python(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
