"""Search by part of a name through the index, against the plain search."""

import pytest
from pyspark.sql import functions as F

from samples import rows
from vigilspark.functions.predicates import contains_ci
from vigilspark.plans import name_index as N

NAMES = ["Aspirin", "aspirin forte", "Ibuprofen", "IBU 400", "Paracetamol", "Straße", "a%b", "x_y_z", "ab", "", "Aspirin", None, "pirin asp", "back\\slash"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    mart = spark.createDataFrame([(n, i) for i, n in enumerate(NAMES)], "drug_name string, v int")
    N.write_index(mart, path)
    return path, mart


@pytest.mark.parametrize("pattern", ["spiri", "ASPIRIN", "a", "ibu", "IBU%0", "x_y", "%", "strasse", "ss", "asp%pirin", "nothing", "a%b", "pirin asp", "k\\s", "aspirin fort_"])
@pytest.mark.parametrize("few", [N.FEW, 0])
def test_same_rows(index, spark, pattern, few):
    path, mart = index
    assert rows(N.rows_by_name(spark, path, pattern, few=few)) == rows(mart.where(contains_ci("drug_name", pattern)))


def test_the_scan_of_the_mart_is_pruned(spark, tmp_path):
    mart = spark.range(4000).select(F.concat(F.lit("drug "), F.lpad(F.col("id").cast("string"), 5, "0")).alias("drug_name"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        N.write_index(mart, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = N.rows_by_name(spark, str(tmp_path), "G 0123")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(drug_name" in plan.replace("IsNotNull(drug_name), ", "")
    assert rows(found, "id") == [(i,) for i in range(1230, 1240)]
    touched = found.select(F.input_file_name()).distinct().count()
    assert touched == 1 < spark.read.parquet(f"{tmp_path}/mart").select(F.input_file_name()).distinct().count()
