"""Tasks grow in number with the input, and costly expressions are evaluated once."""

import glob
import threading

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vigilspark.catalog import bindings, ingest
from vigilspark.functions.semistructured import parse, path
from vigilspark.operators.quality import dq_unique
from vigilspark.operators.tally import tally_pairs
from vigilspark.plans import refresh
from vigilspark.plans import reports as R
from vigilspark.session import side_by_side
from vigilspark.sources import raw as S
from vigilspark.streaming import batches as B

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_built_by_tasks_of_bounded_rows(spark, monkeypatch):
    orders = bindings.table(spark, SF, "orders").count()
    monkeypatch.setattr(bindings, "ROWS_PER_TASK", orders // 40)
    assert bindings.documents(spark, SF).rdd.getNumPartitions() >= 40


def test_many_parts_are_not_broadcast(spark, tmp_path):
    """Rows of a few bytes each in the file, of many in the driver's memory."""
    def built(parts):
        sf = f"{tmp_path}/{parts}"
        spark.range(parts).selectExpr("id AS p_partkey", "cast(id % 50 AS int) AS p_size", "'widget' AS p_name").write.parquet(f"{sf}/part.parquet")
        spark.range(3 * parts).selectExpr("id AS l_orderkey", "xxhash64(id) AS l_suppkey", f"pmod(xxhash64(id, 1), {parts}) AS l_partkey").write.parquet(f"{sf}/lineitem.parquet")
        return bindings.reactions(spark, sf)
    many, few = built(1_200_000), built(1_000)
    assert "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in few._jdf.queryExecution().executedPlan().toString()
    assert many.count() == 3_600_000 and few.count() == 3_000


def test_files_are_judged_once(spark):
    files = spark.createDataFrame([("a.json", '{"x":1}'), ("b.json", '{"x":'), ("c.txt", "{}"), (None, "[]")], "file_name string, content string")
    good, bad = S.split_valid(files)
    assert [r.file_name for r in good.collect()] == ["a.json"]
    # without a name there is no verdict on it: neither side has the file
    assert {r.file_name: r.content for r in bad.collect()} == {"b.json": '{"x":', "c.txt": "{}"}
    assert "from_json" not in plan(good) + plan(bad)


def test_uniqueness_extracts_a_value_once(spark):
    docs = spark.range(9).select(parse(F.concat(F.lit('{"id":'), F.col("id") % 4, F.lit("}"))).alias("doc"))
    ids = docs.select(F.when(path("doc", "$.id") != "3", path("doc", "$.id")).alias("id"))
    found = dq_unique(ids, "id")
    assert {tuple(r) for r in found.collect()} == {("0", 3), ("1", 2), ("2", 2)}
    assert "isnotnull(CASE" not in plan(found) and "Filter" not in plan(found).split("Aggregate", 1)[1]


def test_pairs_that_lie_by_report_are_tallied_where_they_lie(spark, monkeypatch):
    monkeypatch.setattr(bindings, "LINES_PER_TASK", 100)
    pairs = bindings.line_pairs(spark, SF)
    assert pairs.rdd.getNumPartitions() >= bindings.table(spark, SF, "lineitem").count() // 100
    own = tally_pairs(spark.createDataFrame(
        [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (1, None, "x"), (2, None, "y"), (None, "a", "x")],
        "report_id long, drug_name string, reaction_term string"))
    assert {tuple(r) for r in own.collect()} == {("a", "x", 1, 1, 1), ("a", "y", 1, 0, 1), (None, "x", 1, 1, 0), (None, "y", 1, 1, 1)}
    assert "Join" not in plan(own)


def test_files_are_put_together_where_documents_lie(spark, monkeypatch, tmp_path):
    orders = bindings.table(spark, SF, "orders").count()
    monkeypatch.setattr(bindings, "ROWS_PER_TASK", orders // 40)
    monkeypatch.setattr(ingest, "DOCS_PER_FILE", 7)
    docs = bindings.dealt_documents(spark, SF)
    assert docs.rdd.getNumPartitions() >= 40
    bodies = ingest.file_bodies(docs.where("doc_key % 2 = 1"))
    physical = bodies._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange") == 1 and "to_json" not in physical.split("Exchange", 1)[1]    # orders travel, documents do not
    ingest.write_files(docs, f"{tmp_path}/in")
    files = S.read_files(spark, f"{tmp_path}/in")
    assert files.count() >= docs.count() / 7
    read = S.documents(files)
    assert read.count() == docs.count()
    ids = lambda raw: sorted(str(r[0]) for r in raw.select(R.report_id("raw_json")).collect())
    assert ids(read) == ids(bindings.raw(spark, SF))


HISTORY = [("a", 0, "2024-01-01", 1), ("a", 1, "2024-01-02", 2), ("b", 0, "2024-01-03", 3), ("b", 2, "2024-01-01", 4), ("c", 1, None, 5),
           ("c", 2, "2024-01-01", 1), ("d", 1, "2024-01-01", 6), ("d", 2, "2024-01-01", 6), ("e", 2, None, 7)]


def test_superseded_versions_are_left_out_by_a_narrow_table(spark):
    staged = spark.createDataFrame(HISTORY, "report_id string, batch_id int, at string, file_id long").selectExpr(
        "report_id", "batch_id", "cast(at AS timestamp) AS src_ld_ts", "file_id", "repeat('x', 100) AS wide")
    kept = B.without_superseded(staged)
    assert kept.columns == staged.columns
    assert sorted((r.report_id, r.batch_id) for r in kept.collect()) == [("a", 1), ("b", 0), ("c", 2), ("d", 2), ("e", 2)]
    assert {tuple(r) for r in kept.collect()} == {tuple(r) for r in B.current_reports(staged).collect()}
    assert "Window" not in plan(kept)


def test_flat_arrays_are_made_behind_the_shuffles(spark):
    raw = bindings.raw(spark, SF)
    assert "drug_names" not in R.newest_reports(raw).columns
    text = plan(R.stage_reports(raw))
    assert "drug_names" in text.split("Window", 1)[0] and "drug_names" not in text.split("Window", 1)[1]
    assert R.stage_reports(raw).schema == R.extract_report(raw).schema


def test_a_build_of_one_batch_ranks_no_versions(spark, tmp_path):
    out, raw = f"{tmp_path}/out", bindings.raw(spark, SF)
    refresh.build_tables(spark, raw, out, "incremental", children=())
    staged = B.read_closed(spark, out, "staged")
    assert "Window" not in plan(refresh._changes(spark, out, staged, [0], False))
    refresh.build_tables(spark, raw, out, "incremental", children=())       # nothing is new
    done = {r.batch_id: r.mark for r in B.read_table(spark, out, "done").collect()}
    assert done[1] is None and done[0].file_id is not None
    newest = raw.selectExpr("max(struct(ingestion_timestamp, file_id)) AS m").first()[0]
    assert (done[0].ingestion_timestamp, done[0].file_id) == tuple(newest)
    marks = {r.batch_id: r.file_id for r in B.read_table(spark, out, "load_marks").collect()}
    assert marks[0] == marks[1] == raw.selectExpr("max(file_id)").first()[0]


def test_a_history_stores_documents_whole(spark, tmp_path):
    bodies = ['{"id":"a","n":[1.50,{"x":null}]}', '[{"id":"b"},{"id":7,"n":{"x":"1"}}]', "[3]", "null", "{"]
    files = spark.createDataFrame([(f"{i}.json", b) for i, b in enumerate(bodies)], "file_name string, content string").repartition(1)
    out = f"{tmp_path}/out"
    B.load_batch(files, B.open_batch(spark, out), out)
    stored = glob.glob(f"{out}/loads/batch_id=0/*.parquet")
    assert stored and not any("typed_value" in str(pq.ParquetFile(f).schema) for f in stored)
    text = lambda rows: sorted((r[0], r[1] or "") for r in rows.select("file_name", F.to_json("raw_json")).collect())
    assert text(B.read_batch(spark, out, "loads", 0)) == text(S.load_rows(files))


def test_independent_steps_run_at_the_same_time(spark):
    met = threading.Barrier(3, timeout=60)
    groups = []

    def step():
        met.wait()
        spark.range(3).count()
        groups.append(spark.sparkContext.getLocalProperty("spark.jobGroup.id"))

    def broken():
        met.wait()
        raise ValueError("broken")

    spark.sparkContext.setJobGroup("together", "steps of one caller")
    try:
        with pytest.raises(ValueError, match="broken"):
            side_by_side(spark, step, broken, step)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.sparkContext.setLocalProperty("spark.job.description", None)
    assert groups == ["together", "together"]       # all were waited for, and keep what cancels them
    side_by_side(spark)


def test_children_of_a_batch_are_written_at_the_same_time(spark, tmp_path, monkeypatch):
    met, write = threading.Barrier(len(B.CHILDREN), timeout=60), B._write
    out = f"{tmp_path}/out"
    B.stage_batch(bindings.raw(spark, SF), 0, out)
    monkeypatch.setattr(B, "_write", lambda rows, path: (met.wait(), write(rows, path)))
    B.children_batch(B.read_batch(spark, out, "staged", 0), 0, out)
    for name, rows in B.CHILDREN.items():
        assert B.read_batch(spark, out, name, 0).count() == rows(B.read_batch(spark, out, "staged", 0)).count() > 0
