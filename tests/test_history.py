"""One history for streams, increments, purges and compaction; marts by changes; keyed tables."""

import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

import vigilspark.plans.refresh as refresh
import vigilspark.streaming.ingest as ingest
from samples import doc, raw, rows
from vigilspark.plans.refresh import build_marts, build_tables, read_mart
from vigilspark.sources import bucketed as L
from vigilspark.sources import keyed as K
from vigilspark.streaming import batches as B
from vigilspark.streaming.ingest import stream_ingest


def put(folder, name, *docs):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        json.dump(list(docs), f)


def stream(spark, root, out="out", progress="p", day="2024-02-01", into="in", **kw):
    stream_ingest(spark, f"{root}/{into}", f"{root}/{out}", f"{root}/{progress}", as_of=day, **kw).awaitTermination()


def ids(spark, out):
    return rows(B.read_current(spark, out), "report_id")


def pairs(spark, out):
    return rows(read_mart(spark, out, "pair_report_counts"))


def test_marts_of_a_streamed_folder(spark, tmp_path):
    put(f"{tmp_path}/in", "a.json", doc("a", ["x", "y"], ["r"]), doc("b", ["x"], ["r"]))
    stream(spark, tmp_path)
    build_marts(spark, f"{tmp_path}/out", min_reports=1)
    assert pairs(spark, f"{tmp_path}/out") == [("x", "r", 2), ("y", "r", 1)]
    put(f"{tmp_path}/in", "b.json", doc("a", ["x"], ["r"]))           # loses a drug
    stream(spark, tmp_path, day="2024-02-02")
    build_marts(spark, f"{tmp_path}/out", min_reports=1)
    assert pairs(spark, f"{tmp_path}/out") == [("x", "r", 2)]
    build_tables(spark, raw(spark, [(doc("c", ["z"], ["s"]), "2020-01-01")], first_id=900), f"{tmp_path}/out", "incremental", min_reports=1)
    assert pairs(spark, f"{tmp_path}/out") == [("x", "r", 2), ("z", "s", 1)]      # an increment beside the stream
    assert rows(read_mart(spark, f"{tmp_path}/out", "drug_summary"), "drug_name", "total_reports") == [("x", 2), ("z", 1)]


def test_a_new_checkpoint_goes_on_after_compaction(spark, tmp_path):
    put(f"{tmp_path}/in", "a.json", doc("a", ["x"], ["r"]), doc("b", ["x"], ["r"]), doc("c", ["x"], ["r"]))
    stream(spark, tmp_path)
    B.compact(spark, f"{tmp_path}/out", f"{tmp_path}/small")
    before = B.read_closed(spark, f"{tmp_path}/small", "loads").agg(F.max("file_id")).first()[0]
    put(f"{tmp_path}/more", "d.json", doc("d", ["x"], ["r"]))
    stream(spark, tmp_path, out="small", progress="other", into="more", day="2024-02-02")
    out = f"{tmp_path}/small"
    assert ids(spark, out) == [("a",), ("b",), ("c",), ("d",)]
    loads = B.read_closed(spark, out, "loads")
    assert loads.where("batch_id > 0").agg(F.min("file_id")).first()[0] > before
    assert B.outcomes_of(loads).count() == 2
    stream(spark, tmp_path, out="small")                              # the old checkpoint has nothing new
    put(f"{tmp_path}/in", "e.json", doc("a", ["y"], ["r"]))
    stream(spark, tmp_path, out="small", day="2024-02-03")
    assert rows(B.read_current(spark, out, "report_drugs").where("report_id = 'a'"), "drug_name") == [("y",)]


def test_a_batch_between_staging_and_children_is_not_seen(spark, tmp_path, monkeypatch):
    put(f"{tmp_path}/in", "a.json", doc("a", ["x"], ["r"]))
    stream(spark, tmp_path)
    put(f"{tmp_path}/in", "b.json", doc("a", ["y"], ["r"]), doc("b", ["y"], ["r"]))
    whole = ingest.children_batch
    monkeypatch.setattr(ingest, "children_batch", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stop")))
    with pytest.raises(Exception, match="stop"):
        stream(spark, tmp_path, day="2024-02-02")
    out = f"{tmp_path}/out"
    assert B.read_table(spark, out, "staged").count() == 3             # written, not closed
    assert ids(spark, out) == [("a",)] and rows(B.read_current(spark, out, "report_drugs"), "drug_name") == [("x",)]
    monkeypatch.setattr(ingest, "children_batch", whole)
    stream(spark, tmp_path, day="2024-02-02")
    assert ids(spark, out) == [("a",), ("b",)] and B.closed_ids(spark, out).count() == 2
    assert rows(B.read_current(spark, out, "report_drugs"), "report_id", "drug_name") == [("a", "y"), ("b", "y")]


def test_numbers_of_batches(spark, tmp_path):
    out = str(tmp_path)
    assert [B.open_batch(spark, out, "s", 0), B.open_batch(spark, out, "s", 0), B.open_batch(spark, out, "t", 0)] == [0, 0, 1]
    table = raw(spark, [doc("a")])
    B.close_batch(table, 1, out, "t", 0)
    assert B.open_batch(spark, out, "t", 0) is None                    # delivered again
    assert [B.open_batch(spark, out, "t", 1), B.open_batch(spark, out)] == [2, 3]
    assert B.after_done(table, out).count() == 1                       # a stream's mark does not hold an increment back


def test_a_folder_without_history_has_to_be_adopted(spark, tmp_path):
    put(f"{tmp_path}/in", "a.json", doc("a", ["x"], ["r"]))
    stream(spark, tmp_path)
    out = f"{tmp_path}/out"
    old = f"{tmp_path}/old"
    for name in ("loads", "load_marks", "staged", *B.CHILDREN):
        spark.read.parquet(f"{out}/{name}/batch_id=0").write.parquet(f"{old}/{name}/batch_id=0")
    put(f"{tmp_path}/in", "b.json", doc("b", ["x"], ["r"]))
    with pytest.raises(Exception, match="adopt"):
        stream(spark, tmp_path, out="old", progress="q")
    B.adopt(spark, old)
    stream(spark, tmp_path, out="old", progress="q", day="2024-02-02")
    assert ids(spark, old) == [("a",), ("b",)]


def test_purge_reaches_reports_children_marts_and_the_compacted_folder(spark, tmp_path):
    put(f"{tmp_path}/in", "real.json", doc("a", ["x"], ["r"]), doc("b", ["x"], ["r"]))
    put(f"{tmp_path}/in", "mock_1.json", doc("a", ["m"], ["r"]), doc("only", ["m"], ["r"]))     # same micro-batch
    stream(spark, tmp_path)
    put(f"{tmp_path}/in", "mock_2.json", doc("b", ["m"], ["s"]))
    stream(spark, tmp_path, day="2024-02-02")
    out = f"{tmp_path}/out"
    build_marts(spark, out, min_reports=1)
    newest = {r.report_id: r.source_file for r in B.read_current(spark, out).collect()}
    B.purge(spark, out, "mock_%")
    build_marts(spark, out, min_reports=1)
    assert newest["b"] == "mock_2.json" and ids(spark, out) == [("a",), ("b",)]
    assert {r.source_file for r in B.read_current(spark, out).collect()} == {"real.json"}
    want = [("a", "x"), ("b", "x")]
    assert rows(B.read_current(spark, out, "report_drugs"), "report_id", "drug_name") == want
    assert pairs(spark, out) == [("x", "r", 2)]
    assert {r.file_name for r in B.outcomes_of(B.read_closed(spark, out, "loads")).collect()} == {"real.json"}
    B.compact(spark, out, f"{tmp_path}/small")
    assert rows(spark.read.parquet(f"{tmp_path}/small/report_drugs"), "report_id", "drug_name") == want
    assert spark.read.parquet(f"{tmp_path}/small/loads").where("file_name LIKE 'mock%'").count() == 0
    build_marts(spark, f"{tmp_path}/small", min_reports=1)
    assert pairs(spark, f"{tmp_path}/small") == [("x", "r", 2)]
    put(f"{tmp_path}/in", "mock_3.json", doc("b", ["later"], ["r"]))      # loaded after the purge: stays
    stream(spark, tmp_path, day="2024-02-03")
    assert rows(B.read_current(spark, out, "report_drugs"), "drug_name") == [("later",), ("x",)]


def test_compaction_clusters_again(spark, tmp_path):
    days = [f"2024{m:02d}{d:02d}" for m in range(1, 13) for d in (1, 15)]
    for n in range(2):
        put(f"{tmp_path}/in", f"{n}.json", *[doc(f"{n}-{i}", ["x"], ["r"], receivedate=day) for i, day in enumerate(days * 20)])
        stream(spark, tmp_path, day=f"2024-02-0{n + 1}")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")     # small data, several files all the same
    try:
        B.compact(spark, f"{tmp_path}/out", f"{tmp_path}/small")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    month = lambda: spark.read.parquet(f"{tmp_path}/small/staged/batch_id=0").where("received_date < DATE '2024-02-01'")
    assert month().count() == 2 * 2 * 20
    touched = month().select(F.input_file_name().alias("f")).distinct().count()
    every = spark.read.parquet(f"{tmp_path}/small/staged/batch_id=0").select(F.input_file_name().alias("f")).distinct().count()
    assert touched == 1 < every


def test_a_later_version_with_an_older_load_time_changes_nothing(spark, tmp_path):
    out = str(tmp_path)
    build_tables(spark, raw(spark, [(doc("a", ["x"], ["r"]), "2024-02-05")]), out, "incremental", min_reports=1)
    put(f"{tmp_path}/in", "old.json", doc("a", ["y"], ["r"]))
    stream(spark, tmp_path, out=".", day="2024-01-01")
    build_marts(spark, out, min_reports=1)
    assert pairs(spark, out) == [("x", "r", 1)] and rows(read_mart(spark, out, "report_count")) == [(1,)]


def test_an_increment_reads_changed_reports_only(spark, tmp_path):
    out = str(tmp_path)
    build_tables(spark, raw(spark, [(doc(f"R{i}", ["x"], ["r"]), "2024-02-01") for i in range(200)]), out, "incremental", min_reports=1)
    read = []
    whole = refresh.lookup
    def seen(*a):
        df = whole(*a)
        read.append(df._jdf.queryExecution().executedPlan().toString())
        return df
    refresh.lookup = seen
    try:
        build_tables(spark, raw(spark, [(doc("R7", ["y"], ["r"]), "2024-02-02")], first_id=1000), out, "incremental", min_reports=1)
    finally:
        refresh.lookup = whole
    assert pairs(spark, out) == [("x", "r", 199), ("y", "r", 1)]
    assert "key_part" in read[0].split("PartitionFilters:")[1].split("]")[0]      # other partitions of the counted versions are not read
    changes = spark.read.parquet(f"{out}/marts/{refresh._published(spark, out)['run']}/changes")
    assert rows(changes, "report_id") == [("R7",)]


def test_marts_of_an_earlier_version_are_built_anew(spark, tmp_path):
    out = str(tmp_path)
    table = raw(spark, [(doc("a", ["x"], ["r"]), "2024-02-01")])
    B.stage_batch(table, 0, out)
    B.children_batch(B.read_batch(spark, out, "staged", 0), 0, out)
    spark.sql("SELECT named_struct('ingestion_timestamp', timestamp'2024-02-01', 'file_id', 1L) AS mark").write.parquet(f"{out}/done/batch_id=0")
    spark.sql("SELECT 7L AS number, 'old' AS run").write.parquet(f"{out}/published")
    spark.sql("SELECT 'x' AS drug_name, 'r' AS reaction_term, 1L AS report_count").write.parquet(f"{out}/marts/old/pair_report_counts")
    build_tables(spark, raw(spark, [(doc("a", ["y"], ["r"]), "2024-02-02"), (doc("b", ["x"], ["r"]), "2024-02-02")], first_id=5), out, "incremental", min_reports=1)
    assert pairs(spark, out) == [("x", "r", 1), ("y", "r", 1)]


@pytest.mark.parametrize("step", ["upsert_keyed", "write_keyed"])
def test_a_build_that_breaks_off_after_publishing(spark, tmp_path, monkeypatch, step):
    out = str(tmp_path)
    first, second = raw(spark, [(doc("a", ["x"], ["r"]), "2024-02-01")]), raw(spark, [(doc("a", ["y"], ["r"]), "2024-02-02")], first_id=5)
    whole = getattr(refresh, step)
    if step == "upsert_keyed":
        build_tables(spark, first, out, "incremental", min_reports=1)
        first = second
    monkeypatch.setattr(refresh, step, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stop")))
    with pytest.raises(RuntimeError):
        build_tables(spark, first, out, "incremental", min_reports=1)
    monkeypatch.setattr(refresh, step, whole)
    build_tables(spark, second, out, "incremental", min_reports=1)
    build_tables(spark, raw(spark, [(doc("a", ["z"], ["r"]), "2024-02-03")], first_id=9), out, "incremental", min_reports=1)
    assert pairs(spark, out) == [("z", "r", 1)]


# --- keyed tables ------------------------------------------------------------------


def files(path):
    return {f"{d}/{n}": os.stat(f"{d}/{n}").st_mtime_ns for d, _, names in os.walk(f"{path}/rows") for n in names if n.endswith(".parquet")}


def test_upsert_keeps_untouched_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    K.write_keyed(spark.range(100).selectExpr("id AS k", "'old' AS v"), path, "k", buckets=8)
    before = files(path)
    updates = spark.createDataFrame([(3, "new"), (500, "new")], "k long, v string")
    touched = K.upsert_keyed(spark, path, updates)
    after = files(path)
    assert 1 <= touched <= 2 and len({os.path.dirname(f) for f in before.keys() - after.keys()}) <= touched
    assert all(after[f] == before[f] for f in before.keys() & after.keys()) and len(before.keys() & after.keys()) >= 6
    got = dict(rows(K.read_keyed(spark, path)))
    assert got == {**{i: "old" for i in range(100)}, 3: "new", 500: "new"}
    assert rows(K.lookup(spark, path, updates.union(spark.sql("SELECT 77777L, 'x'")))) == [(3, "new"), (500, "new")]
    with pytest.raises(ValueError):
        K.write_keyed(updates, path, "k")


def test_delete_and_null_keys(spark, tmp_path):
    path = f"{tmp_path}/t"
    K.write_keyed(spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k long, v string"), path, "k", buckets=1)
    gone = spark.createDataFrame([(1, "?"), (2, "?"), (None, "B")], "k long, v string")
    K.upsert_keyed(spark, path, gone, F.col("k").isNotNull())
    assert rows(K.read_keyed(spark, path)) == [(None, "B")]
    K.upsert_keyed(spark, path, spark.createDataFrame([(None, "?")], "k long, v string"), F.lit(True))
    assert rows(K.read_keyed(spark, path)) == []                       # the partition is empty, not stale
    K.upsert_keyed(spark, path, spark.createDataFrame([(2, "back")], "k long, v string"))
    assert rows(K.read_keyed(spark, path)) == [(2, "back")]
    assert K.upsert_keyed(spark, path, gone.limit(0)) == 0


def test_an_upsert_that_broke_off_is_finished(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    K.write_keyed(spark.range(10).selectExpr("id AS k", "'old' AS v"), path, "k", buckets=2)
    whole = K._replace
    monkeypatch.setattr(K, "_replace", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
    with pytest.raises(RuntimeError):
        K.upsert_keyed(spark, path, spark.createDataFrame([(3, "new")], "k long, v string"))
    monkeypatch.setattr(K, "_replace", whole)
    assert dict(rows(K.read_keyed(spark, path)))[3] == "new" and K.read_keyed(spark, path).count() == 10
    assert not K.recover(spark, path)


# --- bucketed tables -------------------------------------------------------------------


def test_newest_versions_without_a_shuffle(spark, tmp_path):
    out, prefix = f"{tmp_path}/out", f"t{uuid.uuid4().hex}"
    first = [(doc(f"R{i}", ["x", "y"], ["r"]), "2024-02-01") for i in range(40)]
    build_tables(spark, raw(spark, first), out, "incremental", min_reports=1)
    assert L.sync(spark, out, prefix, buckets=4) == [0]
    second = [(doc(f"R{i}", ["z"], ["r"]), "2024-02-02") for i in range(0, 60, 3)]
    build_tables(spark, raw(spark, second, first_id=500), out, "incremental", min_reports=1)
    assert L.sync(spark, out, prefix, buckets=4) == [1] and L.sync(spark, out, prefix, buckets=4) == []
    reports, drugs = L.bucketed_reports(spark, prefix), L.bucketed_children(spark, prefix, "report_drugs")
    want = rows(B.read_current(spark, out, "report_drugs"), "report_id", "drug_name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")      # nothing is small at scale
    try:
        for df in (reports, drugs):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert rows(drugs, "report_id", "drug_name") == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(reports, "report_id") == rows(B.read_current(spark, out), "report_id")
    assert L.sync(spark, out, prefix, buckets=4, again=True) == [0, 1]      # copying again replaces
    assert rows(L.bucketed_children(spark, prefix, "report_drugs"), "report_id", "drug_name") == want
