"""Files, load metadata, streams and incremental refresh."""

import gzip
import json
import random
import shutil

import pytest
from pyspark.sql import functions as F

from samples import doc, raw, rows, seeded_docs
from vigilspark.catalog.ingest import write_single
from vigilspark.functions.semistructured import path
from vigilspark.operators.within import grid_join, join_within, large_keys
from vigilspark.plans import reports as R
from vigilspark.plans.refresh import build_tables, read_mart
from vigilspark.sources import raw as S
from vigilspark.sources import tables as T
from vigilspark.streaming import batches as B
from vigilspark.streaming.ingest import note_empty_files, stream_ingest


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    put(tmp_path, "one.json", doc("a"))
    put(tmp_path, "many.json", [doc("b"), doc("c")])
    put(tmp_path, "none.json", [])
    (tmp_path / "in" / "cut.json").write_text('{"x":')
    (tmp_path / "in" / "twice.json").write_text('{"a":1,"a":2}')
    (tmp_path / "in" / "empty.json").write_text(" ")
    (tmp_path / "in" / "zero.json").write_text("")
    put(tmp_path, "a.txt", doc("t"))
    return tmp_path


def put(folder, name, body):
    (folder / "in" / name).write_text(json.dumps(body))


def test_read_raw(spark, folder):
    got = S.read_raw(spark, f"{folder}/in", as_of="2024-02-01", start=10, dense=True)
    assert rows(got.select("file_name", R.report_id("raw_json"), "file_status")) == [
        ("many.json", "b", "PROCESSED"), ("many.json", "c", "PROCESSED"), ("one.json", "a", "PROCESSED")]
    assert rows(got, "file_id") == [(11,), (12,), (13,)]


@pytest.mark.parametrize("content, want", [
    ('{"a":1}', ['{"a":1}']), (' [ {"a":1} ,\n{"b":2} ] ', ['{"a":1}', '{"b":2}']), ("[]", []),
    ('[{"a":1},"plain text"]', ['{"a":1}', '"plain text"']), ('["{\\"a\\":1}"]', ['"{\\"a\\":1}"']),
    ("[1.00000000000000000000000000001]", ["1.00000000000000000000000000001"]), ("[null]", ["null"]), ("7", ["7"]),
    ('[[1],[2]]', ["[1]", "[2]"]), ('{"a":1}\n{"a":2}', None), ('{"a":1} }rest', None), ('[{"a":1}] [2]', None),
    ('[{"a":1}],[{"a":2}]', None), ('{"a":1},{"a":2}', None), ('[{"a":1},{"b":1,"b":2}]', None), ('{"a":1,"a":2}', None),
    ("{'a':1}", None), ('[{"a":NaN}]', None), ('{"a":1}/* */', None), ("[1,2", None), ("", None), (" ", None), (None, None)])
@pytest.mark.parametrize("padding", [0, 40 * 1024 * 1024])
def test_one_way_of_parsing(spark, content, want, padding):
    """The same documents whatever the size of the file."""
    if padding and content not in ('[{"a":1},"plain text"]', '{"a":1} }rest', '[1.00000000000000000000000000001]'):
        pytest.skip("large ones: one of each kind")
    files = spark.createDataFrame([("f.json", content, padding)], "file_name string, content string, n int").select(
        "file_name", F.concat(F.repeat(F.lit(" "), F.col("n")), "content").alias("content"))
    loaded = S.load_rows(files).orderBy("pos").select("outcome", F.to_json("raw_json")).collect()
    if want is None:
        assert [tuple(r) for r in loaded] == [("FAILED", None)]
    else:
        assert [tuple(r) for r in loaded] == ([("SUCCESS", w) for w in want] or [("SUCCESS", None)])
    good, bad = S.split_valid(files)
    assert (good.count(), bad.count()) == ((0, 1) if want is None else (1, 0))


def test_compressed_and_nested_files(spark, tmp_path):
    for name in ("a", "b c+d"):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "x.json.gz").write_bytes(gzip.compress(json.dumps(doc(name)).encode()))
    (tmp_path / "in" / "x.json").write_text("{")
    names = ["a/x.json.gz", "b c+d/x.json.gz", "x.json"]
    loaded = S.assign_file_id(S.load_rows(S.read_files(spark, f"{tmp_path}/in")))
    assert rows(S.ingest_report(loaded).select("file_name", "status")) == list(zip(names, ["SUCCESS", "SUCCESS", "FAILED"]))
    assert rows(S.read_raw(spark, f"{tmp_path}/in").select(R.report_id("raw_json"))) == [("a",), ("b c+d",)]
    stream_ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/p").awaitTermination()
    outcomes = B.outcomes_of(B.read_table(spark, f"{tmp_path}/out", "loads"))
    assert rows(outcomes.select("file_name", "status")) == list(zip(names, ["SUCCESS", "SUCCESS", "FAILED"]))


def test_a_batch_reads_no_earlier_loads(spark, tmp_path):
    out = str(tmp_path)
    for n in range(3):
        files = spark.createDataFrame([(f"{n}.json", json.dumps([doc(f"{n}-{i}") for i in range(3)]))], "file_name string, content string")
        B.load_batch(files, n, out)
        if n:      # only the mark of the batch before is needed
            shutil.rmtree(f"{out}/loads/batch_id={n - 1}")
            kept.append(read)
        read = rows(spark.read.parquet(f"{out}/loads/batch_id={n}"), "file_id")
        if not n:
            kept = []
    kept.append(read)
    ids = [i for k in kept for (i,) in k]
    assert len(ids) == len(set(ids)) == 9 and [max(k) for k in kept] == sorted(max(k) for k in kept)


def test_loads_without_marks_go_on(spark, tmp_path):
    out = str(tmp_path)
    for n in (0, 1, 2, 2):      # the last batch twice
        files = spark.createDataFrame([(f"{n}.json", json.dumps([doc(f"{n}-{i}") for i in range(3)]))], "file_name string, content string")
        shutil.rmtree(f"{out}/load_marks", ignore_errors=True)
        B.load_batch(files, n, out)
    ids = rows(B.read_table(spark, out, "loads"), "batch_id", "file_id")
    assert len({i for _, i in ids}) == len(ids) == 9
    assert [i for _, i in sorted(ids)] == sorted(i for _, i in ids)


def test_failure_between_staging_and_children(spark, tmp_path):
    table = raw(spark, [doc("a", ["x"], ["r"]), doc("b", ["y"], ["r"])])
    out = f"{tmp_path}/t"
    B.stage_batch(table, 0, out)                      # and nothing more
    for _ in range(2):
        build_tables(spark, table, out, "incremental", min_reports=1)
    staged = B.read_table(spark, out, "staged")
    for name in B.CHILDREN:
        assert B.current_children(B.read_table(spark, out, name), staged).count() == 2
    assert read_mart(spark, out, "risk_signals").count() == 2


def test_a_failed_full_refresh_can_be_repeated(spark, tmp_path):
    table = raw(spark, [doc("a", ["x"], ["r"])])
    B.stage_batch(table, 0, f"{tmp_path}/t")
    build_tables(spark, table, f"{tmp_path}/t", min_reports=1)
    assert read_mart(spark, f"{tmp_path}/t", "risk_signals").count() == 1


def test_equal_load_times_are_not_lost(spark, tmp_path):
    table = raw(spark, [(doc("a", ["x"], ["r"]), "2024-02-01"), (doc("b", ["y"], ["r"]), "2024-02-01")])
    out = f"{tmp_path}/t"
    build_tables(spark, table.filter("file_id = 1"), out, "incremental", min_reports=1)
    before = read_mart(spark, out, "risk_signals")
    build_tables(spark, table, out, "incremental", min_reports=1)
    assert rows(before, "drug_name") == [("x",)]          # a reader of the old marts is not disturbed
    assert rows(read_mart(spark, out, "risk_signals"), "drug_name") == [("x",), ("y",)]


def test_strict_reaches_children(spark, tmp_path):
    d = doc("a", ["x"], ["r"])
    d["safetyreport"][0]["patient"][0]["drug"][0]["drugcharacterization"] = "main"
    build_tables(spark, raw(spark, [d]), f"{tmp_path}/lax", min_reports=1)
    with pytest.raises(Exception, match="does not fit"):
        build_tables(spark, raw(spark, [d]), f"{tmp_path}/strict", min_reports=1, strict=True)
    assert rows(R.cast_errors(raw(spark, [d])), "column_name", "position", "value") == [("drug_characterization", 0, "main")]
    (tmp_path / "in").mkdir()
    put(tmp_path, "a.json", d)
    stream_ingest(spark, f"{tmp_path}/in", f"{tmp_path}/lax-stream", f"{tmp_path}/p1").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/lax-stream/report_drugs"), "drug_characterization") == [(None,)]
    with pytest.raises(Exception, match="does not fit"):
        stream_ingest(spark, f"{tmp_path}/in", f"{tmp_path}/strict-stream", f"{tmp_path}/p2", strict=True).awaitTermination()


def test_validation_and_outcomes(spark, folder):
    files = S.read_files(spark, f"{folder}/in")
    good, bad = S.split_valid(files)
    assert rows(good, "file_name") == [("many.json",), ("none.json",), ("one.json",)]
    assert rows(bad, "file_name") == [("a.txt",), ("cut.json",), ("empty.json",), ("twice.json",)]
    loaded = S.assign_file_id(S.load_rows(files), order_by=["file_name", "pos"])
    outcome = {r.file_name: (r.status, r.file_id) for r in S.ingest_report(loaded).collect()}
    assert {n: s for n, (s, _) in outcome.items()} == {
        "a.txt": "ERROR", "cut.json": "FAILED", "empty.json": "FAILED", "twice.json": "FAILED",
        "many.json": "SUCCESS", "none.json": "SUCCESS", "one.json": "SUCCESS"}
    assert outcome["none.json"][1] == 0 and outcome["cut.json"][1] is None
    assert outcome["many.json"][1] > 0


def test_files_of_zero_length_have_an_outcome(spark, folder):
    (folder / "in" / "sub").mkdir()
    (folder / "in" / "sub" / "b c+d.json").write_text("")
    files = S.read_files(spark, f"{folder}/in", empty=True)
    assert {r.file_name for r in files.collect()} - {r.file_name for r in S.read_files(spark, f"{folder}/in").collect()} == {"zero.json", "sub/b c+d.json"}
    report = {r.file_name: r.status for r in S.ingest_report(S.spaced_file_id(S.load_rows(files))).collect()}
    assert report["zero.json"] == report["sub/b c+d.json"] == report["empty.json"] == "FAILED"
    out = f"{folder}/out"
    stream_ingest(spark, f"{folder}/in", out, f"{folder}/p", ("load",)).awaitTermination()
    for _ in range(2):      # the second finds nothing new
        note_empty_files(spark, f"{folder}/in", out)
    assert {r.file_name: r.status for r in B.outcomes_of(B.read_closed(spark, out, "loads")).collect()} == report
    assert B.closed_ids(spark, out).count() == 2


def test_a_stream_looks_up_many_files_in_few_tasks(spark, tmp_path):
    """By default it takes a task a file."""
    (tmp_path / "in").mkdir()
    for i in range(120):
        put(tmp_path, f"{i}.json", doc(str(i)))
    before = spark.conf.get(S._LOOKUPS)
    query = stream_ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/p", ("load",))
    query.awaitTermination()
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for job in tracker.getJobIdsForGroup(str(query.runId)) for s in tracker.getJobInfo(job).stageIds]
    assert 1 < max(s.numTasks for s in stages if s) <= S.LOOKUPS_PER_CORE * spark.sparkContext.defaultParallelism < 120
    assert B.read_closed(spark, f"{tmp_path}/out", "loads").where("outcome = 'SUCCESS'").count() == 120
    assert spark.conf.get(S._LOOKUPS) == before


def test_texts_as_single_files_are_those_of_the_text_writer(spark, tmp_path):
    docs = spark.createDataFrame([("a",), ("a",), ("é\nb",), ("",), (None,)], "value string").repartition(3)
    write_single(docs, f"{tmp_path}/mine")
    docs.write.option("maxRecordsPerFile", 1).text(f"{tmp_path}/spark")
    read = lambda name: sorted(r.content for r in S.read_files(spark, f"{tmp_path}/{name}").collect())
    assert read("mine") == read("spark") == ["\n", "\n", "a\n", "a\n", "é\nb\n"]
    assert not [f for f in (tmp_path / "mine").iterdir() if f.name.startswith(".")]


def test_names_below_a_resolved_folder(spark, tmp_path):
    """The folder's name also ends the name of a folder above it."""
    (tmp_path / "main" / "in" / "sub").mkdir(parents=True)
    (tmp_path / "main" / "in" / "sub" / "q.json").write_text("{}")
    for path in (f"{tmp_path}/main/in", f"file:{tmp_path}/main/in/", f"file://{tmp_path}/main/in"):
        assert rows(S.read_files(spark, path), "file_name") == [("sub/q.json",)]
    assert rows(S.read_files(spark, f"{tmp_path}/main/*/sub"), "file_name") == [("q.json",)]


def test_file_ids_are_dense_over_skewed_partitions(spark):
    docs = spark.range(0, 1000, 1, 5).filter("id < 20 OR id > 500").selectExpr("id AS pos", "'f' AS file_name")
    for order in (None, ["pos"]):
        ids = S.assign_file_id(docs.repartition(6), start=100, order_by=order)
        got = ids.orderBy("pos").select("file_id").collect()
        assert sorted(r[0] for r in got) == list(range(101, 101 + len(got)))
        if order:
            assert [r[0] for r in got] == list(range(101, 101 + len(got)))


def test_append_latest_and_purge(spark, tmp_path):
    texts = [("mock_a.json", '{"id":"1"}'), ("mockXb.json", '{"id":"2"}'), ("real.json", '{"id":"3"}')]
    frame = spark.createDataFrame(texts, "file_name string, report_json string")
    S.append_documents(frame, f"{tmp_path}/raw", "2024-02-01")
    highest = spark.read.parquet(f"{tmp_path}/raw").agg(F.max("file_id")).first()[0]
    S.append_documents(frame.filter("file_name = 'real.json'"), f"{tmp_path}/raw", "2024-02-02", start=highest)
    with pytest.raises(Exception, match="MALFORMED"):
        S.append_documents(frame.withColumn("report_json", F.lit('{"id"')), f"{tmp_path}/raw")
    table = spark.read.parquet(f"{tmp_path}/raw")
    assert table.count() == 4
    assert S.latest_file_id(table, "real.json").first()[0] > highest
    assert S.latest_file_id(table, "absent.json").first()[0] == 0
    assert rows(S.purge_like(table, "mock_%"), "file_name") == [("real.json",), ("real.json",)]
    assert rows(table.select(path("raw_json", "$.safetyreport[0].id"))) == [("1",), ("2",), ("3",), ("3",)]


def test_upsert_and_high_water_mark(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    assert rows(T.upsert(old, new, "k")) == [(1, "a"), (2, "B"), (3, "C")]
    loads = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")],
                                  "k long, t string").withColumn("src_ld_ts", F.col("t").cast("timestamp"))
    assert rows(T.newer_than_target(loads, loads.filter("k <= 2")), "k") == [(3,)]
    assert T.newer_than_target(loads, loads.filter("k < 0")).count() == 3


def test_stream_picks_up_new_files_once(spark, folder):
    out, progress = f"{folder}/out", f"{folder}/progress"

    def run(day):
        stream_ingest(spark, f"{folder}/in", out, progress, max_files=2, as_of=day).awaitTermination()

    run("2024-02-01")
    loads = B.read_table(spark, out, "loads")
    assert B.raw_of(loads).count() == 3 and loads.select("file_id").distinct().count() == loads.count()
    assert rows(B.outcomes_of(loads).groupBy("status").count()) == [("ERROR", 1), ("FAILED", 3), ("SUCCESS", 3)]
    before = B.next_batch_id(spark, out, "loads")
    run("2024-02-02")
    assert B.next_batch_id(spark, out, "loads") == before
    put(folder, "late.json", doc("a", ["new"], ["r"]))
    run("2024-02-03")
    staged = B.read_table(spark, out, "staged")
    assert rows(B.current_reports(staged), "report_id") == [("a",), ("b",), ("c",)]
    drugs = B.read_table(spark, out, "report_drugs")
    assert rows(B.current_children(drugs, staged), "report_id", "drug_name") == [("a", "new")]
    loads = B.read_table(spark, out, "loads")
    assert loads.select("file_id").distinct().count() == loads.count()


def test_a_batch_of_bad_files_and_an_empty_increment(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "cut.json").write_text("{")
    out = f"{tmp_path}/out"
    stream_ingest(spark, f"{tmp_path}/in", out, f"{tmp_path}/p").awaitTermination()
    assert B.raw_of(B.read_table(spark, out, "loads")).count() == 0
    assert B.current_reports(B.read_table(spark, out, "staged")).count() == 0
    table = raw(spark, [doc("a", ["x"], ["r"])])
    for _ in range(2):
        build_tables(spark, table, f"{tmp_path}/tables", "incremental", min_reports=1)
    assert read_mart(spark, f"{tmp_path}/tables", "risk_signals").count() == 1


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    out = str(tmp_path)
    table = raw(spark, [doc("a", ["x"], ["r"]), doc("b", ["y"], ["r"])])
    for _ in range(2):
        B.stage_batch(table, 0, out)
        B.children_batch(B.read_table(spark, out, "staged"), 0, out)
    assert B.read_table(spark, out, "drug_reaction_pairs").count() == 2


def versions():
    """Reports in up to three versions with changing children, by load day."""
    pick = random.Random(3)
    days = {d: [] for d in range(1, 6)}
    for i in range(60):
        for day in sorted(pick.sample(list(days), pick.randint(1, 3))):
            drugs = [f"d{pick.randint(0, 4)}" for _ in range(pick.randint(0, 3))]
            days[day].append((doc(f"R{i}", drugs, [f"r{pick.randint(0, 3)}"]), f"2024-02-0{day}"))
    return [x for d in days.values() for x in d]


MARTS = ("pair_report_counts", "drug_summary", "risk_signals")


@pytest.mark.parametrize("cuts", [[2], [1, 3, 4]])
def test_incremental_equals_full(spark, tmp_path, cuts):
    table = raw(spark, versions()).cache()
    build_tables(spark, table, f"{tmp_path}/full", min_reports=5, as_of="2024-03-01")
    for cut in cuts + [9]:
        part = table.filter(F.col("ingestion_timestamp") < F.lit(f"2024-02-0{cut}").cast("timestamp"))
        build_tables(spark, part, f"{tmp_path}/inc", "incremental", min_reports=5, as_of="2024-03-01")
    B.compact(spark, f"{tmp_path}/inc", f"{tmp_path}/compact")
    full, inc, compact = (f"{tmp_path}/{x}" for x in ("full", "inc", "compact"))
    for name in MARTS:
        assert rows(read_mart(spark, full, name)) == rows(read_mart(spark, inc, name))
    staged = {o: B.read_table(spark, o, "staged") for o in (full, inc, compact)}
    for name in B.CHILDREN:
        want = rows(B.read_table(spark, full, name).drop("batch_id"))
        for o in (inc, compact):
            assert rows(B.current_children(B.read_table(spark, o, name), staged[o])) == want
    assert read_mart(spark, full, "risk_signals").count() > 0


def test_full_refresh_needs_a_new_folder(spark, tmp_path):
    table = raw(spark, seeded_docs()[:5])
    build_tables(spark, table, f"{tmp_path}/o")
    with pytest.raises(ValueError):
        build_tables(spark, table, f"{tmp_path}/o")


@pytest.mark.parametrize("l, r", [(100, 1), (1, 100), (40, 60), (3, 3)])
def test_grid_join_meets_every_pair_once(spark, l, r):
    left = spark.range(l).selectExpr("1 AS k", "id AS a").unionAll(spark.sql("SELECT 2, 0L"))
    right = spark.range(r).selectExpr("1 AS k", "id AS b").unionAll(spark.sql("SELECT 2, 0L"))
    large = large_keys(left, right, "k", block=10)
    assert (large is None) == (max(l, r) <= 10)
    if large is not None:
        got = rows(grid_join(left, right, "k", large).select("k", "a", "b"))
        assert len(got) == len(set(got)) == l * r
    got = rows(join_within(left, right, "k", block=10).select("k", "a", "b"))
    assert len(got) == len(set(got)) == l * r + 1
