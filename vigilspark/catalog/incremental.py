"""Queries over loads that arrive in parts: upsert, high-water mark and file streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import dedupe_latest
from ..plans.refresh import build_marts, build_tables, read_mart
from ..plans.reports import report_id
from ..session import pin, scratch_path
from ..sources import bucketed as L
from ..sources import keyed as K
from ..sources import raw as S
from ..sources import tables as T
from ..streaming import batches as B
from ..streaming.ingest import STEPS, note_empty_files, stream_ingest
from . import query
from .bindings import (
    DOC_CHILDREN_SQL, DOCS_SQL, MARTS_SQL, SUMMARY_SQL, dealt_documents, documents, raw, table,
)
from .documents import DRUG_SQL, REPORT_SQL, plain
from .ingest import write_files, write_single

CUT = "2024-01-15 00:00:00"


@query("merge_upsert", """SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1""")
def merge_upsert(spark, sf_dir):
    """Newest event per user: the state before a cut, updated with what came after."""
    events = table(spark, sf_dir, "events")
    cut = F.lit(CUT).cast("timestamp_ntz")
    target = dedupe_latest(events.filter(F.col("ts") < cut), "user_id", ("ts", "event_id"))
    updates = dedupe_latest(events.filter(F.col("ts") >= cut), "user_id", ("ts", "event_id"))
    return T.upsert(target, updates, "user_id").select("user_id", "event_id", "event_type")


@query("incremental_read", f"""SELECT event_id, ts FROM events
  WHERE ts > coalesce((SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{CUT}'), TIMESTAMP '1900-01-01')""")
def incremental_read(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    loaded = events.filter(F.col("ts") < F.lit(CUT).cast("timestamp_ntz"))
    return T.newer_than_target(events, loaded, "ts")


@query("incremental_read_first", "SELECT event_id, ts FROM events")
def incremental_read_first(spark, sf_dir):
    """An empty target lets everything through."""
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return T.newer_than_target(events, events.filter("event_id < 0"), "ts")


@query("max_load_ts", """SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') AS mark,
  TIMESTAMP '1900-01-01' AS mark_when_empty FROM events""")
def max_load_ts(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    return spark.range(1).select(
        T.high_water_mark(events, "ts").alias("mark"),
        T.high_water_mark(events.filter("event_id < 0"), "ts").alias("mark_when_empty"))


@query("table_sink", "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders")
def table_sink(spark, sf_dir):
    """Full refresh, run twice: the second replaces the first."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    folder = scratch_path(spark, "sink")
    T.write_table(rows, folder)
    T.write_table(rows, folder)
    return spark.read.parquet(folder)


@query("clustered_layout", """SELECT o_orderkey, o_orderdate FROM orders
  WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-02-01'""")
def clustered_layout(spark, sf_dir):
    """Orders stored by date (and key, to split a frequent date), then read for one month."""
    folder = scratch_path(spark, "clustered")
    T.write_clustered(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), folder,
                      "o_orderdate", "o_orderkey")
    date = F.col("o_orderdate")
    return spark.read.parquet(folder).filter(
        (date >= F.lit("1997-01-01").cast("timestamp_ntz"))
        & (date < F.lit("1997-02-01").cast("timestamp_ntz")))


# --- refresh of all tables ------------------------------------------------------


SIGNALS_SQL = f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}, {MARTS_SQL}
  SELECT drug_name, reaction_term, report_count, b_count, c_count, d_count, ror, prr, ror_simple,
    signal_strength, is_significant_signal FROM sig"""


@query("refresh_full", SIGNALS_SQL)
def refresh_full(spark, sf_dir):
    """All tables from the raw documents; the signal table of the run."""
    out = scratch_path(spark, "refresh")
    build_tables(spark, pin(raw(spark, sf_dir)), out)
    return read_mart(spark, out, "risk_signals").drop("signal_generated_at")


@query("refresh_after_failure", SIGNALS_SQL)
def refresh_after_failure(spark, sf_dir):
    """An increment breaks off after staging and is run again; the signals of the run."""
    return read_mart(spark, broken_and_repeated(spark, sf_dir), "risk_signals").drop("signal_generated_at")


@query("refresh_after_failure_drugs", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT report_id || '-' || drug_sequence AS report_drug_id, report_id, drug_name FROM drg""")
def refresh_after_failure_drugs(spark, sf_dir):
    """The drug rows of the same run."""
    out = broken_and_repeated(spark, sf_dir)
    return B.read_current(spark, out, "report_drugs").select("report_drug_id", "report_id", "drug_name")


def broken_and_repeated(spark: SparkSession, sf_dir: str) -> str:
    """A first increment, a second one that stops after staging, and the second one again."""
    out = scratch_path(spark, "refresh")
    documents = pin(raw(spark, sf_dir))
    before = documents.filter(F.col("ingestion_timestamp") < F.lit("1998-06-01").cast("timestamp_ntz"))
    build_tables(spark, before, out, "incremental")
    B.stage_batch(B.after_done(documents, out), B.open_batch(spark, out), out)
    build_tables(spark, documents, out, "incremental")
    return out


@query("refresh_incremental", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}, {SUMMARY_SQL}
  SELECT drug_name, total_reports, avg_age, risk_level FROM summary""")
def refresh_incremental(spark, sf_dir):
    """Documents loaded before a date, then the rest as an increment; the drug mart of the run."""
    out = scratch_path(spark, "refresh")
    documents = pin(raw(spark, sf_dir))
    before = F.col("ingestion_timestamp") < F.lit("1998-06-01").cast("timestamp_ntz")
    for loaded in (documents.filter(before), documents):
        build_tables(spark, loaded, out, "incremental", children=())
    return read_mart(spark, out, "drug_summary")


# --- file streams -------------------------------------------------------------


def streamed(spark: SparkSession, sf_dir: str, steps: tuple[str, ...] = STEPS, after: Callable[[str], None] = lambda out: None) -> str:
    """First versions arrive and are streamed, then second versions; the folder with the tables."""
    root = scratch_path(spark, "stream")
    docs = dealt_documents(spark, sf_dir)
    for version, day in ((1, "2024-02-01"), (2, "2024-02-02")):
        write_files(docs.filter(F.col("doc_key") % 2 == version % 2), f"{root}/in")
        stream_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/progress", steps, as_of=day,
                      check_names=False).awaitTermination()
        after(f"{root}/out")
    return f"{root}/out"


def _table(spark: SparkSession, out: str, name: str) -> DataFrame:
    return B.read_closed(spark, out, name)


@query("stream_ingest", f"""WITH {DOCS_SQL}
  SELECT report_id, count(*) AS n, count(*) AS file_ids FROM docs GROUP BY report_id""")
def stream_ingest_documents(spark, sf_dir):
    loaded = B.raw_of(_table(spark, streamed(spark, sf_dir, ("load",)), "loads"))
    return loaded.groupBy(report_id("raw_json").alias("report_id")).agg(
        F.count("*").alias("n"), F.countDistinct("file_id").alias("file_ids"))


@query("stream_stage_upsert", f"""WITH {DOCS_SQL} SELECT * EXCLUDE (src_ld_ts, src_ld_date, source_file)
  FROM (SELECT {REPORT_SQL} FROM stg)""")
def stream_stage_upsert(spark, sf_dir):
    staged = B.read_current(spark, streamed(spark, sf_dir, ("load", "stage")))
    return plain(staged.drop(
        "src_ld_ts", "src_ld_date", "source_file", "file_id", "batch_id", "drugs", "reactions",
        "drug_names", "reaction_terms", "pair_volume"))


@query("stream_children", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT report_id || '-' || drug_sequence AS report_drug_id, report_id, received_date::VARCHAR AS received_date, patient_sex,
    patient_age, {DRUG_SQL} FROM drg""")
def stream_children(spark, sf_dir):
    return plain(B.read_current(spark, streamed(spark, sf_dir), "report_drugs").drop("src_ld_ts", "src_ld_date"))


@query("stream_pairs", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT report_id || '-' || report_drug_id || '-' || report_reaction_id AS drug_reaction_pair_id,
    * EXCLUDE (src_ld_ts) FROM allpairs""")
def stream_pairs(spark, sf_dir):
    return B.read_current(spark, streamed(spark, sf_dir), "drug_reaction_pairs").drop("src_ld_ts")


@query("stream_signals", SIGNALS_SQL)
def stream_signals(spark, sf_dir):
    """Two streamed loads, the marts built after each: the second from the reports that changed."""
    out = streamed(spark, sf_dir, after=lambda at: build_marts(spark, at))
    return read_mart(spark, out, "risk_signals").drop("signal_generated_at")


def streamed_after_compaction(spark: SparkSession, sf_dir: str) -> str:
    """First versions are streamed and compacted; second versions come into the new folder by a stream of its own."""
    root = scratch_path(spark, "stream")
    docs = dealt_documents(spark, sf_dir)
    for version, out in ((1, "first"), (2, "compact")):
        write_files(docs.filter(F.col("doc_key") % 2 == version % 2), f"{root}/in-{version}")
        stream_ingest(spark, f"{root}/in-{version}", f"{root}/{out}", f"{root}/progress-{version}", as_of=f"2024-02-0{version}",
                      check_names=False).awaitTermination()
        if version == 1:
            B.compact(spark, f"{root}/first", f"{root}/compact")
    return f"{root}/compact"


@query("stream_after_compact", SIGNALS_SQL)
def stream_after_compact(spark, sf_dir):
    """The signals of a compacted folder that another stream went on with."""
    out = streamed_after_compaction(spark, sf_dir)
    build_marts(spark, out)
    return read_mart(spark, out, "risk_signals").drop("signal_generated_at")


@query("stream_after_compact_ids", f"""WITH {DOCS_SQL} SELECT count(*) AS documents, count(*) AS ids, true AS ascending FROM docs""")
def stream_after_compact_ids(spark, sf_dir):
    """The loads of both streams: documents, distinct ids, and whether all ids of the second are above those of the first."""
    loads = B.raw_of(B.read_closed(spark, streamed_after_compaction(spark, sf_dir), "loads"))
    first = F.to_date("ingestion_timestamp") == F.lit("2024-02-01").cast("date")
    return loads.agg(F.count("*").alias("documents"), F.countDistinct("file_id").alias("ids"),
                     (F.max(F.when(first, F.col("file_id"))) < F.min(F.when(~first, F.col("file_id")))).alias("ascending"))


# --- marts by changes, stored upserts and purges ----------------------------------


@query("marts_by_changes", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}, {MARTS_SQL} SELECT drug_name, reaction_term, report_count FROM pc""")
def marts_by_changes(spark, sf_dir):
    """Three increments; later versions of a report have a drug less, so pairs are taken off again."""
    out = scratch_path(spark, "changes")
    documents = pin(raw(spark, sf_dir))
    for until in ("1995-01-01", "1998-06-01", "2100-01-01"):
        build_tables(spark, documents.filter(F.col("ingestion_timestamp") < F.lit(until).cast("timestamp_ntz")), out, "incremental", children=())
    return read_mart(spark, out, "pair_report_counts")


def bucketed(spark: SparkSession, sf_dir: str) -> str:
    """Two increments, copied into bucketed tables one after the other; the tables' prefix."""
    out = scratch_path(spark, "history")
    prefix = "reports_" + out.rsplit("-", 1)[-1]
    documents = pin(raw(spark, sf_dir))
    for until in ("1997-02-01", "2100-01-01"):
        build_tables(spark, documents.filter(F.col("ingestion_timestamp") < F.lit(until).cast("timestamp_ntz")), out, "incremental")
        L.sync(spark, out, prefix, buckets=8)
    return prefix


@query("bucketed_reports", f"""WITH {DOCS_SQL} SELECT * EXCLUDE (src_ld_ts, src_ld_date, source_file)
  FROM (SELECT {REPORT_SQL} FROM stg)""")
def bucketed_reports(spark, sf_dir):
    """Newest versions over two batches of a bucketed table, ranked without a shuffle."""
    return plain(L.bucketed_reports(spark, bucketed(spark, sf_dir)).drop(
        "src_ld_ts", "src_ld_date", "source_file", "file_id", "batch_id", "drugs", "reactions", "drug_names", "reaction_terms", "pair_volume"))


@query("bucketed_drugs", f"""WITH {DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT report_id || '-' || drug_sequence AS report_drug_id, report_id, drug_name FROM drg""")
def bucketed_drugs(spark, sf_dir):
    """Their drug rows, joined without a shuffle."""
    return L.bucketed_children(spark, bucketed(spark, sf_dir), "report_drugs").select("report_drug_id", "report_id", "drug_name")


@query("merge_upsert_stored", """SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1""")
def merge_upsert_stored(spark, sf_dir):
    """The same upsert into a stored table: only the partitions of the updated users are written again."""
    events = table(spark, sf_dir, "events")
    cut, newest = F.lit(CUT).cast("timestamp_ntz"), ("ts", "event_id")
    columns = ["user_id", "event_id", "event_type"]
    path = scratch_path(spark, "keyed")
    K.write_keyed(dedupe_latest(events.filter(F.col("ts") < cut), "user_id", newest).select(*columns), path, "user_id", buckets=16)
    K.upsert_keyed(spark, path, dedupe_latest(events.filter(F.col("ts") >= cut), "user_id", newest).select(*columns))
    return K.read_keyed(spark, path)


PURGED = ("load-1996%", "reload-1997%")
PURGED_DOCS_SQL = DOCS_SQL.replace(
    "  FROM docs),", "  FROM docs WHERE NOT (" + " OR ".join(f"file_name LIKE '{p}'" for p in PURGED) + ")),")


def purged(spark: SparkSession, sf_dir: str) -> str:
    """Two increments with their marts, then two purges by file name and the marts again."""
    out = scratch_path(spark, "purge")
    documents = pin(raw(spark, sf_dir))
    before = documents.filter(F.col("ingestion_timestamp") < F.lit("1997-02-01").cast("timestamp_ntz"))
    for loaded in (before, documents):
        build_tables(spark, loaded, out, "incremental")
    for pattern in PURGED:
        B.purge(spark, out, pattern, documents)
    build_marts(spark, out)
    return out


@query("purge_stored", SIGNALS_SQL.replace(DOCS_SQL, PURGED_DOCS_SQL))
def purge_stored(spark, sf_dir):
    """The signals without what the purged files brought; reports fall back to the versions of other files."""
    return read_mart(spark, purged(spark, sf_dir), "risk_signals").drop("signal_generated_at")


PURGED_DRUGS_SQL = f"""WITH {PURGED_DOCS_SQL}, {DOC_CHILDREN_SQL}
  SELECT report_id || '-' || drug_sequence AS report_drug_id, report_id, drug_name FROM drg"""


@query("purge_stored_drugs", PURGED_DRUGS_SQL)
def purge_stored_drugs(spark, sf_dir):
    return B.read_current(spark, purged(spark, sf_dir), "report_drugs").select("report_drug_id", "report_id", "drug_name")


@query("purge_then_compact", PURGED_DRUGS_SQL)
def purge_then_compact(spark, sf_dir):
    """The same rows from the compacted folder, where the purged ones are no longer stored."""
    out = purged(spark, sf_dir)
    B.compact(spark, out, f"{out}-compact")
    return spark.read.parquet(B.batch_path(f"{out}-compact", "report_drugs", 0)).select("report_drug_id", "report_id", "drug_name")


@query("stream_outcomes", f"""WITH {DOCS_SQL} SELECT 'part=' || (doc_key % 3) AS folder, 'SUCCESS' AS status, count(*) AS n
  FROM docs GROUP BY 1""")
def stream_outcomes(spark, sf_dir):
    """Documents in compressed files of several subfolders: documents per folder, as the stream and
    the batch reader both load them."""
    root = scratch_path(spark, "outcomes")
    docs = documents(spark, sf_dir).select((F.col("doc_key") % 3).alias("part"), F.col("content").alias("value"))
    many = docs.groupBy("part", F.expr("monotonically_increasing_id() div 2000").alias("chunk")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]")).alias("value"))
    many.select("part", "value").write.partitionBy("part").option("maxRecordsPerFile", 1).option("compression", "gzip").text(f"{root}/in")
    stream_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/progress", ("load",), check_names=False).awaitTermination()
    streamed = _table(spark, f"{root}/out", "loads").select("file_name", "outcome", "pos")
    batch = S.load_rows(S.read_files(spark, f"{root}/in"), check_names=False).select("file_name", "outcome", "pos")
    both = streamed.join(batch, ["file_name", "outcome", "pos"])
    return both.groupBy(F.substring_index("file_name", "/", 1).alias("folder"), F.col("outcome").alias("status")).agg(
        F.count("*").alias("n"))


@query("outcomes_of_all_files", f"""WITH {DOCS_SQL}, files AS (
  SELECT CASE WHEN doc_key % 3 = 0 THEN 'good' ELSE 'cut' END AS folder, CASE WHEN doc_key % 3 = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status
  FROM docs WHERE doc_key % 50 < 2 UNION ALL SELECT 'zero', 'FAILED')
  SELECT reader, folder, status, count(*) AS n FROM files CROSS JOIN (VALUES ('batch'), ('stream')) v(reader) GROUP BY ALL""")
def outcomes_of_all_files(spark, sf_dir):
    """A file a document, cut ones among them, and one of zero length: outcomes per folder by the batch reader and by a stream."""
    root = scratch_path(spark, "all-files")
    docs = documents(spark, sf_dir).where("doc_key % 50 < 2").select((F.col("doc_key") % 3 == 0).alias("good"), "content")
    for name, rows in (("good", docs.where("good").select("content")), ("cut", docs.where("NOT good").select(F.substr("content", F.lit(1), F.lit(30))))):
        write_single(rows.toDF("value"), f"{root}/in/{name}")
    spark.range(0).selectExpr("'' AS value").write.text(f"{root}/in/zero")      # Spark writes one file without a byte
    stream_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/progress", ("load",), check_names=False).awaitTermination()
    note_empty_files(spark, f"{root}/in", f"{root}/out", check_names=False)
    streamed = B.outcomes_of(_table(spark, f"{root}/out", "loads"))
    batch = S.ingest_report(S.spaced_file_id(S.load_rows(S.read_files(spark, f"{root}/in", empty=True), check_names=False)))
    both = streamed.withColumn("reader", F.lit("stream")).unionByName(batch.withColumn("reader", F.lit("batch")))
    return both.groupBy("reader", F.substring_index("file_name", "/", 1).alias("folder"), "status").agg(F.count("*").alias("n"))
