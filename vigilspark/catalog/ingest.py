"""Queries over files: reading, validation, load metadata and ids.

The file frame holds one file per document version, with every kind of trouble:
wrong names, cut content, repeated keys, text after the document, outer arrays
with elements that are no documents, and empty arrays.
"""

from __future__ import annotations

import os

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.semistructured import elements, path
from ..plans.reports import report_id
from ..schemas import RECEIVED_DATE_PATH
from ..session import scratch_path
from ..sources import raw as S
from . import query
from .bindings import DOCS_SQL, documents, raw, table

DOCS_PER_FILE = 2000
LOADED_AT = "2024-02-01 00:00:00"


def write_files(docs: DataFrame, folder: str) -> None:
    """Documents as files that each hold one outer array of at most DOCS_PER_FILE documents.

    Texts repeat themselves, so the files are compressed.
    """
    file_bodies(docs).write.mode("append").option("maxRecordsPerFile", 1).option("compression", "snappy").text(folder)


def write_single(docs: DataFrame, folder: str) -> None:
    """Texts (one column) as a file each, as Spark's text writer makes them.

    On a local file system without Hadoop's native library that writer starts two processes a file to set its mode, so
    tasks make the files themselves there.  A task that is run again replaces its files, each of them at once.
    """
    at = S.qualified(docs.sparkSession, folder)
    if not at.startswith("file:/"):
        # a task moves its own files when it is done; by default the driver moves all of them one by one
        docs.write.option("maxRecordsPerFile", 1).option("mapreduce.fileoutputcommitter.algorithm.version", 2).text(folder)
        return
    at = at.removeprefix("file:")

    def write(batches):
        task = TaskContext.get()
        os.makedirs(at, exist_ok=True)
        n = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                name = f"part-{task.partitionId():05d}-{n:09d}.txt"
                made = f"{at}/.{task.taskAttemptId()}-{name}"
                with open(made, "wb") as file:
                    file.write((text or "").encode() + b"\n")
                os.replace(made, f"{at}/{name}")
                n += 1
        return iter(())

    docs.mapInArrow(write, "n long").write.format("noop").mode("overwrite").save()


def file_bodies(docs: DataFrame) -> DataFrame:
    """``value``: the arrays, one a file.

    A file is a run of consecutive rows of one input partition, so its size is
    bounded whatever the data looks like.  Documents with a ``slot`` lie by it
    already and are put together where they are.
    """
    by = [c for c in ("slot",) if c in docs.columns]
    chunk = F.expr(f"monotonically_increasing_id() div {DOCS_PER_FILE}")
    body = F.concat(F.lit("["), F.array_join(F.collect_list("content"), ","), F.lit("]"))
    return docs.select("content", *by, chunk.alias("chunk")).groupBy(*by, "chunk").agg(body.alias("value")).select("value")


@query("raw_scan", f"""WITH {DOCS_SQL} SELECT report_id, date_text,
  CASE WHEN has_patient THEN n_drugs END AS n_drugs FROM docs""")
def raw_scan(spark, sf_dir):
    """Documents written as JSON files and read back, outer arrays stripped."""
    folder = scratch_path(spark, "raw-scan")
    write_files(documents(spark, sf_dir), folder)
    docs = S.documents(S.read_files(spark, folder))
    return docs.select(
        report_id("raw_json").alias("report_id"),
        path("raw_json", RECEIVED_DATE_PATH).alias("date_text"),
        F.size(elements("raw_json", "$.safetyreport[0].patient[0].drug")).alias("n_drugs"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).selectExpr(
        "doc_key",
        "concat('doc-', doc_key, CASE WHEN doc_key % 10 = 3 THEN '.txt' ELSE '.json' END) AS file_name",
        """CASE WHEN doc_key % 14 = 5 THEN substr(content, 1, 30)
                WHEN doc_key % 22 = 7 THEN '{"safetyreport":[],"safetyreport":[]}'
                WHEN doc_key % 34 = 11 THEN concat(content, '\\n', content)
                WHEN doc_key % 38 = 15 THEN concat(content, ' }rest')
                WHEN doc_key % 46 = 21 THEN concat('[', content, ',"plain text"]')
                WHEN doc_key % 26 = 9 THEN '[]'
                WHEN doc_key % 6 = 1 THEN concat('[', content, ',{"safetyreport":[{"id":"extra"}]}]')
                ELSE content END AS content""")


FILES_SQL = f"""{DOCS_SQL},
files AS (
  SELECT doc_key, report_id, doc_key % 10 <> 3 AS named,
    NOT (doc_key % 14 = 5 OR doc_key % 22 = 7 OR doc_key % 34 = 11 OR doc_key % 38 = 15) AS parses,
    'doc-' || doc_key || CASE WHEN doc_key % 10 = 3 THEN '.txt' ELSE '.json' END AS file_name,
    CASE WHEN doc_key % 14 = 5 OR doc_key % 22 = 7 OR doc_key % 34 = 11 OR doc_key % 38 = 15 THEN 0
         WHEN doc_key % 46 = 21 THEN 2 WHEN doc_key % 26 = 9 THEN 0
         WHEN doc_key % 6 = 1 THEN 2 ELSE 1 END AS n_docs
  FROM docs),
elems AS (SELECT *, pos FROM files JOIN (VALUES (0), (1)) v(pos) ON pos < n_docs)"""


@query("ingest_validate", f"WITH {FILES_SQL} SELECT file_name, named AND parses AS accepted FROM files")
def ingest_validate(spark, sf_dir):
    good, bad = S.split_valid(files(spark, sf_dir))
    return good.select("file_name", F.lit(True).alias("accepted")).unionAll(
        bad.select("file_name", F.lit(False).alias("accepted")))


@query("skip_bad_file", f"""WITH {FILES_SQL} SELECT file_name, pos,
  CASE WHEN pos = 0 THEN report_id WHEN doc_key % 46 <> 21 THEN 'extra' END AS report_id FROM elems""")
def skip_bad_file(spark, sf_dir):
    return S.documents(files(spark, sf_dir)).select(
        "file_name", "pos", report_id("raw_json").alias("report_id"))


@query("ingest_report", f"""WITH {FILES_SQL},
rows AS (SELECT file_name, named, parses, n_docs, pos, row_number() OVER (ORDER BY file_name, pos) AS id
         FROM (SELECT file_name, named, parses, n_docs, 0 AS pos FROM files
               UNION ALL SELECT file_name, named, parses, n_docs, 1 FROM files
               WHERE n_docs = 2 AND named) f),
newest AS (SELECT file_name, max(CASE WHEN n_docs > 0 THEN id END) AS id FROM rows GROUP BY file_name)
SELECT f.file_name,
  CASE WHEN NOT named THEN 'ERROR' WHEN NOT parses THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  CASE WHEN named AND parses THEN coalesce(id, 0) END AS file_id,
  CASE WHEN NOT named THEN 'not named as a JSON file'
       WHEN NOT parses THEN 'not one JSON document or array'
       ELSE 'newest document: ' || coalesce(id, 0) END AS message
FROM files f JOIN newest n ON f.file_name = n.file_name""")
def ingest_report(spark, sf_dir):
    rows = S.load_rows(files(spark, sf_dir))
    return S.ingest_report(S.assign_file_id(rows, order_by=["file_name", "pos"]))


@query("raw_load_columns", f"""WITH {FILES_SQL} SELECT file_name, pos, '{LOADED_AT}' AS loaded_at,
  'PROCESSED' AS file_status, 'PENDING' AS default_status FROM elems""")
def raw_load_columns(spark, sf_dir):
    docs = S.documents(files(spark, sf_dir)).select("file_name", "pos")
    pending = S.with_load_metadata(docs, as_of=LOADED_AT).withColumnRenamed(
        "file_status", "default_status").drop("ingestion_timestamp")
    return S.with_load_metadata(pending, "PROCESSED", LOADED_AT).select(
        "file_name", "pos",
        F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("loaded_at"),
        "file_status", "default_status")


@query("raw_file_id", f"""WITH {FILES_SQL}
  SELECT row_number() OVER (ORDER BY file_name, pos) AS file_id, file_name FROM elems WHERE named""")
def raw_file_id(spark, sf_dir):
    return S.raw_table(files(spark, sf_dir), LOADED_AT, order_by=["file_name", "pos"]).select(
        "file_id", "file_name")


@query("raw_file_id_any_order", f"""WITH {FILES_SQL} SELECT count(*) AS n, min(id) AS lowest, max(id) AS highest,
  count(DISTINCT id) AS ids FROM (SELECT 1000 + row_number() OVER () AS id FROM elems WHERE named)""")
def raw_file_id_any_order(spark, sf_dir):
    """Ids in whatever order the rows lie, without a shuffle: dense and unique from a start."""
    ids = S.raw_table(files(spark, sf_dir), LOADED_AT, start=1000, dense=True)
    return ids.agg(F.count("*").alias("n"), F.min("file_id").alias("lowest"),
                   F.max("file_id").alias("highest"), F.countDistinct("file_id").alias("ids"))


@query("latest_file_id", f"""WITH {DOCS_SQL}
  SELECT file_name, max(doc_key) AS file_id FROM docs GROUP BY file_name
  UNION ALL SELECT 'never-loaded.json', 0""")
def latest_file_id(spark, sf_dir):
    loaded = raw(spark, sf_dir)
    absent = S.latest_file_id(loaded, "never-loaded.json").select(
        F.lit("never-loaded.json").alias("file_name"), "file_id")
    return S.latest_file_id(loaded).unionByName(absent)


@query("raw_insert_document", """SELECT 'mock_' || event_id || '.json' AS file_name,
  cast(user_id AS VARCHAR) AS report_id, ts::DATE::VARCHAR AS received_date, 'PROCESSED' AS file_status
  FROM events""")
def raw_insert_document(spark, sf_dir):
    """Report texts wrapped, parsed and appended to a raw table in two steps."""
    reports = table(spark, sf_dir, "events").selectExpr(
        "event_id", "concat('mock_', event_id, '.json') AS file_name",
        "to_json(named_struct('id', cast(user_id AS string), 'receivedate', date_format(ts, 'yyyyMMdd')))"
        " AS report_json")
    folder = scratch_path(spark, "raw-insert")
    for odd in (0, 1):
        part = reports.filter(F.col("event_id") % 2 == odd).drop("event_id")
        S.append_documents(part, folder, LOADED_AT)
    return spark.read.parquet(folder).select(
        "file_name", report_id("raw_json").alias("report_id"),
        F.try_to_date(path("raw_json", RECEIVED_DATE_PATH), "yyyyMMdd").alias("received_date"),
        "file_status")


@query("purge_by_name_pattern", f"""WITH {DOCS_SQL} SELECT doc_key AS file_id, file_name FROM docs
  WHERE NOT (file_name LIKE 'load_1996%' OR file_name LIKE 'load_1997%')""")
def purge_by_name_pattern(spark, sf_dir):
    kept = S.purge_like(S.purge_like(raw(spark, sf_dir), "load_1996%"), "load_1997%")
    return kept.select("file_id", "file_name")
