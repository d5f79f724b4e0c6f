"""Raw documents: JSON files in, one semi-structured row per document out.

The unit of reading is a *file frame* ``(file_name, content)`` with one row per
file.  A file holds one JSON document or an array of documents; an outer array
is stripped to one row per element.  A file that does not parse contributes
nothing and never stops the others.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import run_timestamp
from ..functions.semistructured import parse
from ..operators.numbering import number_rows
from ..schemas import RAW_COLUMNS
from ..session import stored

# the compressions Spark's text source unpacks by name
_JSON_NAME = r"\.json(\.(gz|bz2|deflate|lz4|snappy|zst))?$"
_STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
MAX_FILES = 10_000
_LOOKUPS, LOOKUPS_PER_CORE = "spark.sql.sources.parallelPartitionDiscovery.parallelism", 4


def read_files(spark: SparkSession, path: str, empty: bool = False) -> DataFrame:
    """All files below ``path`` as ``(file_name, content)``; compressed files are unpacked.

    ``file_name`` is the path below ``path``.  Spark's file sources leave out files of zero length;
    with ``empty`` they come from :func:`empty_files`, so that they get an outcome, too.
    """
    found = _named_files(_text_reader(spark, path), path)
    return found.unionByName(empty_files(spark, path)) if empty else found


def _text_reader(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """Files of zero length below ``path`` as ``(file_name, content)``, their content the empty text.

    They are what Spark has listed and its file source does not read.  No content is read; the
    names on the driver are those of Spark's own listing and stay in its JVM.
    """
    jvm = spark._jvm
    listed = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(_text_reader(spark, path)._jdf.inputFiles())
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(F.col("_metadata.file_path").alias("at"))
    names = DataFrame(spark._jsparkSession.createDataset(listed, jvm.org.apache.spark.sql.Encoders.STRING()).toDF(), spark)
    at = lambda c: F.regexp_replace(c, "^([A-Za-z0-9+.-]+):/+", "$1:/")
    rows = names.select(at("value").alias("at")).join(read.select(at("at").alias("at")), "at", "left_anti")
    return rows.select(_name_below(spark, path, F.col("at"), F.element_at(F.split("at", "/"), -1)).alias("file_name"), F.lit("").alias("content"))


def stream_files(spark: SparkSession, path: str, max_files: int | None = MAX_FILES) -> DataFrame:
    """The same frame, subfolders included, as a file stream that picks up new files (of more than no bytes).

    Each micro-batch looks up its files by a Spark job, by default of a task a file, up to 10,000: starting them takes
    longer than reading the files.  How many it takes is a setting of the session that the stream was read in, so it is
    read in a copy of the caller's; the query itself runs in the caller's.
    """
    copy = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    most = int(copy.conf.get(_LOOKUPS))
    copy.conf.set(_LOOKUPS, str(min(most, LOOKUPS_PER_CORE * spark.sparkContext.defaultParallelism)))
    reader = copy.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    plan = reader.load(path)._jdf.logicalPlan()
    files = DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan), spark)
    return _named_files(files, path)


def _named_files(files: DataFrame, path: str) -> DataFrame:
    """Names relative to ``path``; for a path with wildcards, the bare file names."""
    name = _name_below(files.sparkSession, path, F.col("_metadata.file_path"), F.col("_metadata.file_name"))
    return files.select(name.alias("file_name"), F.col("value").alias("content"))


def qualified(spark: SparkSession, path: str) -> str:
    """The full address of ``path``, as Spark's readers resolve it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return re.sub("^([A-Za-z0-9+.-]+):/+", r"\1:/", system.makeQualified(hadoop).toString())


def _name_below(spark: SparkSession, path: str, at: Column, bare: Column) -> Column:
    """The part of a file's address below ``path``, which is resolved as Spark's readers resolve it."""
    root = qualified(spark, path).rstrip("/") + "/"
    encoded = F.regexp_replace(at, r"\+", "%2B")   # a plus is no space here
    full = F.regexp_replace(F.url_decode(encoded), "^([A-Za-z0-9+.-]+):/+", "$1:/")
    return F.when(full.startswith(root), F.substr(full, F.lit(len(root) + 1))).otherwise(F.url_decode(F.regexp_replace(bare, r"\+", "%2B")))


def is_json_name(name: Column | str) -> Column:
    return F.rlike(name, F.lit(_JSON_NAME))


def _parsed(files: DataFrame) -> DataFrame:
    """Adds ``_items``: the documents of a file as an array; NULL where the content does not parse.

    The content is parsed as the only element of an array, so that anything
    after the first value makes it malformed.  The elements of an outer array
    are parsed one by one, each into a value of its own: Spark's size limit for
    semi-structured values holds for a document, not for a file.
    """
    wrapped = F.concat(F.lit("["), "content", F.lit("]"))
    is_array = F.col("content").rlike(r"^[ \t\r\n]*\[")
    parsed = files.withColumns({
        "_many": F.when(is_array, F.from_json(wrapped, "array<array<variant>>", _STRICT_JSON)),
        "_one": F.when(~is_array, F.from_json(wrapped, "array<variant>", _STRICT_JSON))})
    found = F.when(F.size("_many") == 1, F.get("_many", 0)).when(F.size("_one") == 1, F.col("_one"))
    null = parse(F.lit("null"))
    return parsed.withColumn("_items", F.transform(found, lambda x: F.coalesce(x, null))).drop("_many", "_one")


def split_valid(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files with a JSON name and parseable content, and the rest.

    Repeated object keys and text after the document count as malformed.  The files are read and parsed once: the
    verdict is stored beside them, and each side reads the columns that it needs.
    """
    verdict = F.col("_items").isNotNull() & is_json_name(F.col("file_name"))
    judged = stored(_parsed(files).select(*files.columns, verdict.alias("_ok")), "judged")
    return (judged.filter("_ok").select(*files.columns),
            judged.filter("NOT _ok").select(*files.columns))


def load_rows(files: DataFrame, check_names: bool = True) -> DataFrame:
    """``(…, outcome, pos, raw_json)`` from one pass over the files.

    One row per document with outer arrays stripped, and one row without a
    document for a file that is rejected or holds an empty array.  ``outcome`` is
    SUCCESS, FAILED (content does not parse) or ERROR (not a JSON name).
    All columns but ``content`` are carried along.
    """
    carried = [c for c in files.columns if c != "content"]
    named = is_json_name(F.col("file_name")) if check_names else F.lit(True)
    outcome = F.when(~named, "ERROR").when(F.col("_items").isNull(), "FAILED").otherwise("SUCCESS")
    items = F.when(F.col("outcome") == "SUCCESS", F.col("_items"))
    return (
        _parsed(files).withColumn("outcome", outcome)
        .select(*carried, "outcome", F.posexplode_outer(items).alias("pos", "raw_json"))
    )


def documents(files: DataFrame) -> DataFrame:
    """``(…, pos, raw_json)``: one row per document of the files that parse."""
    return load_rows(files, check_names=False).filter("raw_json IS NOT NULL").drop("outcome")


def with_load_metadata(docs: DataFrame, status: str = "PENDING",
                       as_of: datetime | str | None = None) -> DataFrame:
    """Load time and status next to each document."""
    return docs.withColumn("ingestion_timestamp", run_timestamp(as_of)).withColumn(
        "file_status", F.lit(status))


def assign_file_id(docs: DataFrame, start: int = 0, order_by: list[str] | None = None) -> DataFrame:
    """Gap-free ascending ``file_id`` from ``start + 1`` (see ``operators.numbering``)."""
    return number_rows(docs, "file_id", start, order_by)


def spaced_file_id(docs: DataFrame, start: int = 0) -> DataFrame:
    """Unique ``file_id`` above ``start`` without shuffle or second pass, with gaps.

    Each partition counts in a range of its own, so the ids are settled in the
    task that writes the rows.  2**30 partitions fit over the life of a table;
    past 2**62 the caller has to renumber.
    """
    if start >= 1 << 62:
        raise OverflowError("file ids are used up: renumber the table with assign_file_id")
    return docs.withColumn("file_id", F.monotonically_increasing_id() + F.lit(start + 1))


def raw_table(files: DataFrame, as_of: datetime | str | None = None, start: int = 0,
              dense: bool = False, order_by: list[str] | None = None) -> DataFrame:
    """File frame to raw table: only accepted files, ids, load time, PROCESSED.

    ``dense`` or ``order_by`` number without gaps (see :func:`assign_file_id`).
    """
    docs = documents(files.filter(is_json_name(F.col("file_name"))))
    loaded = with_load_metadata(docs, "PROCESSED", as_of)
    numbered = (assign_file_id(loaded, start, order_by) if dense or order_by
                else spaced_file_id(loaded, start))
    return numbered.select(*RAW_COLUMNS)


def read_raw(spark: SparkSession, path: str, as_of: datetime | str | None = None,
             start: int = 0, dense: bool = False) -> DataFrame:
    """Raw table of the JSON files below ``path``."""
    return raw_table(read_files(spark, path), as_of, start, dense)


def ingest_report(loaded: DataFrame) -> DataFrame:
    """One outcome row ``(file_name, status, file_id, message)`` per file.

    ``loaded`` holds the rows of :func:`load_rows` with their ``file_id``; the id
    of a file is that of its newest document, 0 if it held none.
    """
    newest = F.max(F.when(F.col("raw_json").isNotNull(), F.col("file_id")))
    ok = F.col("status") == "SUCCESS"
    return (
        loaded.groupBy("file_name", F.col("outcome").alias("status"))
        .agg(F.coalesce(newest, F.lit(0)).alias("_id"))
        .select(
            "file_name", "status", F.when(ok, F.col("_id")).alias("file_id"),
            F.when(ok, F.concat(F.lit("newest document: "), F.col("_id").cast("string")))
            .when(F.col("status") == "ERROR", "not named as a JSON file")
            .otherwise("not one JSON document or array").alias("message"))
    )


def latest_file_id(raw: DataFrame, name: str | None = None) -> DataFrame:
    """Newest ``file_id`` of one file name (0 if it was never loaded), or of every name."""
    if name is None:
        return raw.groupBy("file_name").agg(F.max("file_id").alias("file_id"))
    return raw.filter(F.col("file_name") == name).agg(
        F.coalesce(F.max("file_id"), F.lit(0)).alias("file_id"))


def wrap_reports(reports: DataFrame, report: str = "report_json") -> DataFrame:
    """Report texts as file-frame rows, each wrapped as ``{"safetyreport": […]}``."""
    wrapped = F.concat(F.lit('{"safetyreport":['), F.col(report), F.lit("]}"))
    return reports.withColumn("content", wrapped).drop(report)


def append_documents(reports: DataFrame, path: str, as_of: datetime | str | None = None,
                     start: int = 0) -> None:
    """Append ``(file_name, report_json)`` rows to the raw table at ``path``.

    Unlike a file, a text that does not parse is an error and nothing is appended.
    """
    docs = wrap_reports(reports).select("file_name", parse("content", strict=True).alias("raw_json"))
    loaded = with_load_metadata(docs, "PROCESSED", as_of)
    spaced_file_id(loaded, start).select(*RAW_COLUMNS).write.mode("append").parquet(path)


def purge_like(raw: DataFrame, pattern: str) -> DataFrame:
    """Raw rows whose file name does not match the LIKE pattern (``_`` is a wildcard)."""
    return raw.filter(~F.coalesce(F.col("file_name").like(pattern), F.lit(False)))
