"""One history of a run's tables, shared by streams, batches and compaction.

Every table of a run is a folder ``<out>/<table>/batch_id=<n>``.  A batch writes
only its own folders, so its cost follows the batch and not the table, and a
batch that is run again overwrites exactly what it wrote before.

* **Numbers come from the folder.**  :func:`open_batch` gives a batch the next
  free number, whoever asks: a stream with an old or a new checkpoint, a batch
  increment, a purge.  A step that broke off gets its number again; a
  micro-batch that was closed before and is delivered once more gets none.
* **Only closed batches count.**  :func:`close_batch` writes the ``done`` row
  after everything else; :func:`read_closed` sees closed batches alone, so
  reports never appear without their children.
* **Ids go on.**  ``file_id`` and the marks of what was loaded carry over to the
  folder that :func:`compact` writes.
* **Purged files** are a small table of names; their rows are left out on
  reading and gone after compaction.

The current state of a report is its newest row over all closed batches; its
children are the rows its batch wrote.  A new version with fewer drugs therefore
leaves nothing behind, and the result does not depend on how the input was cut
into batches.  A folder has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.latest import dedupe_latest
from ..plans.reports import newest_reports, pairs_of_reports, report_drugs, report_id, report_reactions, with_flat_arrays
from ..schemas import RAW_COLUMNS, REPORT_COLUMNS
from ..session import one_row, side_by_side, stored
from ..sources.raw import ingest_report, load_rows, spaced_file_id, with_load_metadata

CHILDREN: dict[str, Callable[[DataFrame], DataFrame]] = {
    "report_drugs": report_drugs,
    "report_reactions": report_reactions,
    "drug_reaction_pairs": pairs_of_reports,
}
#: Where a table names the file of a row.
FILE_COLUMN = {"loads": "file_name", "staged": "source_file"}
BATCH = "batch"
MARK = "struct<ingestion_timestamp: timestamp, file_id: bigint>"


def batch_path(out: str, table: str, batch_id: int) -> str:
    return f"{out}/{table}/batch_id={batch_id}"


#: How a history is stored: small, since it is kept and copied, and documents whole.  Spark would shred them into columns
#: of a schema that it guesses from the first rows of each file; steps read whole documents, which it then puts together
#: again from those columns.
STORED = {"compression": "zstd", "spark.sql.variant.inferShreddingSchema": "false"}


def _write(rows: DataFrame, path: str) -> None:
    """Rows of a batch."""
    rows.write.mode("overwrite").options(**STORED).parquet(path)


def read_table(spark: SparkSession, out: str, table: str) -> DataFrame | None:
    """All batches of a table with their ``batch_id``, closed or not; None before the first one."""
    try:
        return spark.read.parquet(f"{out}/{table}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_batch(spark: SparkSession, out: str, table: str, batch_id: int) -> DataFrame | None:
    """One batch of a table; None if it was never written."""
    return read_table(spark, out, f"{table}/batch_id={batch_id}")


def _number(df: DataFrame | None, expression: str) -> int:
    """One aggregate number of a table, 0 for a missing or empty one."""
    value = None if df is None else df.selectExpr(expression).first()[0]
    return 0 if value is None else value


# --- the history ----------------------------------------------------------------


def _log(spark: SparkSession, out: str, table: str) -> DataFrame | None:
    """``claims`` or ``done`` with (batch_id, source, micro); rows of older folders name no source."""
    rows = read_table(spark, out, table)
    if rows is None:
        return None
    for name, kind in (("source", "string"), ("micro", "long")):
        if name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    return rows


def open_batch(spark: SparkSession, out: str, source: str = BATCH, micro: int | None = None) -> int | None:
    """The number of a batch to write, claimed for ``source`` (and its micro-batch); None if that micro-batch is closed.

    A batch that ``source`` opened and never closed is given again.
    """
    done, claims = _log(spark, out, "done"), _log(spark, out, "claims")
    if done is None and claims is None and read_table(spark, out, "load_marks") is not None:
        raise ValueError(f"{out} holds streamed batches without a history: call adopt() on it first")
    mine = (F.col("source") == source) & F.col("micro").eqNullSafe(F.lit(micro))
    if done is not None and micro is not None and done.where((F.col("source") == source) & (F.col("micro") >= micro)).limit(1).count():
        return None
    if claims is not None:
        left = claims.where(mine)
        if done is not None:
            left = left.join(done.select("batch_id"), "batch_id", "left_anti")
        again = left.agg(F.min("batch_id")).first()[0]
        if again is not None:
            return again
    batch_id = max(_number(done, "max(batch_id) + 1"), _number(claims, "max(batch_id) + 1"))
    claim = one_row(spark, source=F.lit(source), micro=F.lit(micro).cast("long"))
    claim.write.mode("overwrite").parquet(batch_path(out, "claims", batch_id))
    return batch_id


def close_batch(raw: DataFrame, batch_id: int, out: str, source: str = BATCH, micro: int | None = None) -> None:
    """Mark a batch increment as completely written, with the newest (load time, ``file_id``) of its documents."""
    newest = raw.agg(F.max(F.struct("ingestion_timestamp", "file_id")).alias("mark"))
    newest.select("mark", F.lit(source).alias("source"), F.lit(micro).cast("long").alias("micro")).write.mode(
        "overwrite").parquet(batch_path(out, "done", batch_id))


def close_unmarked(spark: SparkSession, batch_id: int, out: str, source: str, micro: int | None = None) -> None:
    """Mark a batch of a source that keeps its own progress: nothing is read for it."""
    closing = one_row(spark, mark=F.lit(None).cast(MARK), source=F.lit(source), micro=F.lit(micro).cast("long"))
    closing.write.mode("overwrite").parquet(batch_path(out, "done", batch_id))


def closed_ids(spark: SparkSession, out: str) -> DataFrame | None:
    done = read_table(spark, out, "done")
    return None if done is None else done.select("batch_id").distinct()


def read_closed(spark: SparkSession, out: str, table: str) -> DataFrame | None:
    """Rows of the closed batches of a table, without those of purged files; None if there are none yet."""
    rows, closed = read_table(spark, out, table), closed_ids(spark, out)
    if rows is None or closed is None:
        return None
    rows = rows.join(closed, "batch_id", "left_semi")
    return _unpurged(spark, out, rows, FILE_COLUMN[table]) if table in FILE_COLUMN else rows


def _unpurged(spark: SparkSession, out: str, rows: DataFrame, file: str) -> DataFrame:
    purged, closed = read_table(spark, out, "purged"), closed_ids(spark, out)
    if purged is None:
        return rows
    names = purged.join(closed, "batch_id", "left_semi").select(F.col("name").alias(file), F.col("in_batch").alias("batch_id")).distinct()
    return rows.join(names, [file, "batch_id"], "left_anti").select(*rows.columns)


def adopt(spark: SparkSession, out: str) -> None:
    """Close the batches of a folder that was streamed before batches were closed.

    A batch counts if all its tables are there; the newest of them may be one that broke off, and is left open then.
    """
    there = [t for t in ("loads", "staged", *CHILDREN) if read_table(spark, out, t) is not None]
    batches = None
    for t in there:
        ids = read_table(spark, out, t).select("batch_id").distinct()
        batches = ids if batches is None else batches.join(ids, "batch_id", "left_semi")
    for (batch_id,) in [] if batches is None else batches.orderBy("batch_id").collect():
        close_batch(raw_of(read_batch(spark, out, "loads", batch_id)), batch_id, out, "adopted", batch_id)


# --- the steps of a batch -----------------------------------------------------------


def last_file_id(spark: SparkSession, out: str, batch_id: int) -> int:
    """Highest ``file_id`` given before a batch: one row of the batch before, or else all earlier ones."""
    before = read_batch(spark, out, "load_marks", batch_id - 1)
    if before is not None:
        return _number(before, "max(file_id)")
    earlier = []
    for table in ("load_marks", "loads", "staged"):
        rows = read_table(spark, out, table)
        if rows is not None:
            earlier.append(_number(rows.where(F.col("batch_id") < batch_id), "max(file_id)"))
    return max(earlier, default=0)


def note_file_ids(rows: DataFrame, batch_id: int, out: str, last: int) -> None:
    """The highest ``file_id`` after a batch, so that the next one need not look at earlier loads."""
    rows.agg(F.greatest(F.max("file_id"), F.lit(last)).alias("file_id")).write.mode("overwrite").parquet(
        batch_path(out, "load_marks", batch_id))


def load_batch(files: DataFrame, batch_id: int, out: str, as_of: datetime | str | None = None,
               check_names: bool = True) -> None:
    """Files of a batch to ``loads``: documents and rejected files from one pass."""
    spark = files.sparkSession
    last = last_file_id(spark, out, batch_id)
    rows = with_load_metadata(load_rows(files, check_names), "PROCESSED", as_of)
    _write(spaced_file_id(rows, start=last), batch_path(out, "loads", batch_id))
    note_file_ids(spark.read.parquet(batch_path(out, "loads", batch_id)), batch_id, out, last)


def raw_of(loads: DataFrame) -> DataFrame:
    """The raw table: the documents among the loaded rows."""
    return loads.filter("raw_json IS NOT NULL").select(*RAW_COLUMNS)


def outcomes_of(loads: DataFrame) -> DataFrame:
    """Per-file outcomes of every batch."""
    return ingest_report(loads)


def stage_batch(raw: DataFrame, batch_id: int, out: str, strict: bool = False) -> None:
    """Newest version of each report of the batch, clustered by received date.

    The report id is part of the range key so that a frequent date spreads over
    several files.
    """
    _write_staged(newest_reports(raw, strict), batch_id, out)


def _write_staged(reports: DataFrame, batch_id: int, out: str) -> None:
    """Reports with their nested arrays, clustered; the flat ones are made where the rows have come to lie."""
    keys = ["received_date", "report_id"]
    laid = reports.select(*REPORT_COLUMNS, "file_id", "drugs", "reactions").repartitionByRange(*keys).sortWithinPartitions(*keys)
    _write(with_flat_arrays(laid), batch_path(out, "staged", batch_id))


def children_batch(staged: DataFrame, batch_id: int, out: str,
                   tables: tuple[str, ...] = tuple(CHILDREN), strict: bool = False) -> None:
    """Child and pair rows of the reports a batch staged: each is an explode of the staged rows, in their order."""
    def write(name: str) -> None:
        _write(CHILDREN[name](staged, strict=strict), batch_path(out, name, batch_id))

    side_by_side(staged.sparkSession, *[partial(write, name) for name in tables])


def after_done(raw: DataFrame, out: str) -> DataFrame:
    """Documents beyond the mark of the closed batch increments (streams keep their own progress).

    The mark is a pair, so documents that share a load time with it but have a
    higher ``file_id`` still come.
    """
    done = _log(raw.sparkSession, out, "done")
    if done is None:
        return raw
    mark = done.where(F.coalesce(F.col("source") == BATCH, F.lit(True))).agg(F.max("mark").alias("m")).first()["m"]
    if mark is None:
        return raw
    time = F.lit(mark["ingestion_timestamp"]).cast(raw.schema["ingestion_timestamp"].dataType)
    return raw.filter((F.col("ingestion_timestamp") > time)
                      | ((F.col("ingestion_timestamp") == time) & (F.col("file_id") > mark["file_id"])))


# --- the current state ----------------------------------------------------------------


def current_reports(staged: DataFrame) -> DataFrame:
    """Newest version of every report over all batches in ``staged``."""
    newest = ("src_ld_ts", "file_id")
    return dedupe_latest(staged, newest=(*newest, "batch_id") if "batch_id" in staged.columns else newest)


def without_superseded(staged: DataFrame) -> DataFrame:
    """The same rows of a history, whole rows staying where they are: a batch stages a report once, so the versions
    that a later one replaces are named by (``report_id``, ``batch_id``), a narrow table that is stored and left out.
    """
    keys = staged.select("report_id", "batch_id", "src_ld_ts", "file_id")
    order = Window.partitionBy("report_id").orderBy(*[F.desc(c) for c in ("src_ld_ts", "file_id", "batch_id")])
    old = keys.withColumn("_rank", F.row_number().over(order)).where("_rank > 1").select("report_id", "batch_id")
    return staged.join(stored(old, "superseded"), ["report_id", "batch_id"], "left_anti").select(*staged.columns)


def current_children(children: DataFrame, staged: DataFrame) -> DataFrame:
    """Child rows written by the batch that holds the newest version of their report."""
    newest = current_reports(staged.select("report_id", "src_ld_ts", "file_id", "batch_id"))
    kept = children.join(newest.select("report_id", "batch_id"), ["report_id", "batch_id"], "left_semi")
    return kept.select(*[c for c in children.columns if c != "batch_id"])


def read_current(spark: SparkSession, out: str, table: str = "staged") -> DataFrame:
    """The current rows of ``staged`` or a child table, over all closed batches."""
    staged = read_closed(spark, out, "staged")
    if staged is None:
        raise ValueError(f"{out} holds no closed batch")
    if table == "staged":
        return current_reports(staged)
    return current_children(read_closed(spark, out, table), staged)


def next_batch_id(spark: SparkSession, out: str, table: str = "staged") -> int:
    return _number(read_table(spark, out, table), "max(batch_id) + 1")


# --- purge and compaction ----------------------------------------------------------------


def purge(spark: SparkSession, out: str, pattern: str, raw: DataFrame | None = None, strict: bool = False) -> None:
    """Delete what the files loaded so far whose name matches the LIKE pattern have brought.

    Names are resolved now, so a file of that name that is loaded later stays.  A report whose
    current version goes gets the newest of its other versions back.  Those of other batches are
    still staged; those of its own batch are staged again from ``raw``, by default the stored loads.
    """
    batch_id = open_batch(spark, out, f"purge {pattern}")
    staged, loads = read_closed(spark, out, "staged"), read_closed(spark, out, "loads")
    named = [t.select(F.col(FILE_COLUMN[n]).alias("name"), F.col("batch_id").alias("in_batch"))
             for n, t in (("staged", staged), ("loads", loads)) if t is not None]
    if not named:
        raise ValueError(f"{out} holds no closed batch")
    found = named[0] if len(named) == 1 else named[0].union(named[1])
    found.where(F.col("name").like(pattern)).distinct().write.mode("overwrite").parquet(batch_path(out, "purged", batch_id))
    names = read_batch(spark, out, "purged", batch_id)
    if staged is not None:
        hit = staged.join(names, (F.col("source_file") == F.col("name")) & (F.col("batch_id") == F.col("in_batch")), "left_semi")
        hit.select("report_id").distinct().write.mode("overwrite").parquet(batch_path(out, "purged_reports", batch_id))
        hit = read_batch(spark, out, "purged_reports", batch_id)
        if raw is not None:
            rest = raw.where(~F.coalesce(F.col("file_name").like(pattern), F.lit(False)))
        elif loads is not None:
            rest = raw_of(loads.join(names, (F.col("file_name") == F.col("name")) & (F.col("batch_id") == F.col("in_batch")), "left_anti"))
        if raw is not None or loads is not None:
            rest = rest.withColumn("_id", report_id("raw_json")).join(hit.withColumnRenamed("report_id", "_id"), "_id", "left_semi").drop("_id")
            stage_batch(rest, batch_id, out, strict)
            children_batch(read_batch(spark, out, "staged", batch_id), batch_id, out, strict=strict)
    last = last_file_id(spark, out, batch_id)
    note_file_ids(one_row(spark, file_id=F.lit(last).cast("long")), batch_id, out, last)
    close_unmarked(spark, batch_id, out, f"purge {pattern}")


def compact(spark: SparkSession, source: str, target: str, keep_raw: bool = True) -> None:
    """Current state of ``source`` as the single batch 0 of a new folder ``target``, clustered by received date again.

    Loads come along (only their outcomes without ``keep_raw``), and so do the highest ``file_id``
    and what each stream and increment has closed: a stream goes on in ``target`` with its old
    checkpoint or a new one.  Purged rows, older versions and batches that were never closed stay
    behind.  No stream may write to ``source`` meanwhile.
    """
    done = _log(spark, source, "done")
    if done is None:
        raise ValueError(f"{source} holds no closed batch")
    loads, staged = read_closed(spark, source, "loads"), read_closed(spark, source, "staged")

    def copy_loads() -> None:
        rows = loads if keep_raw else loads.withColumn("raw_json", F.when(F.lit(False), F.col("raw_json")))
        _write(rows.drop("batch_id"), batch_path(target, "loads", 0))

    def copy_reports() -> None:
        _write_staged(without_superseded(staged).drop("batch_id"), 0, target)
        children_batch(read_batch(spark, target, "staged", 0), 0, target,
                       tuple(t for t in CHILDREN if read_table(spark, source, t) is not None))

    side_by_side(spark, *[copy for copy, rows in ((copy_loads, loads), (copy_reports, staged)) if rows is not None])
    last = last_file_id(spark, source, 1 << 62)
    note_file_ids(one_row(spark, file_id=F.lit(last).cast("long")), 0, target, last)
    done.groupBy("source").agg(F.max("mark").alias("mark"), F.max("micro").alias("micro")).write.mode("overwrite").parquet(
        batch_path(target, "done", 0))
