"""All tables of a run, in dependency order, as a full refresh or an increment.

``staged`` and the child tables are kept per batch in the history that streams and
compaction share (see ``streaming.batches``); readers of the current state and the
marts see closed batches alone.

The marts follow the history by signed changes.  ``current`` keeps the version of
each report that the marts count (a keyed table); a build reads the batches closed
since the last one, looks up what they replace in the touched partitions of
``current``, adds the new versions' tally and takes the old ones' off.  Reports that
did not change are not read.  Each build writes a folder of its own and a row in
``published`` last: readers (:func:`read_mart`) see the last complete marts, never
half of the next.  ``current`` is brought up to a build after it was published, by a
step that can be repeated; the next build repeats it where it broke off.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tally import pair_counts, tally_change, tally_reports
from ..schemas import MIN_PAIR_REPORTS
from ..session import one_row, stored
from ..sources.keyed import BUCKETS, is_keyed, lookup, upsert_keyed, write_keyed
from ..sources.tables import write_table
from ..streaming.batches import (
    CHILDREN, after_done, batch_path, children_batch, close_batch, closed_ids, current_reports, last_file_id,
    note_file_ids, open_batch, read_closed, read_table, stage_batch,
)
from .marts import drug_stats_of_totals, drug_totals, summarise_drugs
from .signals import signals_from_tally

#: What the marts need of a report, and what tells its versions apart.
COUNTED = ["report_id", "patient_age", "drug_names", "reaction_terms", "pair_volume", "src_ld_ts", "file_id"]
AGES = "decimal(38,2)"


def build_tables(spark: SparkSession, raw: DataFrame, out: str, mode: str = "full",
                 children: tuple[str, ...] = tuple(CHILDREN), min_reports: int = MIN_PAIR_REPORTS,
                 as_of: datetime | str | None = None, strict: bool = False) -> None:
    """Stage, explode and aggregate ``raw`` below ``out``.

    ``full`` expects a folder without closed batches; ``incremental`` stages only
    documents beyond what the closed increments hold.
    """
    if mode not in ("full", "incremental"):
        raise ValueError("mode is full or incremental")
    closed = closed_ids(spark, out)
    if mode == "full" and closed is not None and closed.limit(1).count():
        raise ValueError(f"{out} already holds tables; a full refresh goes to a new folder")
    raw = after_done(raw, out)
    batch_id = open_batch(spark, out)
    stage_batch(raw, batch_id, out, strict)
    children_batch(spark.read.parquet(batch_path(out, "staged", batch_id)), batch_id, out, children, strict)
    # both marks from one pass over the documents
    marks = stored(raw.agg(F.max("file_id").alias("file_id"), F.max(F.struct("ingestion_timestamp", "file_id")).alias("mark")), "marks")
    note_file_ids(marks, batch_id, out, last_file_id(spark, out, batch_id))
    close_batch(marks.where("mark IS NOT NULL").select("mark.*"), batch_id, out)
    build_marts(spark, out, min_reports, as_of)


def build_marts(spark: SparkSession, out: str, min_reports: int = MIN_PAIR_REPORTS,
                as_of: datetime | str | None = None, buckets: int = BUCKETS) -> None:
    """Pair tally, pair mart, drug mart and signals of the current reports, from the last build and what changed since."""
    staged = read_closed(spark, out, "staged")
    if staged is None:
        raise ValueError(f"{out} holds no closed batch of reports")
    last = _published(spark, out)
    run = uuid.uuid4().hex
    at, before = f"{out}/marts/{run}", f"{out}/marts/{last['run']}" if last else None
    if before and read_table(spark, before, "batches") is None:
        before = None       # marts of an earlier version, which kept no changes: build from the beginning
    elif before and last["number"] > _applied(spark, out):
        _apply(spark, out, last, buckets)
    batches = _new_batches(spark, out, before)
    seen = closed_ids(spark, out)       # those of the last build among them
    seen.where(F.col("batch_id").isin(batches)).unionByName(
        spark.read.parquet(f"{before}/batches") if before else seen.limit(0)).coalesce(1).write.parquet(f"{at}/batches")
    _changes(spark, out, staged, batches, before is not None).write.parquet(f"{at}/changes")
    changes = spark.read.parquet(f"{at}/changes")
    new = changes.where("NOT gone").select("new.*")
    old = changes.where("old IS NOT NULL").select("old.*")
    stored = (lambda name: spark.read.parquet(f"{before}/{name}")) if before else (lambda name: None)
    write_table(tally_change(stored("pair_tally"), tally_reports(new), tally_reports(old)), f"{at}/pair_tally")
    tally = spark.read.parquet(f"{at}/pair_tally")
    write_table(_changed_totals(stored("drug_totals"), new, old), f"{at}/drug_totals")
    write_table(_report_count(stored("report_count"), changes), f"{at}/report_count")
    total = spark.read.parquet(f"{at}/report_count")
    write_table(pair_counts(tally), f"{at}/pair_report_counts")
    write_table(summarise_drugs(drug_stats_of_totals(spark.read.parquet(f"{at}/drug_totals")), ordered=False), f"{at}/drug_summary")
    write_table(signals_from_tally(tally, None, min_reports, as_of=as_of, total=total), f"{at}/risk_signals")
    number = last["number"] + 1 if last else 0
    one_row(spark, number=F.lit(number).cast("long"), run=F.lit(run)).write.mode("append").parquet(f"{out}/published")
    _apply(spark, out, _published(spark, out), buckets)


def _new_batches(spark: SparkSession, out: str, before: str | None) -> list[int]:
    """Batches closed since the last build: their numbers, which prune the folders to read."""
    ids = closed_ids(spark, out)
    if before:
        seen = spark.read.parquet(f"{before}/batches")
        ids = ids.join(seen, "batch_id", "left_anti")
    return sorted(r[0] for r in ids.collect())


def _changes(spark: SparkSession, out: str, staged: DataFrame, batches: list[int], started: bool) -> DataFrame:
    """(report_id, new, old, gone): every report whose counted version is another one now, with both versions.

    Reports of the new batches count if they are newer than the version counted so far.  Reports
    that a purge has touched are looked up over all batches: they may fall back, or be gone.
    """
    fresh = staged.where(F.col("batch_id").isin(batches))
    fresh = (fresh if len(batches) == 1 else current_reports(fresh)).select(*COUNTED)     # a batch stages a report once
    purged = read_table(spark, out, "purged_reports") if started else None
    if purged is not None:
        purged = purged.where(F.col("batch_id").isin(batches)).select("report_id").distinct()
        again = current_reports(staged.join(purged, "report_id", "left_semi")).select(*COUNTED)
        fresh = fresh.join(purged, "report_id", "left_anti").withColumn("_purged", F.lit(False))
        lost = purged.join(again, "report_id", "left_anti").select("report_id")
        fresh = fresh.unionByName(again.withColumn("_purged", F.lit(True))).unionByName(
            lost.withColumn("_purged", F.lit(True)), allowMissingColumns=True)
    else:
        fresh = fresh.withColumn("_purged", F.lit(False))
    new = F.struct(*COUNTED)
    rows = fresh.select("report_id", "_purged", new.alias("new"), F.col("src_ld_ts").isNull().alias("gone"))
    if not started:
        return rows.select("report_id", "new", F.when(F.lit(False), F.col("new")).alias("old"), "gone")
    old = lookup(spark, f"{out}/current", rows.select("report_id")).select("report_id", F.struct(*COUNTED).alias("old"))
    both = rows.join(old, "report_id", "left")
    newer = F.struct("new.src_ld_ts", "new.file_id") > F.struct("old.src_ld_ts", "old.file_id")
    moved = F.col("old").isNull() & ~F.col("gone") | F.col("old").isNotNull() & (F.col("_purged") | newer)
    return both.where(moved).select("report_id", "new", "old", "gone")


def _changed_totals(stored: DataFrame | None, new: DataFrame, old: DataFrame) -> DataFrame:
    parts = ["total_reports", "age_sum", "age_rows"]
    shown = lambda df, sign: df.select(
        "drug_name", *[(F.coalesce(F.col(c), F.lit(0)).cast(AGES if c == "age_sum" else "long") * sign).cast(AGES if c == "age_sum" else "long").alias(c) for c in parts])
    signed = shown(drug_totals(new), 1).unionByName(shown(drug_totals(old), -1))
    if stored is not None:
        signed = stored.unionByName(signed)
    sums = signed.groupBy("drug_name").agg(*[F.sum(c).cast(AGES if c == "age_sum" else "long").alias(c) for c in parts])
    return sums.where("total_reports <> 0")


def _report_count(stored: DataFrame | None, changes: DataFrame) -> DataFrame:
    """Number of reports, one row."""
    more = F.when(~F.col("gone"), 1).otherwise(0) - F.when(F.col("old").isNotNull(), 1).otherwise(0)
    count = changes.agg(F.coalesce(F.sum(more), F.lit(0)).alias("total_report_count"))
    if stored is not None:
        count = stored.unionByName(count).agg(F.sum("total_report_count").alias("total_report_count"))
    return count


def _apply(spark: SparkSession, out: str, published, buckets: int) -> None:
    """Bring ``current`` up to a published build; repeating it changes nothing."""
    at = f"{out}/marts/{published['run']}"
    changes = spark.read.parquet(f"{at}/changes")
    if is_keyed(spark, f"{out}/current"):
        rows = changes.select("report_id", "gone", *[F.col(f"new.{c}").alias(c) for c in COUNTED[1:]])
        upsert_keyed(spark, f"{out}/current", rows, F.col("gone"))
    else:
        write_keyed(changes.where("NOT gone").select("new.*"), f"{out}/current", "report_id", buckets)
    one_row(spark, number=F.lit(published["number"]).cast("long")).write.mode("append").parquet(f"{out}/applied")


def _published(spark: SparkSession, out: str):
    runs = read_table(spark, out, "published")
    return None if runs is None else runs.orderBy(F.desc("number"), "run").first()


def _applied(spark: SparkSession, out: str) -> int:
    steps = read_table(spark, out, "applied")
    return -1 if steps is None else steps.agg(F.max("number")).first()[0]


def read_mart(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A mart of the last complete run."""
    return spark.read.parquet(f"{out}/marts/{_published(spark, out)['run']}/{name}")
