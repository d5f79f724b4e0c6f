"""Batches of reports as bucketed catalog tables: the newest versions without a shuffle.

A history folder is copied, batch after batch, into tables that are partitioned by ``batch_id`` and
bucketed and sorted by ``report_id``.  All versions of a report then lie in files of one bucket,
whichever batch brought them, so the ranking of versions and the join of children to them read
buckets in place and need no Exchange.  The bucket count is a property of the tables: choose it so
that a bucket of all batches fits a task, and copy into new tables to change it.

The files lie in the history folder, below ``bucketed``; the tables' names and bucketing live in the
session's catalog, which has to be a lasting one where sessions come and go.

Copying a batch again replaces it.  Purged files are left out when a batch is copied; batches copied
before a purge are copied again by :func:`sync` with ``again``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.batches import CHILDREN, closed_ids, current_reports, read_closed, read_table

BUCKETS = 64
KEY, BATCH_ID = "report_id", "batch_id"


def table_name(prefix: str, name: str) -> str:
    return f"{prefix}_{name}"


def _copy(df: DataFrame, name: str, path: str, buckets: int) -> None:
    """Write whole batches of ``df`` into a bucketed table with its files at ``path``, one file a bucket and batch."""
    spark = df.sparkSession
    rows = df.select(*[c for c in df.columns if c != BATCH_ID], F.col(BATCH_ID).cast("long").alias(BATCH_ID)).repartition(buckets, KEY)
    if not spark.catalog.tableExists(name):
        rows.write.partitionBy(BATCH_ID).bucketBy(buckets, KEY).sortBy(KEY).option("path", path).format("parquet").saveAsTable(name)
        return
    mode = "spark.sql.sources.partitionOverwriteMode"      # a table's insert takes it from the session alone
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        rows.sortWithinPartitions(BATCH_ID, KEY).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def sync(spark: SparkSession, out: str, prefix: str, buckets: int = BUCKETS, again: bool = False) -> list[int]:
    """Copy the closed batches of a history folder that the tables do not hold yet (all, with ``again``); their numbers."""
    ids = closed_ids(spark, out)
    there = spark.catalog.tableExists(table_name(prefix, "copied"))
    if there and not again:
        ids = ids.join(spark.table(table_name(prefix, "copied")), BATCH_ID, "left_anti")
    batches = sorted(r[0] for r in ids.collect())
    if not batches:
        return []
    for name in ("staged", *CHILDREN):
        if read_table(spark, out, name) is not None:
            _copy(read_closed(spark, out, name).where(F.col(BATCH_ID).isin(batches)), table_name(prefix, name), f"{out}/bucketed/{name}", buckets)
    done = ids if not there or not again else ids.join(spark.table(table_name(prefix, "copied")), BATCH_ID, "left_anti")
    done.select(F.col(BATCH_ID).cast("long").alias(BATCH_ID)).coalesce(1).write.mode("append").option(
        "path", f"{out}/bucketed/copied").saveAsTable(table_name(prefix, "copied"))   # last
    return batches


def _copied(spark: SparkSession, prefix: str, name: str) -> DataFrame:
    return spark.table(table_name(prefix, name))


def bucketed_reports(spark: SparkSession, prefix: str) -> DataFrame:
    """Newest version of every report; each bucket is ranked where it lies."""
    return current_reports(_copied(spark, prefix, "staged"))


def bucketed_children(spark: SparkSession, prefix: str, name: str) -> DataFrame:
    """Child rows of the newest versions.

    Both sides are laid out by report alone, so the batch is compared beside the join key, not as one.
    """
    newest = current_reports(_copied(spark, prefix, "staged").select(KEY, "src_ld_ts", "file_id", BATCH_ID)).select(KEY, BATCH_ID)
    rows = _copied(spark, prefix, name)
    same = (F.col(f"c.{KEY}") == F.col(f"n.{KEY}")) & (F.col(f"c.{BATCH_ID}") - F.col(f"n.{BATCH_ID}") == 0)
    return rows.alias("c").join(newest.alias("n"), same, "left_semi").drop(BATCH_ID)
