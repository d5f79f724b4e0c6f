"""Tables, folds and learning rows of the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored  # noqa: F401  shared with the rest of the library


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *stems: str) -> list[str]:
    """A column name for each stem that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = f"_{stem}"
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def held_out(doc_id: Column) -> Column:
    """The fold never learnt from: crc32(doc_id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


MAX_BYTES = 256 << 20      # of the texts that a model is fitted on


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(doc_id, text, y) of at most ``limit`` labelled documents outside the held-out fold, one row an id.

    The documents with the smallest id hashes are taken, the same ones on every run, up to
    ``max_bytes`` of text together; of an id's several texts the one with the smallest hash.  Labels
    that are null or given more than once with different values are left out.
    """
    usable = (labels.select("doc_id", F.col(label).cast("int").alias("y")).where("doc_id IS NOT NULL AND y IN (0, 1)")
              .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("_y"))
              .where("y = _y").drop("_y"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("_t")).select("doc_id", "y", F.col("_t.text").alias("text"))
    rows = stored(one, "learning-rows")
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)   # of ``limit`` sizes
    fits = rows.select("doc_id", F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).over(before).alias("_bytes")).where(
        F.col("_bytes") <= max_bytes).select("doc_id")
    return rows.join(F.broadcast(fits), "doc_id", "left_semi")
