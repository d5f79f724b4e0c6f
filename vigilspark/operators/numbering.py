"""Consecutive row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import pin


def number_rows(df: DataFrame, name: str, start: int = 0,
                order_by: list[str | Column] | None = None) -> DataFrame:
    """Gap-free numbers from ``start + 1`` in column ``name``.

    Rows are numbered inside their partition and the numbering is pinned in the
    shared folder, so a lost executor cannot renumber them.  The offsets of the
    partitions are then a table of at most one row per partition, which bounds
    the only global window and the broadcast below.  By default rows keep the
    partitions they have (no shuffle); ``order_by`` range-partitions them first
    so that the numbers follow that order.
    """
    if order_by:
        df = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    numbered = pin(df.withColumn("_row", F.monotonically_increasing_id()))
    part, within = F.shiftright("_row", 33), F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.lit(start) + F.col("_before") + within + 1)
        .drop("_row", "_part", "_before")
    )
