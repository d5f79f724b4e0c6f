"""Many-to-many join inside a key, with the work of large keys split.

A key with l left rows and r right rows makes l*r pairs, so its cost is not
visible in its input size.  Keys with more than ``block`` rows on a side are
found by one key-only aggregation and laid out as a grid: their left rows are
dealt into ``ceil(l/block)`` stripes, the right rows into ``ceil(r/block)``, and
every row is copied to the cells of its stripe.  Each pair meets in exactly one
cell, a cell holds about block*block pairs, and all cells shuffle independently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin

BLOCK = 2048
MAX_BROADCAST_KEYS = 100_000


def large_keys(left: DataFrame, right: DataFrame, key: str, block: int = BLOCK) -> DataFrame | None:
    """``(key, left_stripes, right_stripes)`` of the keys to split; None if there is none.

    A key that is large on one side and absent on the other is listed with 0
    stripes there: it makes no pairs, but its rows must not meet in one task
    either.  One aggregation over the key column finds the list, which is pinned
    once.  It is marked for broadcast up to ``MAX_BROADCAST_KEYS`` rows and joined
    by shuffle beyond.
    """
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = left.select(key, one.alias("l"), zero.alias("r")).unionAll(
        right.select(key, zero.alias("l"), one.alias("r")))
    large = (
        sides.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
        .filter(F.greatest("l", "r") > block)
        .select(key, F.ceil(F.col("l") / block).alias("left_stripes"),
                F.ceil(F.col("r") / block).alias("right_stripes"))
    )
    large = pin(large)
    n = large.count()
    if n == 0:
        return None
    return F.broadcast(large) if n <= MAX_BROADCAST_KEYS else large


def grid_join(left: DataFrame, right: DataFrame, key: str, large: DataFrame) -> DataFrame:
    """Inner join on the keys of ``large``, the rows of each spread over its grid."""
    two_sided = large.filter("left_stripes > 0 AND right_stripes > 0")

    def laid_out(df: DataFrame, own: str, own_axis: str, other: str, other_axis: str) -> DataFrame:
        stripe = F.pmod(F.xxhash64(*df.columns), F.col(own))
        copies = F.sequence(F.lit(0).cast("long"), F.col(other) - 1)
        return (
            df.join(two_sided, key)
            .withColumn(own_axis, stripe)
            .withColumn(other_axis, F.explode(copies))
            .drop("left_stripes", "right_stripes")
        )

    cell = [key, "_row", "_col"]
    left = laid_out(left, "left_stripes", "_row", "right_stripes", "_col")
    right = laid_out(right, "right_stripes", "_col", "left_stripes", "_row")
    return spread(left, *cell).join(spread(right, *cell), cell).drop("_row", "_col")


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash partitioning into a fixed number of partitions.

    Cells are small to shuffle and large to multiply, so partitions must not be
    merged by their size in bytes; a given number keeps Spark from doing so.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def array_grid(df: DataFrame, left: str, right: str, volume: str, key: str,
               block: int = BLOCK) -> DataFrame:
    """Rows that hold two arrays, ready for a double explode: ``left`` x ``right``.

    A row whose arrays multiply to more than block*block pairs (its stored
    ``volume``) is cut into cells of at most ``block`` elements a side and the
    cells are spread; all other rows stay where they are.  ``left_from`` and
    ``right_from`` are the positions at which the slices start.  Rows with no
    pairs are dropped.  On a stored table the test on ``volume`` is answered by
    the file statistics, so the large branch reads next to nothing.
    """
    limit, zero = block * block, F.lit(0)
    small = df.filter((F.col(volume) > 0) & (F.col(volume) <= limit)).withColumns(
        {"left_from": zero, "right_from": zero})

    def starts(array: str):
        return F.explode(F.sequence(zero, F.size(array) - 1, F.lit(block)))

    def cut(array: str, start: str):
        return F.slice(array, F.col(start) + 1, block)

    large = (
        df.filter(F.col(volume) > limit)
        .withColumn("left_from", starts(left)).withColumn("right_from", starts(right))
        .withColumns({left: cut(left, "left_from"), right: cut(right, "right_from")})
    )
    return small.unionByName(spread(large, key, "left_from", "right_from"))


def join_within(left: DataFrame, right: DataFrame, key: str, block: int = BLOCK, longest: int | None = None) -> DataFrame:
    """Every left x right combination inside ``key``.

    ``longest`` is the largest number of rows that a key has on a side, where the caller knows it
    (staged reports do): at most ``block`` means that there is no large key to look for.
    """
    large = None if longest is not None and longest <= block else large_keys(left, right, key, block)
    if large is None:
        return left.join(right, key)
    # ordinary keys keep the join that Spark plans and sizes for them
    small = left.join(large, key, "left_anti").join(right.join(large, key, "left_anti"), key)
    return small.unionByName(grid_join(left, right, key, large))
