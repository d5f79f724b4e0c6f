"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(u, root) of every vertex of ``links`` (u, v) that is not the smallest of its component.

    Rounds are logarithmic in the component size.  A vertex with very many links only meets
    aggregations that combine before the shuffle and joins that AQE can split.
    """
    edges = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                   "links")
    before = _digest(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least).distinct())
        edges = stored(small, "links")
        if (after := _digest(edges)) == before:
            break
        before = after
    return edges.select("u", F.col("v").alias("root"))
