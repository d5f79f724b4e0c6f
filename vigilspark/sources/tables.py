"""Result tables: full refresh, clustered layout, upsert and incremental reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "1900-01-01"


def write_table(df: DataFrame, path: str) -> None:
    """Full refresh.  Row order is not a property of a stored table: sort when reading."""
    df.write.mode("overwrite").parquet(path)


def write_clustered(df: DataFrame, path: str, *cols: str) -> None:
    """Full refresh with rows range-clustered by ``cols``.

    Files and row groups then cover narrow value ranges, so a filter on the
    columns skips most of them through the stored min/max values.
    """
    df.repartitionByRange(*cols).sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str] | str) -> DataFrame:
    """``target`` with the rows of ``updates`` replacing those of equal key."""
    keys = [keys] if isinstance(keys, str) else keys
    changed = updates.select(*keys).distinct()
    return target.join(changed, keys, "left_anti").unionByName(updates)


def high_water_mark(target: DataFrame, ts: str = "src_ld_ts") -> Column:
    """Newest load time in ``target`` as a scalar subquery; 1900-01-01 for an empty table."""
    floor = F.lit(EPOCH).cast(target.schema[ts].dataType)
    return target.agg(F.coalesce(F.max(ts), floor)).scalar()


def newer_than_target(source: DataFrame, target: DataFrame, ts: str = "src_ld_ts") -> DataFrame:
    """Rows of ``source`` loaded strictly after everything in ``target``.

    The mark is an uncorrelated scalar subquery: one row, no driver round trip.
    """
    return source.filter(F.col(ts) > high_water_mark(target, ts))
