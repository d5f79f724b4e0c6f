"""Tables kept by key: an upsert rewrites only the partitions its keys fall into.

A table is a folder with ``rows`` (Parquet, partitioned by a hash of the key), ``layout`` (key
columns and number of partitions, one row) and ``pending``.  The rows of the touched partitions
are first written, merged, to the shared folder and named in ``pending``; then they replace the
partitions (dynamic partition overwrite).  A run that breaks off in between is finished by the
next call from what ``pending`` names, so no partition is ever lost or half new.  A deleted key
leaves a marker that the next rewrite of its partition drops.

One writer at a time.  Readers that need all partitions of one state should not run while an
upsert commits.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructType

from ..session import one_row, scratch_path

BUCKETS = 32
_PART, _GONE = "key_part", "key_gone"


def _part(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _replace(rows: DataFrame, path: str) -> None:
    """Rows as whole partitions; AQE sizes the files, so a large partition gets several."""
    (rows.hint("rebalance", F.col(_PART)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(_PART).parquet(f"{path}/rows"))


def _note(spark: SparkSession, path: str, where: str | None) -> None:
    """Name the merged rows that are to replace their partitions; None: there are none."""
    one_row(spark, rows=F.lit(where)).write.mode("overwrite").parquet(f"{path}/pending")


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a replacement that broke off; whether there was one."""
    pending = _read(spark, f"{path}/pending")
    left = pending.first() if pending is not None else None
    if left is None or left["rows"] is None:
        return False
    _replace(spark.read.parquet(left["rows"]), path)
    _note(spark, path, None)       # nothing is left to do
    return True


def write_keyed(df: DataFrame, path: str, keys: list[str] | str, buckets: int = BUCKETS) -> None:
    """A new keyed table of ``df``, one row a key; ``path`` must not hold one yet.

    The layout is written last, so a table counts as there once its rows are complete.
    """
    keys = [keys] if isinstance(keys, str) else keys
    if _read(df.sparkSession, f"{path}/layout") is not None:
        raise ValueError(f"{path} already holds a keyed table")
    rows = df.withColumn(_GONE, F.lit(False)).withColumn(_PART, _part(keys, buckets))
    rows.hint("rebalance", F.col(_PART)).write.mode("overwrite").partitionBy(_PART).parquet(f"{path}/rows")
    layout = one_row(df.sparkSession, keys=F.array(*[F.lit(k) for k in keys]), buckets=F.lit(buckets), columns=F.lit(df.schema.json()))
    layout.write.mode("overwrite").parquet(f"{path}/layout")


def is_keyed(spark: SparkSession, path: str) -> bool:
    return _read(spark, f"{path}/layout") is not None


def _layout(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/layout").first()


def _rows(spark: SparkSession, path: str, layout) -> DataFrame:
    columns = StructType.fromJson(json.loads(layout["columns"]))
    return spark.read.schema(columns.add(_GONE, BooleanType()).add(_PART, IntegerType())).parquet(f"{path}/rows")


def read_keyed(spark: SparkSession, path: str) -> DataFrame:
    """All rows."""
    recover(spark, path)
    return _rows(spark, path, _layout(spark, path)).where(~F.col(_GONE)).drop(_GONE, _PART)


def _touched(keyed: DataFrame, keys: list[str], buckets: int) -> list[int]:
    """Partitions that hold the keys: at most ``buckets`` numbers reach the driver."""
    return [r[0] for r in keyed.select(_part(keys, buckets)).distinct().collect()]


def _same(left: str, right: str, keys: list[str]) -> Column:
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return on


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key is among ``wanted``: other partitions are not read."""
    recover(spark, path)
    layout = _layout(spark, path)
    keys = layout["keys"]
    rows = _rows(spark, path, layout).where(F.col(_PART).isin(_touched(wanted, keys, layout["buckets"])) & ~F.col(_GONE))
    return rows.alias("t").join(wanted.select(*keys).alias("w"), _same("t", "w", keys), "left_semi").drop(_GONE, _PART)


def upsert_keyed(spark: SparkSession, path: str, updates: DataFrame, gone: Column | None = None) -> int:
    """Replace or add the rows of ``updates`` (one a key, the table's columns); those that are ``gone`` are deleted.

    Returns the number of partitions that were rewritten.
    """
    recover(spark, path)
    layout = _layout(spark, path)
    keys, buckets = layout["keys"], layout["buckets"]
    rows = _rows(spark, path, layout)
    kept = [c for c in rows.columns if c not in (_GONE, _PART)]
    gone = F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))
    new = updates.withColumn(_GONE, gone)
    new = new.select(*[F.when(F.col(_GONE), F.lit(None)).otherwise(F.col(c)).alias(c) if c not in keys else F.col(c) for c in kept], _GONE)
    touched = _touched(updates, keys, buckets)
    if not touched:
        return 0
    old = rows.where(F.col(_PART).isin(touched) & ~F.col(_GONE)).drop(_PART)
    left = old.alias("t").join(new.select(*keys).alias("u"), _same("t", "u", keys), "left_anti")
    merged = left.unionByName(new).withColumn(_PART, _part(keys, buckets))
    where = scratch_path(spark, "upsert")
    merged.write.parquet(where)
    _note(spark, path, where)
    recover(spark, path)
    return len(touched)
