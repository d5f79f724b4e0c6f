"""Make this package importable in Python workers."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to every worker of the application, once, by Spark's own file service."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    path = Path(tempfile.mkdtemp(prefix="vigilspark-")) / "vigilspark.zip"   # the driver's own; Spark serves it
    path.write_bytes(packed.getvalue())
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)
