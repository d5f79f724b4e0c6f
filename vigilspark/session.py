"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "vigilspark", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir`` of the session.

    A machine-local folder is set only where the session names none and runs
    in local mode (tests).
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vigilspark-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/vigilspark/{label}-{uuid.uuid4().hex}"


def one_row(spark: SparkSession, **values: Column) -> DataFrame:
    """A table of one row, made without a Python worker."""
    return spark.range(0, 1, 1, 1).select(*[v.alias(name) for name, v in values.items()])


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder so that later stages can reuse it
    and a lost executor does not recompute it."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as Parquet in the shared folder: like :func:`pin`, and later reads prune columns and skip row groups."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, *steps: Callable[[], None]) -> None:
    """Run independent steps at the same time: the last tasks of one leave cores to the others.

    All are waited for, then the first error is raised.  The jobs keep the local properties of the caller, so what
    cancels the caller's jobs (a stream that is stopped) cancels them, too.
    """
    with ThreadPoolExecutor(max(len(steps), 1)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()
