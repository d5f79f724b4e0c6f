"""Registered queries: the library run over the driver's tables, with reference SQL.

A query is a function ``(spark, sf_dir) -> DataFrame``; its SQL, where given,
computes the same rows over the same tables.  Dates are shown as ISO text, so
that both sides can be compared without regard to a client's date type.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def dates_as_text(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema if f.dataType.typeName() == "date"]
    return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``."""

    def register(fn: Query) -> Query:
        QUERIES[name] = wraps(fn)(lambda spark, sf_dir: dates_as_text(fn(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def load_all() -> None:
    from . import (  # noqa: F401
        documents, incremental, ingest, marts, patients, quality, scalars, signals,
    )
