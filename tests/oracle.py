"""Compare registered queries with their SQL, run by DuckDB over the same files."""

from __future__ import annotations

import math
from decimal import Decimal
from pathlib import Path

import duckdb

import __spark_entry__ as entry

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        file = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(f"{value:.12g}"))
    return repr(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[int, str | None]:
    """(rows, first difference or None)."""
    df = entry.queries()[name](spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return len(ours), f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours == theirs:
        return len(ours), None
    only = [r for r in ours if r not in set(theirs)][:2]
    other = [r for r in theirs if r not in set(ours)][:2]
    return len(ours), f"{len(ours)} / {len(theirs)} rows; ours {only}; sql {other}"
