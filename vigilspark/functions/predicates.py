"""Predicates that are switched on by the arguments a caller supplies."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_of(*conditions: Column | None) -> Column:
    """Conjunction of the given conditions; ``None`` entries are left out."""
    return reduce(and_, [c for c in conditions if c is not None], F.lit(True))


def contains_ci(col: Column | str, pattern: str) -> Column:
    """Case-insensitive containment; ``%`` and ``_`` typed by the user stay wildcards
    and a backslash is an ordinary character."""
    return F.like(F.upper(col), F.upper(F.lit(f"%{pattern}%")), F.lit("\x00"))


def equals_ci(col: Column | str, value: str) -> Column:
    return F.upper(col) == F.upper(F.lit(value))


def at_least(col: Column | str, n: int) -> Column | None:
    """``col >= n``, left out for n = 0."""
    return None if n <= 0 else (F.col(col) if isinstance(col, str) else col) >= n


def in_band(col: Column | str, level: str) -> Column | None:
    """``col = level``, left out for ``All``."""
    return None if level == "All" else (F.col(col) if isinstance(col, str) else col) == level
