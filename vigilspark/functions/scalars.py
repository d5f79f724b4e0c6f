"""Scalar expressions of the report tables and the signal statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import (
    ELEVATED_PRR, HIGH_PRR, HIGH_REPORTS, MEDIUM_REPORTS, MIN_PAIR_REPORTS,
)


def parse_date(text: Column, *formats: str) -> Column:
    """First of ``formats`` that reads the text; NULL when none does.

    The formats are of fixed width, so a text of another length is not tried: a
    failed attempt costs Spark an exception.
    """
    return F.coalesce(*[F.when(F.length(text) == len(f), F.try_to_date(text, f)) for f in formats])


def fit(value: Column, type_: str, strict: bool = False) -> Column:
    """Cast that yields NULL on a misfit, or raises when ``strict``.

    A date must be written in full: Spark's cast would complete a year or a month.
    """
    fitted = value.try_cast(type_)
    if type_ == "date":
        fitted = F.when(value.cast("string").rlike(r"^\d{4}-\d{2}-\d{2}$"), fitted)
    if not strict:
        return fitted
    misfit = F.concat(F.lit(f"does not fit {type_}: "), value.cast("string"))
    return F.coalesce(fitted, F.when(value.isNotNull(), F.raise_error(misfit)).cast(type_))


def make_key(*parts: Column | str) -> Column:
    """Concatenated key; NULL as soon as one part is NULL."""
    return F.concat(*parts)


def least_ts(a: Column | str, b: Column | str) -> Column:
    """Earlier of two timestamps, NULL if either is NULL."""
    a, b = _col(a), _col(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def ratio(numerator: Column, denominator: Column, guard: Column) -> Column:
    """Double division where ``guard`` holds, else NULL."""
    return F.when(guard, numerator.cast("double") / denominator.cast("double"))


def risk_band(total: Column, high: int = HIGH_REPORTS, medium: int = MEDIUM_REPORTS) -> Column:
    return F.when(total >= high, "HIGH").when(total >= medium, "MEDIUM").otherwise("LOW")


def signal_band(prr: Column, high: float = HIGH_PRR, elevated: float = ELEVATED_PRR) -> Column:
    """Band of a PRR; a NULL PRR is BASELINE."""
    return F.when(prr > high, "HIGH").when(prr > elevated, "ELEVATED").otherwise("BASELINE")


def significant(prr: Column, reports: Column, high: float = HIGH_PRR,
                min_reports: int = MIN_PAIR_REPORTS) -> Column:
    """Never NULL: an unknown PRR is not significant."""
    return F.when((prr > high) & (reports >= min_reports), True).otherwise(False)


def run_timestamp(as_of: datetime | str | None = None) -> Column:
    """Stamp of a run; ``as_of`` makes it reproducible."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp")


def round_display(value: Column, digits: int = 1) -> Column:
    return F.round(value, digits)


# --- 2 x 2 table metrics over long counts --------------------------------


def ror(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Reporting odds ratio A*D / (B*C); needs B, C and D above zero."""
    guard = (b > 0) & (c > 0) & (d > 0)
    # multiplied as doubles: A*D of two large counts can pass the long range
    return ratio(a.cast("double") * d.cast("double"), b.cast("double") * c.cast("double"), guard)


def prr(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Proportional reporting ratio (A/(A+B)) / (C/(C+D)); needs C above zero."""
    guard = (a + b > 0) & (c + d > 0) & (c > 0)
    return F.when(guard, (a / (a + b)) / (c / (c + d)))


def ror_simple(a: Column, b: Column, c: Column, d: Column) -> Column:
    """(A/B) / (C/D) under the guard of :func:`ror`."""
    guard = (b > 0) & (c > 0) & (d > 0)
    return F.when(guard, (a / b) / (c / d))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
