"""Access to semi-structured (VARIANT) columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parse(text: Column | str, strict: bool = False) -> Column:
    """Text to a semi-structured value; malformed text is NULL unless ``strict``."""
    return F.parse_json(text) if strict else F.try_parse_json(text)


def path(doc: Column | str, where: str, type_: str = "string", strict: bool = False) -> Column:
    """Value at ``where`` cast to ``type_``.

    A missing path, an index into a non-array and a JSON null are all NULL.  A
    value that does not fit the type is NULL, or an error when ``strict``.
    """
    return F.variant_get(doc, where, type_) if strict else F.try_variant_get(doc, where, type_)


def first_path(doc: Column | str, *where: str, type_: str = "string", strict: bool = False) -> Column:
    """First non-NULL value among several paths."""
    return F.coalesce(*[path(doc, p, type_, strict) for p in where])


def elements(doc: Column | str, where: str = "$") -> Column:
    """The array at ``where`` as ``array<variant>``; NULL for anything but an array."""
    return F.try_variant_get(doc, where, "array<variant>")


def flatten(df: DataFrame, array: Column | str, outer: bool = True,
            value: str = "element", index: str = "index") -> DataFrame:
    """One row per array element with its 0-based index.

    ``outer`` keeps a row without an array (or with an empty one) as a single
    row holding NULLs.
    """
    explode = F.posexplode_outer if outer else F.posexplode
    return df.select("*", explode(array).alias(index, value))
