"""Words as DataFrame expressions (no Python in tasks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Between words of letters, digits and everything beyond ASCII.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPACES = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def alnum_words(text: Column) -> Column:
    """Words of lower-cased letters, digits and non-ASCII characters; a null text has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAK), "")


def count_alnum_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), ANY_CASE_BREAK), "")).cast("long")


def spaced_words(text: Column) -> Column:
    """Words between ASCII white space."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")


def upto(n: Column) -> Column:
    """[0, n - 1]; empty where n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def gram_hashes(hashes: str, k: int) -> Column:
    """Hash of every k neighbours of the column ``hashes``."""
    return F.transform(upto(F.size(hashes) - k + 1), lambda i: F.xxhash64(*[F.get(F.col(hashes), i + j) for j in range(k)]))
