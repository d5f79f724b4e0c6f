"""Documents that operators must stand: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

PROSE = "The quick brown fox jumps over the lazy dog while seven wizards brew very strange potions near an old stone bridge today"
CLASHING = "score double, key long, spans string, hash long, u long, root long, _key long, label string, half int, n int, features string, _k long, _d long, _id long, __key long, y int, text_ string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}"
ROWS = [
    (1, PROSE), (2, PROSE), (2, PROSE), (3, None), (4, ""), (5, "   \n\t "), (None, PROSE + " and more"), (None, None),
    (6, "a"), (7, "word " * 3000), (8, "x" * 4000), (9, "ünï 漢字 🙂 ▁ é\n\n" * 30), (10, "\x00 odd \x07 bytes"),
    (11, PROSE.replace("fox", "cat")), (12, "line one\nline one\n\nline two\n" * 5), (13, "LOUD WORDS!! EVERYWHERE!! " * 20),
]


def odd(spark: SparkSession, rows=None) -> DataFrame:
    rows = ROWS if rows is None else rows
    filler = (1.5, 7, "s", 8, 1, 2, 3, "l", 4, 5, "f", 6, 9, 10, 11, 1, "t")
    return spark.createDataFrame([(i, t, "en", "src", len(t) if t else None, *filler) for i, t in rows], SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return odd(spark, [])


def bench(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, "item_id long, text string")


def labels(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def alnum_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def spaced_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")
