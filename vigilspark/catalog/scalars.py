"""Queries for single scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions import scalars as S
from ..functions.semistructured import parse, path
from . import query
from .bindings import table


@query("parse_date_multi", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 IN (0, 1) THEN o_orderdate::DATE::VARCHAR END
  AS parsed FROM orders""")
def parse_date_multi(spark, sf_dir):
    text = F.expr("""CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate, 'yyyyMMdd')
      WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 2 THEN '20240231' WHEN 3 THEN '' END""")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", S.parse_date(text, "yyyyMMdd", "yyyy-MM-dd").alias("parsed"))


@query("cast_date_strict", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 > 1 THEN o_orderdate::DATE::VARCHAR END AS onset
  FROM orders""")
def cast_date_strict(spark, sf_dir):
    """The lenient cast: a date must be written in full, and what is not (a year alone, a time after the day) is NULL.

    The cast that raises instead is run by ``cast_date_strict_raises``.
    """
    text = F.expr("""CASE o_orderkey % 5 WHEN 0 THEN date_format(o_orderdate, 'yyyy')
      WHEN 1 THEN concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T99') ELSE date_format(o_orderdate, 'yyyy-MM-dd') END""")
    doc = parse(F.to_json(F.struct(text.alias("d"))), strict=True)
    return table(spark, sf_dir, "orders").select("o_orderkey", S.fit(path(doc, "$.d"), "date").alias("onset"))


@query("cast_date_strict_raises", "SELECT o_orderkey, o_orderdate::DATE::VARCHAR AS onset FROM orders")
def cast_date_strict_raises(spark, sf_dir):
    """The raising cast (``strict=True``) over full dates, so it does not raise here; tests run it on misfits."""
    doc = parse(F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))), strict=True)
    return table(spark, sf_dir, "orders").select("o_orderkey", S.fit(path(doc, "$.d"), "date", strict=True).alias("onset"))


@query("cast_decimal", """SELECT event_id,
  cast(round(cast(value AS DECIMAL(12,2)), 1) AS DOUBLE) AS one_digit,
  cast(round(cast(value AS DECIMAL(12,2)), 0) AS INTEGER) AS whole,
  CASE WHEN round(cast(value AS DECIMAL(12,2)), 0) < 10
       THEN cast(round(cast(value AS DECIMAL(12,2)), 0) AS INTEGER) END AS one_place FROM events""")
def cast_decimal(spark, sf_dir):
    """Values round half up to the scale; one that does not fit the precision is NULL."""
    doc = parse(F.to_json(F.struct(F.col("value").cast("decimal(12,2)").alias("v"))))
    return table(spark, sf_dir, "events").select(
        "event_id", path(doc, "$.v", "decimal(12,1)").cast("double").alias("one_digit"),
        path(doc, "$.v", "decimal(12,0)").cast("int").alias("whole"),
        path(doc, "$.v", "decimal(1,0)").cast("int").alias("one_place"))


@query("timestamp_to_date", "SELECT event_id, ts::DATE::VARCHAR AS day FROM events")
def timestamp_to_date(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("day"))


@query("surrogate_keys", """SELECT event_id, cast(user_id AS VARCHAR) || '-react-' || event_id AS full_key,
  CASE WHEN event_type <> 'view' THEN cast(user_id AS VARCHAR) || '-' || event_type END AS null_key
  FROM events""")
def surrogate_keys(spark, sf_dir):
    user, kind = F.col("user_id").cast("string"), F.when(F.col("event_type") != "view", F.col("event_type"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        S.make_key(user, F.lit("-react-"), F.col("event_id").cast("string")).alias("full_key"),
        S.make_key(user, F.lit("-"), kind).alias("null_key"))


@query("least_ts", """SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_returnflag <> 'R' THEN least(l_shipdate, TIMESTAMP '1998-01-01') END AS earlier FROM lineitem""")
def least_ts(spark, sf_dir):
    other = F.when(F.col("l_returnflag") != "R", F.lit("1998-01-01").cast("timestamp_ntz"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", S.least_ts(F.col("l_shipdate"), other).alias("earlier"))


@query("round_display", "SELECT event_id, round(value, 1) AS shown FROM events")
def round_display(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", S.round_display(F.col("value")).alias("shown"))


@query("int_arithmetic", """SELECT l_orderkey, l_partkey, l_suppkey,
  l_orderkey - l_partkey - l_suppkey + l_linenumber AS cell, l_orderkey * l_partkey AS product FROM lineitem""")
def int_arithmetic(spark, sf_dir):
    k, p, s, n = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", (k - p - s + n).alias("cell"), (k * p).alias("product"))


@query("optional_predicates", """SELECT event_id FROM events
  WHERE upper(event_type) LIKE upper('%SIGN%') AND value >= 10""")
def optional_predicates(spark, sf_dir):
    """Text containment and a bound, next to two filters that are switched off."""
    return table(spark, sf_dir, "events").filter(P.all_of(
        P.contains_ci("event_type", "SIGN"), None, P.at_least("value", 10), P.in_band("event_type", "All")
    )).select("event_id")


@query("contains_ci", "SELECT c_custkey FROM customer WHERE upper(c_name) LIKE upper('%R#0_00%1%')")
def contains_ci(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter(P.contains_ci("c_name", "R#0_00%1")).select("c_custkey")


@query("equals_ci", "SELECT event_id FROM events WHERE upper(event_type) = upper('Click')")
def equals_ci(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(P.equals_ci("event_type", "Click")).select("event_id")


@query("bool_coerce", "SELECT doc_id, quality <> 0 AS good FROM labels")
def bool_coerce(spark, sf_dir):
    return table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("boolean").alias("good"))
