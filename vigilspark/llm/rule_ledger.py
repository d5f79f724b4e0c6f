"""Quality rules as a bitmask ledger, in DataFrame operations only.

Every measurement is taken once per document and every rule is evaluated once; the ledger
keeps the measurements and one bit per failed rule.  A policy is a named, versioned set of
rules, applied as a mask, so that policies can be compared and rules left out (ablation)
without another look at the texts: the ledger is first counted by bit pattern.

A null text counts as empty: no words, nothing measured, too short.  Repeated rows get the
same line each.  Ratios are compared by whole numbers, so nothing divides by zero.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import wordcols as wc

REPEAT = 8


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str      # SQL over the measurements


#: A rule's bit is its place here: append, never reorder.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("capitals", "2 * n_upper > word_chars"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 40 * n_words"),
)
BASE = ("few_words", "repeated_words")
POLICIES = {
    "v1": BASE,
    "v2": tuple(r.name for r in RULES),
}
CURRENT = "v2"


def mask(names) -> int:
    return sum(1 << i for i, r in enumerate(RULES) if r.name in set(names))


def _repeated(hashes: str) -> Column:
    """Places of ``hashes`` whose value occurs twice or more, ascending."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda a, i, j: F.coalesce(F.get(a, i)["h"] == F.get(a, j)["h"], F.lit(False))
    of = lambda s: F.transform(F.filter(s, lambda x, i: same(s, i, i - 1) | same(s, i, i + 1)), lambda x: x["i"])
    # sorted once: a one-element array binds it
    return F.array_sort(F.flatten(F.transform(F.array(pairs), of)))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = docs.select("doc_id", text.alias("_text"))
    df = df.select("doc_id", "_text", wc.spaced_words(F.col("_text")).alias("_words"))
    df = df.select(
        "doc_id", F.size("_words").cast("long").alias("n_words"), F.char_length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.filter(F.split("_text", "\n"), lambda x: F.trim(x, F.lit(wc.SPACES)) != "").alias("_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
    df = df.select("*", wc.gram_hashes("_h", REPEAT).alias("_g")).drop("_h")
    df = df.select("*", F.size("_lines").cast("long").alias("n_lines"), F.size(F.array_distinct("_lines")).cast("long").alias("_n_distinct"),
                   F.when(F.size(F.array_distinct("_g")) < F.size("_g"), _repeated("_g")).otherwise(F.array().cast("array<int>")).alias("_at"))
    covered = F.aggregate(
        F.transform("_at", lambda p, i: F.least(F.coalesce(F.get(F.col("_at"), i + 1) - p, F.lit(REPEAT)), F.lit(REPEAT))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    line = F.struct("n_words", "word_chars", "n_symbols", (F.col("n_lines") - F.col("_n_distinct")).alias("n_dup_lines"),
                    covered.alias("n_repeat_words"), "n_lines", "n_upper")
    # a generator: filters on the line must not be moved below, where they would measure again
    return df.select("doc_id", F.inline(F.array(line)))


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and ``failures``: bit i is set where rule i fails."""
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured(docs).withColumn("failures", bits)


def passes(policy: str = CURRENT) -> Column:
    return F.col("failures").bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def judged(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with base_failed and the policy's verdict ``kept``."""
    base = F.col("failures").bitwiseAND(F.lit(mask(BASE)).cast("long")) != 0
    return ledger(docs).withColumn("base_failed", base).withColumn("kept", ~base & passes(policy))


def ablation(lines: DataFrame) -> DataFrame:
    """policy, rule, n_failed, n_sole: documents failing a rule, and those that leaving it out would bring back.

    The ledger is counted by bit pattern before anything else, so what is shuffled does not grow with it.
    """
    patterns = lines.groupBy("failures").agg(F.count("*").alias("_n"))
    cases = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(r.name).alias("rule"), F.lit(mask(names)).cast("long").alias("_mask"),
                               F.lit(mask([r.name])).cast("long").alias("_bit"))
                      for p, names in POLICIES.items() for r in RULES if r.name in names])
    rows = patterns.select("failures", "_n", F.inline(cases))
    within = F.col("failures").bitwiseAND(F.col("_mask"))
    failed = within.bitwiseAND(F.col("_bit")) != 0
    return rows.groupBy("policy", "rule").agg(
        F.coalesce(F.sum(F.when(failed, F.col("_n"))), F.lit(0)).alias("n_failed"),
        F.coalesce(F.sum(F.when(within == F.col("_bit"), F.col("_n"))), F.lit(0)).alias("n_sole"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT g.doc_id, unnest(range(i, i + 8)) AS p
        FROM g JOIN (SELECT doc_id, s FROM g GROUP BY ALL HAVING count(*) > 1) USING (doc_id, s)) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup
      FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(text) - len(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
        CAST(len(text) - len(regexp_replace(text, '\p{Lu}', '', 'g')) AS BIGINT) AS n_upper
      FROM d LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT
          + 8 * (10 * n_dup_lines > 3 * n_lines)::INT + 16 * (2 * n_upper > word_chars)::INT + 32 * (word_chars < 2 * n_words)::INT
          + 64 * (word_chars > 40 * n_words)::INT AS BIGINT) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failures = 0 AS kept, n_lines, n_upper, failures FROM f
"""
