"""Benchmark decontamination by winnowing, in DataFrame operations only.

A benchmark window is ``window`` consecutive words of an item (a shorter item is one window).
For windows of n words, texts and items keep the smallest hash of ``n - k + 1`` neighbouring
k-grams, so that two texts sharing n words share a kept hash at the same place.  A kept hash of
a text that some item has kept, too, is a hit; it is extended over the windows of n words that
it stands for, and those meet the items' windows as a whole: by hash, then word by word.  A
phrase that many texts and items share thus proposes nothing unless the window around it is
shared as well, and no row holds more than one text's words, or one window's.

Null texts have no words; items without words are ignored; a null item_id is the item
'null'.  Repeated rows get the same result each, repeated items count once.  With an empty
benchmark nothing is hit.  Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import wordcols as wc
from .tables import free_names, stored

WINDOW = 13
MIN_SHARE = 20          # contaminated: at least 1 word in 20 hit
BROADCAST_ROWS = 500_000           # of hashes and keys
BROADCAST_BYTES = 64 << 20         # of items with their words
_WORD_BYTES = 24                   # a word's place in a row, besides its text


def gram_size(n: int) -> int:
    return 5 if n >= 10 else (n + 1) // 2


def kept_hashes(n: int) -> Column:
    """[(n, place, hash)]: the smallest k-gram hash of every n words of the column ``_h``, each place once."""
    k = gram_size(n)
    grams = f"_g{k}"
    window = lambda i: F.slice(F.col(grams), i + 1, n - k + 1)
    places = F.transform(wc.upto(F.size("_h") - n + 1),
                         lambda i: (i + F.array_position(window(i), F.array_min(window(i))) - 1).cast("int"))
    return F.transform(F.array_distinct(places), lambda p: F.struct(
        F.lit(n).alias("n"), p.alias("place"), F.get(F.col(grams), p).alias("hash")))


def fingerprints(texts: DataFrame, sizes: list[int], *keep: str) -> DataFrame:
    """keep, n, place, hash of every kept hash of the column ``_words``."""
    texts = texts.withColumn("_h", F.transform("_words", lambda w: F.xxhash64(w))).drop("_words")
    for k in sorted({gram_size(n) for n in sizes}):
        texts = texts.withColumn(f"_g{k}", wc.gram_hashes("_h", k))
    return texts.select(*keep, F.inline(F.flatten(F.array(*map(kept_hashes, sizes)))))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").withColumn("_key", F.xxhash64("doc_id", "text"))


def maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, n, words, hash: every window of every item (columns item, _words), repeated ones once."""
    n = F.least(F.size("_words"), F.lit(window))
    starts = items.select("item", "_words", n.alias("n"), F.explode(wc.upto(F.size("_words") - n + 1)).alias("_i"))
    rows = starts.select("item", "n", F.slice("_words", F.col("_i") + 1, F.col("n")).alias("words"))
    return rows.distinct().withColumn("hash", F.xxhash64("words"))


def _reached(n: Column, places: Column, size: Column) -> Column:
    """Starts of the windows of n words that hold a kept k-gram at one of the places."""
    reach = n - F.when(n >= 10, 5).otherwise(F.floor((n + 1) / 2).cast("int"))        # n - gram_size(n)
    around = F.transform(places, lambda p: F.sequence(F.greatest(p - reach, F.lit(0)), p))
    return F.filter(F.array_distinct(F.flatten(around)), lambda i: i + n <= size)


def shared_windows(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(_key, doc_id, start, end, window) of the items' windows in the documents, and (window, item)."""
    items = stored(benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
                                    wc.alnum_words(F.col("text")).alias("_words"))
                   .where(F.size("_words") > 0).distinct(), "items")
    length = F.least(F.size("_words"), F.lit(window))
    sizes = sorted(r[0] for r in items.select(length).distinct().collect()) or [window]   # ``window`` values at most
    sides = stored(fingerprints(items.withColumn("_n", length), sizes, "_n").where("n = _n").select("n", "hash").distinct(), "item-hashes")
    docs = keyed(docs)
    kept = fingerprints(docs.select("doc_id", "_key", wc.alnum_words(F.col("text")).alias("_words")), sizes, "doc_id", "_key")
    hits = stored(kept.join(maybe_broadcast(sides, sides.count()), ["n", "hash"], "left_semi")
                  .groupBy("_key", "doc_id", "n").agg(F.collect_set("place").alias("places")), "hits")     # places of one text
    # the words of hit documents only, each text once for every window size
    touched = hits.select("_key").distinct()
    of_docs = docs.join(maybe_broadcast(touched, touched.count()), "_key", "left_semi").dropDuplicates(["_key", "doc_id"]).select(
        F.col("_key").alias("_k"), F.col("doc_id").alias("_d"), "text")
    laid = hits.join(of_docs, (F.col("_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d"))).withColumn(
        "_text", wc.alnum_words(F.col("text")))
    found = laid.select("_key", "doc_id", "n", "_text", F.explode(_reached(F.col("n"), F.col("places"), F.size("_text"))).alias("start"))
    found = found.select("_key", "doc_id", "n", "start", F.slice("_text", F.col("start") + 1, F.col("n")).alias("words"))
    windows = stored(item_windows(items, window), "windows")
    theirs = windows.select("n", "words", "hash").distinct()
    rows, size = theirs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length(F.array_join("words", "")) + F.col("n").cast("long") * _WORD_BYTES),
                                                     F.lit(0))).first()
    if size <= BROADCAST_BYTES:      # else Spark sizes the join
        theirs = maybe_broadcast(theirs, rows)
    met = stored(found.withColumn("hash", F.xxhash64("words")).join(theirs, ["n", "hash", "words"]).select(
        "_key", "doc_id", "start", (F.col("start") + F.col("n")).alias("end"), "n", "hash", "words"), "hit-windows")
    return met, windows


def hit_words(found: DataFrame) -> DataFrame:
    """_key, doc_id, n_hit: words covered by any window."""
    ends = found.groupBy("_key", "doc_id", "start").agg(F.max("end").alias("end"))
    before = Window.partitionBy("_key", "doc_id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    new = F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0)))
    return (ends.withColumn("_new", F.greatest(new, F.lit(0))).groupBy("_key", "doc_id").agg(F.sum("_new").alias("n_hit")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document, and _key."""
    found, windows = shared_windows(docs, benchmark, window)
    of_items = found.select("_key", "doc_id", "n", "hash", "words").distinct().join(windows, ["n", "hash", "words"])
    items = of_items.groupBy("_key", "doc_id").agg(F.collect_set("item").alias("_items"))   # at most the benchmark's items
    hit = hit_words(found).alias("h").join(items.alias("i"), (F.col("h._key") == F.col("i._key")) & F.col("h.doc_id").eqNullSafe(F.col("i.doc_id"))) \
        .select(F.col("h._key").alias("_k"), F.col("h.doc_id").alias("_d"), "n_hit", "_items")
    all_docs = keyed(docs).select("doc_id", "_key", wc.count_alnum_words(F.col("text")).alias("n_words"))
    joined = all_docs.join(hit, (F.col("_key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    ids = F.coalesce("_items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(ids), ",").cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * MIN_SHARE >= F.col("n_words"))).alias("contaminated"), "_key")


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are, whatever their other columns are called."""
    key, k, d = free_names(docs, "key", "k", "d")
    bad = stored(contamination(docs, benchmark, window).where("contaminated").select(F.col("_key").alias(k), F.col("doc_id").alias(d))
                 .distinct(), "contaminated")
    rows = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    return rows.join(maybe_broadcast(bad, bad.count()), (F.col(key) == F.col(k)) & F.col("doc_id").eqNullSafe(F.col(d)),
                     "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dw.n AS n, item_id FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS l
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
