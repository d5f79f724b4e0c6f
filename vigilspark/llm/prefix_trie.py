"""Prefix trie of conversations, kept as a z-fast trie in tables.

A conversation is a sequence of turns; every prefix has a 128-bit key.  The trie is compacted: a
node owns an edge, the depths above its parent's extent up to its own.  Its row is hashed by the
key at the edge's two-fattest depth (its handle), so that a sequence of L turns finds the node it
leaves the trie at by a fat binary search of log2 L lookups, each a join of all sequences that
still search.  Distinct sequences are inserted in batches, each as large as all before:

* the first batch meets an empty trie, so all of it leaves at the root;
* a sequence that leaves an edge midway cuts it there, all cuts of an edge at once;
* depths beyond the place of leaving become nodes where the batch branches or a sequence ends,
  told by one aggregation over the new depths alone.

When all are in, each sequence's exit node is the one it ends at.  Members, leaves and bytes then
climb the compacted tree by pointer doubling, and the edges are expanded into a row a depth.

Nothing is broadcast by hint.  A hot first turn only meets joins that Spark may split and
aggregations that combine before the shuffle; copies are one sequence from the start.  Prefixes
are equal where both 64-bit lanes of their keys are.  The keys of one conversation (24 bytes a
turn, never its texts) make one row.  The ids that end at a node are packed into texts of at most
65,536 ids and streamed in order through one SHA-256, which is sequential by nature.

Turns without a conv_id belong to no conversation; a null turn comes first, equal turn numbers go
by role, then text; null roles and texts are empty.  Repeated rows are turns of their own.  A
conversation without turns ends at the root.  An empty table has no node, not even a root.  Other
columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shipping import map_arrow
from .tables import stored

#: Batches by an eighth of the hash: each as large as all before, or larger.
BATCHES = [(0, 2), (2, 4), (4, 8)]
GROUP, MOST_SHARED = 5, 9
ID_BITS = 16
KEY = ["high", "ea", "eb"]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, a, b, bytes): the turns in order, each text as two hash lanes and its bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = conversations.where("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    return rows.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), F.xxhash64("role", "text").alias("a"),
                       F.xxhash64(F.lit(1), "text", "role").alias("b"), F.octet_length("text").cast("long").alias("bytes"))


def shared(conv_id: Column) -> Column:
    """Turns that a conversation takes from the first of its group."""
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED


def rebuilt(turns: DataFrame) -> DataFrame:
    """Every conversation with its first turns replaced by those of the first conversation of its group of five.

    ``part`` and ``pos`` order the rows; each conversation also has a row of part -1, so that one without turns remains.
    """
    c = F.col("conv_id")
    ids = turns.where("pos = 1").select("conv_id")
    own = turns.where((c % GROUP == 0) | (F.col("pos") > shared(c))).withColumn("part", F.lit(1))
    lead = turns.where((c % GROUP == 0) & (F.col("pos") < MOST_SHARED)).withColumnRenamed("conv_id", "base")
    takers = ids.where(c % GROUP != 0).select("conv_id", (c - c % GROUP).alias("base"))
    taken = lead.join(takers, "base").where(F.col("pos") <= shared(c)).drop("base").withColumn("part", F.lit(0))
    zero = F.lit(0).cast("long")
    start = ids.select("conv_id", *[zero.alias(x) for x in ("pos", "a", "b", "bytes")], F.lit(-1).alias("part"))
    return own.unionByName(taken).unionByName(start)


def paths(rows: DataFrame) -> DataFrame:
    """(conv_id, path): the key (a, b) of each prefix from the empty one on, with the bytes of its texts (c).

    A key is the exclusive-or of hashes of (depth, turn), so it runs along a window and no task holds a text.
    """
    order = Window.partitionBy("conv_id").orderBy("part", "pos")
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("conv_id", "part", "pos", "a", "b", "bytes", (F.row_number().over(order) - 1).cast("long").alias("depth"))
    lane = lambda salt: F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(salt), "depth", "a", "b"))
    keyed = rows.select("conv_id", "depth", F.bit_xor(lane(1)).over(run).alias("a"), F.bit_xor(lane(2)).over(run).alias("b"),
                        F.sum("bytes").over(run).alias("c"))
    path = F.transform(F.sort_array(F.collect_list(F.struct("depth", "a", "b", "c"))), lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["c"].alias("c")))
    return keyed.groupBy("conv_id").agg(path.alias("path"))


def _end(name: str = "path") -> Column:
    return F.element_at(F.col(name), -1)


def _size(name: str = "path") -> Column:
    """Turns of a path, or depths of an edge above its first entry."""
    return (F.size(name) - 1).cast("long")


def sequences(paths: DataFrame) -> DataFrame:
    """(high, ea, eb, path, n, first): one row a distinct sequence, its members counted, the smallest conv_id named."""
    rows = paths.select(_size().alias("high"), _end()["a"].alias("ea"), _end()["b"].alias("eb"), "conv_id", "path")
    return rows.groupBy(*KEY).agg(F.any_value("path").alias("path"), F.count("*").alias("n"), F.min("conv_id").alias("first"))


def fattest(low: str, high: str) -> Column:
    """The number in (low, high] with the most trailing zero bits."""
    bits = f"length(bin({low} ^ {high})) - 1"
    return F.expr(f"shiftleft(shiftright({high}, {bits}), {bits})")


def _at(depth: Column, path: str = "path") -> Column:
    return F.get(F.col(path), depth.cast("int"))


def _slice(path: Column, low: Column, high: Column) -> Column:
    """Entries of a path from depth ``low`` to ``high``, both included."""
    return F.slice(path, low.cast("int") + 1, (high - low).cast("int") + 1)


def handles(trie: DataFrame) -> DataFrame:
    """The hash table of the trie: depth and key of each node's handle, and the node's extent."""
    at = F.get(F.col("edge"), (fattest("low", "high") - F.col("low")).cast("int"))
    return trie.select(fattest("low", "high").alias("_f"), at["a"].alias("_a"), at["b"].alias("_b"), F.col("low").alias("_low"),
                       F.col("high").alias("_high"), F.col("ea").alias("_ea"), F.col("eb").alias("_eb"))


def locate(seqs: DataFrame, trie: DataFrame, longest: int) -> DataFrame:
    """``seqs`` with where they leave the trie: ``reached`` (depth of the last extent that is a prefix), ``node`` (key and edge of the
    child then entered, null if none) and ``left`` (depth up to which its edge, too, is shared).

    All sequences search at once; one that has ended goes on asking for its own end, which spreads it evenly.
    """
    table, length = handles(trie), _size()
    rows = seqs.withColumn("_lo", F.lit(0).cast("long")).withColumn("_hi", length)
    names = rows.columns
    for _ in range(longest.bit_length()):
        searching = F.col("_lo") < F.col("_hi")
        probe = rows.withColumn("_p", F.when(searching, fattest("_lo", "_hi")).otherwise(length))
        probe = probe.withColumn("_k", _at(F.col("_p")))
        met = probe.join(table, (F.col("_p") == F.col("_f")) & (F.col("_k.a") == F.col("_a")) & (F.col("_k.b") == F.col("_b")), "left")
        hit = searching & F.col("_f").isNotNull()
        extent = _at(F.col("_high"))
        whole = hit & F.coalesce((extent["a"] == F.col("_ea")) & (extent["b"] == F.col("_eb")), F.lit(False))
        low = F.when(whole, F.col("_high")).when(hit, F.col("_low")).otherwise(F.col("_lo"))
        high = F.when(hit & ~whole, F.col("_low")).when(searching & ~hit, F.col("_p") - 1).otherwise(F.col("_hi"))
        rows = met.select(*names[:-2], low.alias("_lo"), high.alias("_hi"))
    below = F.col("_lo") < length
    rows = rows.withColumn("_k", _at(F.when(below, F.col("_lo") + 1).otherwise(length)))
    first = F.get(F.col("edge"), F.lit(1))
    children = trie.select(F.col("low").alias("_from"), first["a"].alias("_a"), first["b"].alias("_b"), F.struct(*KEY, "low", "edge").alias("node"))
    rows = rows.join(children, (F.when(below, F.col("_lo")).otherwise(-1) == F.col("_from")) & (F.col("_k.a") == F.col("_a"))
                     & (F.col("_k.b") == F.col("_b")), "left")
    same = F.size(F.filter("node.edge", lambda x, i: F.get(F.col("path"), (F.col("_lo") + i).cast("int")).eqNullSafe(x)))
    left = F.col("_lo") + F.when(F.col("node").isNotNull(), same - 1).otherwise(0)
    return rows.select(*names[:-2], F.col("_lo").alias("reached"), "node", left.cast("long").alias("left"))


def _pieces(trie: DataFrame, cuts: DataFrame) -> DataFrame:
    """Each cut edge as the edges between its cuts."""
    rows = trie.join(cuts, KEY).withColumn("at", F.array_sort(F.concat(F.array("low"), "cuts", F.array("high"))))
    rows = rows.select("low", "edge", F.explode(F.arrays_zip(F.slice("at", 1, F.size("at") - 1).alias("x"), F.slice("at", 2, F.size("at") - 1).alias("y"))).alias("piece"))
    edge = _slice(F.col("edge"), F.col("piece.x") - F.col("low"), F.col("piece.y") - F.col("low"))
    return _nodes(rows.select(F.col("piece.x").alias("low"), F.col("piece.y").alias("high"), edge.alias("edge")))


def _nodes(rows: DataFrame) -> DataFrame:
    return rows.select("low", "high", _end("edge")["a"].alias("ea"), _end("edge")["b"].alias("eb"), "edge")


def _branches(batch: DataFrame) -> DataFrame:
    """Nodes for the depths beyond where the sequences left the trie: those where they part or end."""
    new = batch.where(F.col("left") < _size()).select("first", "left", "path")
    depth = F.explode(F.sequence(F.col("left") + 1, _size()))
    points = new.select("first", "left", "path", depth.alias("depth"))
    here, after = _at(F.col("depth")), _at(F.col("depth") + 1)
    points = points.select("first", "left", "depth", here["a"].alias("a"), here["b"].alias("b"), F.struct(after["a"], after["b"]).alias("next"),
                           after.isNull().alias("ends"))
    marked = (points.groupBy("depth", "a", "b").agg(F.min("next").alias("x"), F.max("next").alias("y"), F.bool_or("ends").alias("ends"))
              .where((F.col("x") != F.col("y")) | F.col("ends")).select("depth", "a", "b"))
    along = Window.partitionBy("first").orderBy("depth")
    tops = points.join(marked, ["depth", "a", "b"], "left_semi").withColumn("low", F.coalesce(F.lag("depth").over(along), "left"))
    owned = tops.groupBy("depth", "a", "b").agg(F.min("first").alias("first"), F.any_value("low").alias("low"))
    rows = owned.join(new.select("first", "path"), "first")
    return _nodes(rows.select("low", F.col("depth").alias("high"), _slice(F.col("path"), F.col("low"), F.col("depth")).alias("edge")))


def insert(trie: DataFrame | None, seqs: DataFrame, longest: int) -> DataFrame:
    """The trie with a batch of distinct sequences in it; None is the trie without any."""
    if trie is None:
        return stored(_branches(seqs.withColumn("left", F.lit(0).cast("long"))), "trie")
    batch = stored(locate(seqs, trie, longest), "trie-batch")
    cuts = (batch.where("node IS NOT NULL AND left < node.high").select(*[F.col(f"node.{k}").alias(k) for k in KEY], "left")
            .groupBy(*KEY).agg(F.collect_set("left").alias("cuts")))
    whole = trie.join(cuts.select(*KEY), KEY, "left_anti").select(*trie.columns)
    return stored(whole.unionByName(_pieces(trie, cuts)).unionByName(_branches(batch)), "trie")


def build(seqs: DataFrame) -> tuple[DataFrame, int]:
    """The trie of all sequences (without its root, which has no edge) and the depth of the longest."""
    longest = seqs.agg(F.max("high")).first()[0] or 0
    trie = None
    part = F.pmod(F.xxhash64("ea", "eb"), F.lit(8))
    for low, high in BATCHES:
        trie = insert(trie, seqs.where((part >= low) & (part < high) & (F.col("high") > 0)), longest)
    return trie, longest


def _climbed(nodes: DataFrame, sums: list[str], least: str) -> DataFrame:
    """``sums`` added, and ``least`` minimised, over every node's subtree: each round doubles the distance covered."""
    up = ["ph", "pa", "pb"]
    nodes = stored(nodes, "trie-sums")
    while nodes.where("ph IS NOT NULL").limit(1).count():
        came = (nodes.where("ph IS NOT NULL").groupBy(*up).agg(*[F.sum(s).alias(f"_{s}") for s in sums], F.min(least).alias(f"_{least}"))
                .toDF(*KEY, *[f"_{s}" for s in sums], f"_{least}"))
        over = nodes.where("ph IS NOT NULL").select(*[F.col(k).alias(u) for k, u in zip(KEY, up)], *[F.col(u).alias(f"_{u}") for u in up])
        rows = nodes.join(came, KEY, "left").join(over, up, "left")
        nodes = stored(rows.select(*KEY, *[F.col(f"_{u}").alias(u) for u in up], *[(F.col(s) + F.coalesce(f"_{s}", F.lit(0))).alias(s) for s in sums],
                                   F.least(least, f"_{least}").alias(least)), "trie-sums")
    return nodes.drop(*up)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash a node: its texts of ids come in order, maybe over several batches."""
    now, state = None, None

    def done():
        return pa.RecordBatch.from_pylist([dict(zip((*KEY, "ends_sha256"), (*now, state.hexdigest()), strict=True))], schema=schema)

    schema = pa.schema([(k, pa.int64()) for k in KEY] + [("ends_sha256", pa.string())])
    for batch in batches:
        out = []
        for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids")), strict=True):
            if key != now:
                if now is not None:
                    out.append(done())
                now, state = key, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if now is not None:
        yield done()


def ends(paths: DataFrame) -> DataFrame:
    """(high, ea, eb, ends_sha256): hash of the ascending ids of the conversations that end there."""
    rows = paths.select(_size().alias("high"), _end()["a"].alias("ea"), _end()["b"].alias("eb"), "conv_id", F.shiftright("conv_id", ID_BITS).alias("part"))
    packed = rows.groupBy(*KEY, "part").agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv_id")), lambda i: i.cast("string"))).alias("ids"))
    packed = packed.repartition(*KEY).sortWithinPartitions(*KEY, "part").select(*KEY, "ids")
    return map_arrow(packed, _hashed, "high long, ea long, eb long, ends_sha256 string")


def nodes(rows: DataFrame) -> DataFrame:
    """Every depth's nodes of the conversations in ``rows`` (conv_id, part, pos, a, b, bytes)."""
    found = stored(paths(rows), "trie-paths")
    seqs = stored(sequences(found), "trie-sequences")
    trie, longest = build(seqs)
    ended = locate(seqs, trie, longest).select(F.col("reached").alias("high"), _at(F.col("reached"))["a"].alias("ea"),
                                               _at(F.col("reached"))["b"].alias("eb"), "n", "first", _end()["c"].alias("bytes"))
    zero = F.lit(0).cast("long")
    root = seqs.select(*[zero.alias(k) for k in ("low", *KEY)]).limit(1)
    root = root.withColumn("edge", F.array(F.struct(zero.alias("a"), zero.alias("b"), zero.alias("c"))))
    full = stored(trie.unionByName(root), "trie-nodes")
    up = F.get(F.col("edge"), F.lit(0))
    children = trie.groupBy(F.col("low").alias("high"), up["a"].alias("ea"), up["b"].alias("eb")).agg(F.count("*").alias("children"))
    base = full.join(children, KEY, "left").join(ended, KEY, "left")
    none = F.lit(None).cast("long")
    parent = [F.when(F.col("high") > 0, x).otherwise(none).alias(n) for x, n in ((F.col("low"), "ph"), (up["a"], "pa"), (up["b"], "pb"))]
    n = F.coalesce("n", zero)
    own = base.select(*KEY, *parent, n.alias("n"), "first", F.when(F.col("children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
                      (n * F.coalesce("bytes", zero)).alias("told"), (_end("edge")["c"] - up["c"]).alias("kept"))
    sums = _climbed(own, ["n", "leaves", "told", "kept"], "first")
    tops = full.join(sums, KEY).join(children, KEY, "left").join(ends(found), KEY, "left")
    above = sums.select(*[F.col(k).alias(f"_{k}") for k in KEY], F.col("first").alias("above"))
    tops = tops.join(above, (F.col("low") == F.col("_high")) & (up["a"] == F.col("_ea")) & (up["b"] == F.col("_eb")) & (F.col("high") > 0), "left")
    return _expanded(tops)


def _expanded(tops: DataFrame) -> DataFrame:
    """A row for each depth of each edge.  What is saved below a depth leaves out the edge's bytes above it."""
    depth, top = F.col("depth"), F.greatest(F.col("low") + 1, F.lit(1))
    rows = tops.withColumn("depth", F.explode(F.when(F.col("high") == 0, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(top, F.col("high")))))
    saved = F.col("told") - F.col("n") * F.get("edge", F.lit(0))["c"] - F.col("kept")
    before = F.when(depth > 0, F.get("edge", (depth - 1 - F.col("low")).cast("int"))["c"] - F.get("edge", F.lit(0))["c"]).otherwise(0)
    last = depth == F.col("high")
    return rows.select(
        F.col("first").alias("conv_id"), "depth", F.when(depth == F.col("low") + 1, F.col("above")).when(depth > 0, F.col("first")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.when(last, F.coalesce("children", F.lit(0))).otherwise(1).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (saved - (F.col("n") - 1) * before).alias("saved_tokens"),
        F.coalesce(F.when(last, F.col("ends_sha256")), F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def report(conversations: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations."""
    return nodes(rebuilt(stored(turns(conversations), "trie-turns")))


SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         xor(list_reduce(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
           lambda crc, ch: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda r, i: xor(r >> 1, 3988292384 * (r & 1)), xor(crc, ch)),
           4294967295::BIGINT), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT i.conv_id, 0 AS part, pos, role, text FROM ids i JOIN t ON t.conv_id = i.base AND pos <= h
  UNION ALL SELECT conv_id, 1, pos, role, text FROM ids i JOIN t USING (conv_id) WHERE pos > h),
s AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, pos) AS depth, strlen(text) AS bytes,
         sha256(strlen(role)::VARCHAR || ':' || role || text) AS turn FROM r),
p AS (
  SELECT conv_id, depth, bytes, list(turn) OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM s
  UNION ALL SELECT conv_id, 0, 0, [] FROM ids),
e AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
n AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = last_depth) AS ended
  FROM (SELECT p.*, e.depth AS last_depth FROM p JOIN e USING (conv_id)) GROUP BY path, depth),
c AS (SELECT path[:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
u AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN c USING (path)),
sub AS (
  SELECT path[:d] AS path, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM u) GROUP BY 1)
SELECT u.conv_id, u.depth, q.conv_id AS parent_conv_id, u.n_convs, u.n_children, n_leaves::BIGINT AS n_leaves,
       saved::BIGINT AS saved_tokens, sha256(coalesce(u.ended, '')) AS ends_sha256
FROM u JOIN sub USING (path) LEFT JOIN u q ON u.depth > 0 AND q.path = u.path[:u.depth - 1]
"""
