"""SimHash near-duplicates: a self-join of binary tries over 64-bit fingerprints.

Pairs of trie nodes are walked down together, one bit a step; differing bits add up and a
pair is dropped as soon as they exceed what its depth allows.  So that the walk starts in
many independent subtrees, the 64 bits are cut into ``bits + 1`` blocks and the tries are
built over every rotation of the blocks: of at most ``bits`` differences around a ring of
``bits + 1`` blocks, some rotation has at most k - 1 in its first k blocks for every k.  A
rotation's walk therefore starts at pairs with an equal first block and allows k - 1
differences within k blocks; no link is lost and most pairs are never looked at.

Equal fingerprints are one leaf.  Subtrees with more than ``max_leaves`` leaves are cut into
pairs of smaller subtrees, block by block, before any task walks them.  A task returns links
to a smallest leaf, not all pairs; components come from ``components``.

Null texts count as empty; a text without words has fingerprint zero and is linked like any
other.  A null doc_id takes part but is no component's smallest id unless alone.  Repeated
rows give repeated results.  Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .components import components
from .shipping import map_arrow
from .tables import free_names, stored

SHINGLE = 4
BITS = 4
SEED = 42
MAX_LEAVES = 4096
CHUNK = 1 << 16
SLICE = 1 << 17


# ---- fingerprints

def block_fingerprints(block: tb.Block, size: int) -> np.ndarray:
    w = tb.words(block, tb.NOT_SPACE)
    length = w.end - w.start
    to = np.cumsum(length + 1) - length - 1      # where a word goes when words are joined by one space
    joined = np.full(int((length + 1).sum()), 32, np.uint8)
    joined[np.arange(length.sum()) + np.repeat(to - (np.cumsum(length) - length), length)] = \
        block.buf[np.arange(length.sum()) + np.repeat(w.start - (np.cumsum(length) - length), length)]
    joined = joined.tobytes().lower()            # of bytes: A-Z only
    n_words = np.diff(w.first)
    n_shingles = np.where(n_words == 0, 0, np.maximum(n_words - size + 1, 1))
    first = np.cumsum(n_shingles) - n_shingles
    at = np.arange(n_shingles.sum()) + np.repeat(w.first[:-1] - first, n_shingles)
    last = at + np.repeat(np.minimum(size, n_words), n_shingles) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(to[at].tolist(), (to + length)[last].tolist(), strict=True)),
                         np.uint64, len(at))
    out = np.zeros(block.n, np.uint64)
    some = np.flatnonzero(n_shingles)
    if len(some):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, first[some], axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * ones > n_shingles[some, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, _key, fp): a hash of the text, and the fingerprint as a signed long with the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch):
                fp = block_fingerprints(block, size).view(np.int64)
                yield pa.RecordBatch.from_arrays([*block.rows.columns[:2], pa.array(fp)], ["doc_id", "_key", "fp"])

    docs = docs.select("doc_id", F.xxhash64("text").alias("_key"), "text")
    return map_arrow(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, _key long, fp long")


# ---- links

def block_sizes(bits: int) -> list[int]:
    return [64 // (bits + 1) + (i < 64 % (bits + 1)) for i in range(bits + 1)]


def allowed(bits: int) -> np.ndarray:
    """By rotation and depth: differences allowed down to that bit."""
    sizes = block_sizes(bits)
    return np.array([np.repeat(np.arange(bits + 1), sizes[r:] + sizes[:r]) for r in range(bits + 1)], np.int8)


def rotated(fps: DataFrame, bits: int) -> DataFrame:
    """(fp, r, key, side, a, b): a leaf in each rotation's trie; subtrees a and b are walked together."""
    sizes = block_sizes(bits)
    turns = [sum(sizes[:r]) for r in range(bits + 1)]
    key = lambda t: F.shiftleft("fp", t).bitwiseOR(F.shiftrightunsigned("fp", 64 - t)) if t else F.col("fp")
    leaves = fps.select("fp", F.posexplode(F.array(*map(key, turns))).alias("r", "key"))
    head = F.element_at(F.array(*[F.shiftrightunsigned("key", 64 - s) for s in sizes]), F.col("r") + 1)
    return leaves.select("fp", "r", "key", F.lit(0).alias("side"), F.lit(1).alias("depth"), head.alias("a"), head.alias("b"))


def split_large(leaves: DataFrame, bits: int, max_leaves: int) -> DataFrame:
    """Replace subtree pairs of too many leaves by the pairs of their subtrees one block deeper.

    Every leaf is sent to the pairs its own subtree takes part in: those whose next block
    differs from its own in as many bits as are still allowed.
    """
    sizes = block_sizes(bits)
    group = ["r", "depth", "a", "b"]
    for depth in range(1, bits + 1):
        large = leaves.where(F.col("depth") == depth).groupBy(group).count().where(F.col("count") > max_leaves).drop("count")
        large = stored(large, "large-subtrees")
        if large.isEmpty():
            break
        width = F.element_at(F.array(*[F.lit(s) for s in sizes]), (F.col("r") + depth) % (bits + 1) + 1)
        used = F.lit(0)
        for k in range(depth):
            used = used + F.element_at(F.array(*[F.lit(s) for s in sizes]), (F.col("r") + k) % (bits + 1) + 1)
        masks = {s: [sum(1 << i for i in c) for e in range(depth + 1) for c in combinations(range(s), e)] for s in set(sizes)}
        flips = F.when(width == max(sizes), F.array(*[F.lit(m).cast("long") for m in masks[max(sizes)]])) \
            .otherwise(F.array(*[F.lit(m).cast("long") for m in masks[min(sizes)]]))
        hot = leaves.join(large, group, "left_semi")
        own = F.expr("shiftrightunsigned(key, 64 - _used - _width) & (shiftleft(1L, _width) - 1)")
        deeper = (
            hot.withColumn("_width", width).withColumn("_used", used).withColumn("_own", own)
            .withColumn("_flip", F.explode(flips))
            .where((F.bit_count("_flip") + F.bit_count(F.col("a").bitwiseXOR(F.col("b")))) <= depth)
            .withColumn("_mine", F.expr("shiftleft(if(side = 0, a, b), _width) | _own"))
            .withColumn("_other", F.expr("shiftleft(if(side = 0, b, a), _width) | (_own ^ _flip)"))
            .select("fp", "r", "key",
                    F.expr("CASE WHEN a = b THEN int(_mine > _other) ELSE side END").alias("side"), F.lit(depth + 1).alias("depth"),
                    F.expr("CASE WHEN a = b THEN least(_mine, _other) WHEN side = 0 THEN _mine ELSE _other END").alias("a"),
                    F.expr("CASE WHEN a = b THEN greatest(_mine, _other) WHEN side = 0 THEN _other ELSE _mine END").alias("b")))
        leaves = stored(leaves.join(large, group, "left_anti").unionByName(deeper), "leaves")
    return leaves


def unite(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels (index of the smallest member) after linking u[i] with v[i]."""
    while True:
        a, b = labels[u], labels[v]
        differ = a != b
        if not differ.any():
            return labels
        np.minimum.at(labels, np.maximum(a, b)[differ], np.minimum(a, b)[differ])
        while not np.array_equal(up := labels[labels], labels):
            labels = up


def walk(key: np.ndarray, rotation: np.ndarray, roots: tuple[np.ndarray, ...], bits: int) -> np.ndarray:
    """Labels of linked leaves.  ``key``: sorted within each subtree; ``roots``: (alo, ahi, blo, bhi) ranges."""
    budget, n = allowed(bits), len(key)
    labels = np.arange(n)
    ones: dict[int, np.ndarray] = {}

    def split(level, lo, hi):
        if level not in ones:
            ones[level] = np.zeros(n + 1, np.int32)
            np.cumsum((key >> np.uint64(63 - level)) & np.uint64(1), out=ones[level][1:])
        return hi - (ones[level][hi] - ones[level][lo])

    stack = [(0, *roots, np.zeros(len(roots[0]), np.int8))]
    while stack:
        level, alo, ahi, blo, bhi, dist = stack.pop()
        if len(alo) > SLICE:
            half = len(alo) // 2
            stack += [(level, *(x[:half] for x in (alo, ahi, blo, bhi, dist))), (level, *(x[half:] for x in (alo, ahi, blo, bhi, dist)))]
            continue
        leaf = (ahi - alo == 1) & (bhi - blo == 1)
        if leaf.any():
            u, v = alo[leaf], blo[leaf]
            near = np.bitwise_count(key[u] ^ key[v]) <= bits
            labels = unite(labels, u[near], v[near])
        run = np.cumsum(np.concatenate([[0], labels[1:] != labels[:-1]]))
        known = (labels[alo] == labels[blo]) & (run[alo] == run[ahi - 1]) & (run[blo] == run[bhi - 1])
        go = ~leaf & ~known
        alo, ahi, blo, bhi, dist = (x[go] for x in (alo, ahi, blo, bhi, dist))
        if not len(alo) or level == 64:
            continue
        am, bm, own = split(level, alo, ahi), split(level, blo, bhi), (alo == blo) & (ahi == bhi)
        parts = []
        for left, right, more, which in (((alo, am), (blo, bm), 0, None), ((am, ahi), (bm, bhi), 0, None),
                                         ((alo, am), (bm, bhi), 1, None), ((am, ahi), (blo, bm), 1, ~own)):
            far = dist + np.int8(more)
            keep = (left[0] < left[1]) & (right[0] < right[1]) & (far <= budget[rotation[alo], level])
            keep &= ~((left[0] == right[0]) & (left[1] == right[1]) & (left[1] - left[0] == 1))
            if which is not None:
                keep &= which
            parts.append([x[keep] for x in (*left, *right, far)])
        stack.append((level + 1, *(np.concatenate(x) for x in zip(*parts, strict=True))))
    return labels


def _walk_groups(bits: int):
    columns = ["r", "depth", "a", "b"]

    def links(chunk: dict[str, np.ndarray]) -> pa.RecordBatch:
        order = np.lexsort((chunk["key"].view(np.uint64), chunk["side"], *(chunk[c] for c in columns)))
        chunk = {k: v[order] for k, v in chunk.items()}
        key, n = chunk["key"].view(np.uint64), len(order)
        new = np.ones(n, bool)
        new[1:] = np.any([chunk[c][1:] != chunk[c][:-1] for c in columns], axis=0)
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], n)
        sides = np.zeros(n + 1, np.int64)
        np.cumsum(chunk["side"], out=sides[1:])
        middle = hi - (sides[hi] - sides[lo])
        alone = chunk["a"][lo] == chunk["b"][lo]
        roots = (lo, np.where(alone, hi, middle), np.where(alone, lo, middle), hi)
        real = (roots[0] < roots[1]) & (roots[2] < roots[3]) & (hi - lo > 1)
        labels = walk(key, chunk["r"], tuple(x[real] for x in roots), bits)
        linked = np.flatnonzero(labels != np.arange(n))
        return pa.RecordBatch.from_arrays([pa.array(chunk["fp"][linked]), pa.array(chunk["fp"][labels[linked]])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            new = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("fp", "r", "key", "side", "depth", "a", "b")}
            held = new if held is None else {c: np.concatenate([held[c], new[c]]) for c in new}
            n = len(held["fp"])
            if n >= CHUNK:   # the last group may go on in the next batch
                same = np.all([held[c] == held[c][-1] for c in columns], axis=0)
                cut = n - int(np.argmin(same[::-1])) if not same.all() else 0
                if cut:
                    yield links({c: v[:cut] for c, v in held.items()})
                    held = {c: v[cut:] for c, v in held.items()}
        if held is not None and len(held["fp"]):
            yield links(held)

    return run


def near_links(fps: DataFrame, bits: int = BITS, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp): their closure joins exactly those within ``bits`` of each other."""
    leaves = split_large(stored(rotated(fps, bits), "leaves"), bits, max_leaves)
    grouped = leaves.repartition("r", "depth", "a", "b").sortWithinPartitions("r", "depth", "a", "b")
    return map_arrow(grouped, _walk_groups(bits), "u long, v long")


def rooted(marked: DataFrame, bits: int, max_leaves: int) -> DataFrame:
    """(fp, root) of every distinct fingerprint: equal roots are one component."""
    fps = stored(marked.select("fp").distinct(), "distinct")
    roots = stored(components(near_links(fps, bits, max_leaves)), "roots")
    return fps.join(roots, fps.fp == roots.u, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, bits: int = BITS, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    marked = stored(fingerprints(docs, size), "fingerprints")
    # smallest ids: of a fingerprint first, so that copies meet before any join
    leaf = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    leaf = stored(leaf.join(rooted(marked, bits, max_leaves), "fp"), "classes")
    smallest = leaf.groupBy("root").agg(F.min("least").alias("component_id"))
    named = leaf.join(smallest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, size: int = SHINGLE, bits: int = BITS, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """One row of each component, all columns: the smallest doc_id (null last), then the smallest text hash."""
    marked = stored(fingerprints(docs, size), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "_key")).alias("first")
    leaf = marked.groupBy("fp").agg(first).join(rooted(marked, bits, max_leaves), "fp")
    key, k, d = free_names(docs, "key", "k", "d")
    kept = leaf.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias(d), F.col("first._key").alias(k))
    rows = docs.withColumn(key, F.xxhash64("text"))
    one = rows.join(kept, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(key) == F.col(k)), "left_semi")
    return one.dropDuplicates(["doc_id", key]).select(*[F.col(f"`{c}`") for c in docs.columns])
