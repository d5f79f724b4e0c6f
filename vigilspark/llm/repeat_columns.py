"""Repeated byte strings by column-wise suffix ordering of many texts at once.

Every byte that lies in a ``SPAN``-byte string which also starts elsewhere is removed.

A suffix array of all texts in one place does not scale, and inserting a symbol of each text
per round takes as many rounds as the longest text has bytes.  So texts are first cut: the
smallest k-gram hash of each SPAN-byte window (winnowing) is its anchor, equal windows have
equal anchors at equal places, and a run of windows with one anchor is a segment.  Only
segments whose anchor hash occurs twice or more are kept, and meet by hash.

Segments of a bucket are laid side by side on their anchors, and one symbol of each is
inserted per round, from the last column to the first: a stable partition by the symbol turns
the order of suffixes after the column into that from it on, and common prefixes of neighbours
follow from range minima; no Burrows-Wheeler transform of the collection is kept.  A window whose suffix shares SPAN bytes or more with a neighbour is repeated.
A task reads its buckets one after another from sorted shuffle files and holds one block of
them; rounds are bounded by the span.  In buckets beyond ``MAX_BUCKET`` segments equal ones
are put together first; if too many stay, windows nearer to the anchor and farther from it
part, each under the hash of the longer stretch they have in common (``spans_of_large``).

Null texts are empty.  Texts are compared as UTF-8 bytes; matches never cross texts.  A
repeated row is another place, so its bytes are repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblocks as tb
from .shipping import map_arrow
from .tables import stored

SPAN = 200
GRAM = 48
MAX_BUCKET = 50_000
BLOCK = 16_384           # segments ordered together, whole buckets
_CHUNK = 1 << 19         # windows anchored at once


def anchors(data: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, anchor, first window, last window) of every segment of one text."""
    parts = []
    windows = len(data) - span + 1
    width = span - gram + 1                      # k-grams in a window
    for lo in range(0, windows, _CHUNK):
        hi = min(windows, lo + _CHUNK)
        piece = data[lo:hi + span - 1]
        sums = tb.prefix_sums(piece)
        at = np.arange(len(piece) - gram + 1)
        hashes = tb.range_hash(sums, at, at + gram)
        # smallest hash first, the rightmost of equal ones; the place fits in the low bits
        key = (hashes >> tb.U64(21) << tb.U64(21)) | (tb.U64((1 << 21) - 1) - at.astype(np.uint64))
        low, size = key, 1
        while size * 2 <= width:
            low = np.minimum(low[:-size], low[size:])
            size *= 2
        if size < width:
            low = np.minimum(low[:len(low) - (width - size)], low[width - size:])
        anchor = (tb.U64((1 << 21) - 1) - (low & tb.U64((1 << 21) - 1))).astype(np.int64)
        new = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        parts.append((hashes[anchor[new]], anchor[new] + lo, new + lo, np.append(new[1:], len(anchor)) - 1 + lo))
    if not parts:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _anchor_rows(span: int, gram: int):
    """Anchor hashes of each text, the places of each (``n``) and its segments, equal ones once (``segments``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch):
                hashes, rows, times, different = [], [], [], []
                for i in range(block.n):
                    data = block.buf[block.bounds[i]:block.bounds[i + 1]]
                    each, p, a, b = anchors(data, span, gram)
                    h, which, n = np.unique(each, return_inverse=True, return_counts=True)
                    unlike = n.copy()
                    at = np.flatnonzero(n[which] > 1)
                    if len(at):
                        segment = tb.range_hash(tb.prefix_sums(data), a[at], b[at] + span)
                        place = tb.mix((p[at] - a[at]).astype(np.uint64))
                        _, one = np.unique(tb.pair_hash(tb.pair_hash(each[at], segment), place), return_index=True)
                        unlike = np.where(n > 1, np.bincount(which[at[one]], minlength=len(h)), n)
                    hashes.append(h)
                    times.append(n)
                    different.append(unlike)
                    rows.append(np.full(len(h), i))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(hashes).view(np.int64)), block.rows.column("key").take(pa.array(np.concatenate(rows))),
                     pa.array(np.concatenate(times).astype(np.int32)), pa.array(np.concatenate(different).astype(np.int32))],
                    ["hash", "key", "n", "segments"])

    return run


def _segment_rows(span: int, gram: int):
    """Segments of the wanted anchors; ``starts``: first windows of equal segments of one text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch):
                out = []
                keys = block.rows.column("key").to_pylist()
                for i, wanted in enumerate(block.rows.column("hashes")):
                    data = block.buf[block.bounds[i]:block.bounds[i + 1]]
                    h, p, a, b = anchors(data, span, gram)
                    known = np.sort(wanted.values.to_numpy().view(np.uint64))
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    mine: dict[tuple, list] = {}
                    raw = data.tobytes()
                    for j in np.flatnonzero(known[at] == h).tolist():
                        mine.setdefault((int(h[j].view(np.int64)), int(p[j] - a[j]), raw[a[j]:b[j] + span]), []).append(int(a[j]))
                    out += [(*k, keys[i], v) for k, v in mine.items()]
                if out:
                    types = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.int32())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                     ["hash", "place", "segment", "key", "starts"])

    return run


def repeated_windows(bucket: np.ndarray, place: np.ndarray, segments: list[bytes], span: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, window) of every window of a segment that another segment of its bucket holds too.

    ``place`` is the anchor's place in the segment; columns are counted from the anchor.
    """
    m = len(segments)
    size = np.fromiter(map(len, segments), np.int64, m)
    left = int(place.max())
    width = left + int((size - place).max())
    table = np.zeros((width, m), np.int16)                    # 0: outside; column by column
    flat = np.frombuffer(b"".join(segments), np.uint8)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(left - place, size)
    table[column, np.repeat(np.arange(m), size)] = flat.astype(np.int16) + 1
    _, group = np.unique(bucket, return_inverse=True)
    order = np.argsort(group, kind="stable")                  # of suffixes from the column after
    common = np.zeros(m, np.int32)                            # shared with the one before in order
    first_window, last_window = left - place, left - place + size - span
    found = []
    for c in range(width - 1, -1, -1):
        symbol = table[c]
        key = group[order] * 257 + symbol[order]
        turn = np.argsort(key, kind="stable")
        key = key[turn]
        same = (key[1:] == key[:-1]) & (symbol[order[turn[1:]]] > 0)
        grown = np.zeros(m, np.int32)
        at = np.flatnonzero(same)
        if len(at):
            # least common prefix between the two in the old order
            ends = np.stack([turn[at] + 1, turn[at + 1] + 1], axis=1).ravel()
            grown[at + 1] = 1 + np.minimum.reduceat(np.append(common, 0), ends)[::2]
        order, common = order[turn], grown
        if c <= left:
            long = common >= span
            if long.any():
                hit = long.copy()
                hit[:-1] |= long[1:]
                who = order[hit]
                who = who[(first_window[who] <= c) & (c <= last_window[who])]
                found.append((who, np.full(len(who), c) - first_window[who]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _spans_of(who: np.ndarray, window: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, start, end) of runs of windows, in bytes from the segment's start."""
    order = np.lexsort((window, who))
    who, window = who[order], window[order]
    new = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (window[1:] != window[:-1] + 1)])) if len(who) else np.zeros(0, int)
    last = np.append(new[1:], len(who)) - 1
    return who[new], window[new], window[last] + span if len(new) else window[new]


def _ordered(span: int):
    def spans(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        segments = rows["segment"].to_pylist()
        bucket, place = rows["hash"].to_numpy(), rows["place"].to_numpy().astype(np.int64)
        starts = rows["starts"].to_pylist()
        times = np.fromiter(map(len, starts), np.int64, len(starts))
        who, window = repeated_windows(bucket, place, segments, span)
        many = np.flatnonzero(times > 1)                      # equal segments within one text
        who, a, b = _spans_of(who, window, span)
        alone = times[who] == 1
        who, a, b = who[alone], a[alone], b[alone]
        base = np.array([s[0] for s in starts], np.int64)
        out_row, out_a, out_b = [who], [base[who] + a], [base[who] + b]
        for i in many:
            s = np.array(starts[i], np.int64)
            out_row.append(np.full(len(s), i))
            out_a.append(s)
            out_b.append(s + len(segments[i]))
        keys = rows["key"].take(pa.array(np.concatenate(out_row))).combine_chunks()
        yield pa.RecordBatch.from_arrays([keys, pa.array(np.concatenate(out_a)), pa.array(np.concatenate(out_b))], ["key", "a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK:                                    # whole buckets; the last may go on
                rows = pa.Table.from_batches(held)
                hashes = rows["hash"].to_numpy()
                cut = int(np.searchsorted(hashes, hashes[-1]))
                if cut:
                    yield from spans(rows.slice(0, cut))
                held = rows.slice(cut).to_batches()
                n -= cut
        if n:
            yield from spans(pa.Table.from_batches(held))

    return run


_BUCKET = ["hash", "lo", "hi"]
_CLASS = [*_BUCKET, "place", "segment"]


def _children(classes: DataFrame, span: int) -> DataFrame:
    """Segments of both halves of each bucket's range of distances, under the hash of the bytes a half has in common.

    A window that starts d bytes before the anchor, lo <= d <= hi, holds the bytes from lo before the anchor to
    span - hi after it.  ``key`` is the class a segment was cut from, ``starts`` its place there.
    """
    halves = F.inline(F.array(F.struct(F.col("lo").alias("_lo"), F.expr("int((lo + hi) div 2)").alias("_hi")),
                              F.struct(F.expr("int((lo + hi) div 2 + 1)").alias("_lo"), F.col("hi").alias("_hi"))))
    cut = (classes.select("*", halves)
           .withColumn("_first", F.expr("greatest(0, place - _hi)"))
           .withColumn("_last", F.expr(f"least(length(segment) - {span}, place - _lo)")).where("_first <= _last"))
    common = F.xxhash64("hash", F.expr(f"substring(segment, int(place - _lo + 1), int({span} - _hi + _lo))"))
    return cut.select(
        common.alias("hash"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi"), (F.col("place") - F.col("_first")).alias("place"),
        F.expr(f"substring(segment, _first + 1, _last - _first + {span})").alias("segment"),
        F.col("id").alias("key"), F.array("_first").alias("starts"), "n")


def _in_buckets(segments: DataFrame, span: int) -> DataFrame:
    kind = segments.schema["key"].dataType.simpleString()
    return map_arrow(segments.repartition("hash").sortWithinPartitions("hash"), _ordered(span), f"key {kind}, a long, b long")


def spans_of_large(segments: DataFrame, span: int, gram: int, max_bucket: int) -> DataFrame:
    """key, a, b of buckets with too many segments for one task, by the same ordering.

    Equal segments become one class and its number of places, combined before the shuffle.
    Buckets that still have too many classes are halved by the windows' distance from the
    anchor, until they are small: at the end a bucket is one distance, thus one window, thus
    one class.  What is found in a class is then handed back to the segments it stands for.
    """
    level = segments.select("*", F.lit(0).alias("lo"), F.lit(span - gram).alias("hi"), F.size("starts").cast("long").alias("n"))
    levels = []
    while True:
        members = stored(level.withColumn("id", F.md5(F.concat("segment", F.concat_ws(":", "hash", "lo", "hi", "place").cast("binary")))), "members")
        classes = stored(members.groupBy("id", *_CLASS).agg(F.sum("n").alias("n")), "classes")
        large = stored(classes.groupBy(_BUCKET).count().where(F.col("count") > max_bucket).drop("count"), "large-buckets")
        small = classes.join(large, _BUCKET, "left_anti").select(
            F.xxhash64(*_BUCKET).alias("hash"), "place", "segment", F.col("id").alias("key"),
            F.expr("array_repeat(0, int(least(n, 2)))").alias("starts"))      # repeated segments: twice
        levels.append((members.select("id", "key", "starts"), _in_buckets(small, span)))
        if large.isEmpty():
            break
        level = _children(classes.join(large, _BUCKET, "left_semi"), span)
    found = None
    for members, here in reversed(levels):
        of = (here if found is None else here.union(found)).distinct().withColumnRenamed("key", "id")
        found = members.join(of, "id").select("key", F.explode("starts").alias("_at"), "a", "b").select(
            "key", (F.col("_at") + F.col("a")).alias("a"), (F.col("_at") + F.col("b")).alias("b"))
    return found


def repeated_spans(keyed: DataFrame, span: int = SPAN, gram: int = GRAM, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """key, a, b: byte ranges made of repeated windows, for texts (key, text, and any other columns).

    Other columns travel with the text, so that a later join of the same rows by key finds
    them shuffled already.
    """
    places = map_arrow(keyed, _anchor_rows(span, gram), "hash long, key long, n int, segments int")   # twice: cheaper than keeping it
    shared = (places.groupBy("hash").agg(F.sum("n").alias("n"), F.sum("segments").alias("segments")).where("n > 1")
              .select("hash", (F.col("segments") > max_bucket).alias("large")))
    shared = stored(shared, "shared-anchors")
    wanted = places.join(shared, "hash").groupBy("key").agg(F.collect_set("hash").alias("hashes"))   # of one text each
    segments = map_arrow(keyed.join(wanted, "key"), _segment_rows(span, gram),
                         "hash long, place int, segment binary, key long, starts array<int>")
    large = shared.where("large").select("hash")
    if large.isEmpty():
        return _in_buckets(segments, span)
    segments = stored(segments, "segments")
    return _in_buckets(segments.join(large, "hash", "left_anti"), span).union(
        spans_of_large(segments.join(large, "hash", "left_semi"), span, gram, max_bucket))


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tb.blocks(batch):
            out = []
            for i, spans in enumerate(block.rows.column("spans").to_pylist()):
                raw = block.buf[block.bounds[i]:block.bounds[i + 1]].tobytes()
                kept, at, runs = [], 0, 0
                end = None
                for s in sorted((x["a"], x["b"]) for x in spans or ()):
                    if end is None or s[0] > end:
                        runs += 1
                    if s[0] > at:
                        kept.append(raw[at:s[0]])
                    at = max(at, s[1])
                    end = at
                kept = b"".join([*kept, raw[at:]])
                out.append((len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept))
            types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays([block.rows.column("doc_id"), *columns], [*_NAMES, "kept"])


_NAMES = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def without_repeats(docs: DataFrame, span: int = SPAN, gram: int = GRAM, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes (``kept``) of every document."""
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")
    found = repeated_spans(rows, span, gram, max_bucket)
    spans = found.groupBy("key").agg(F.collect_set(F.struct("a", "b")).alias("spans"))      # of one text each
    joined = rows.join(spans, "key", "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_arrow(joined, _cut_out, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
