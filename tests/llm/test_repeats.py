import hashlib
import random
from collections import Counter

import pytest

import cases
from vigilspark.llm import repeat_columns


def brute(rows, span):
    raw = [(t or "").encode() for _, t in rows]
    times = Counter(b[i:i + span] for b in raw for i in range(len(b) - span + 1))
    out = []
    for (doc, _), b in zip(rows, raw, strict=True):
        gone = [False] * len(b)
        for i in range(len(b) - span + 1):
            if times[b[i:i + span]] > 1:
                gone[i:i + span] = [True] * span
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((doc, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def drawn(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcé \n") for _ in range(n))
    shared = [text(rng.randrange(30, 400)) for _ in range(8)]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(0, 150))]
        for _ in range(rng.randrange(0, 4)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            parts += [s[a:a + rng.randrange(20, 400)], text(rng.randrange(0, 60))]
        rows.append((i, "".join(parts)))
    return rows + [(100, "ab" * 300), (101, "z" * 500), (102, "z" * 199), (103, "q" * 200), (104, "q" * 201)]


@pytest.mark.parametrize("span, gram, max_bucket", [(40, 10, 50_000), (40, 10, 3), (200, 48, 50_000), (200, 48, 4), (33, 33, 2)])
def test_equals_brute_force(spark, span, gram, max_bucket):
    rows = [*drawn(span), *cases.ROWS]
    got = repeat_columns.without_repeats(cases.odd(spark, rows), span, gram, max_bucket).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, span)


def test_blocks_of_buckets(spark, monkeypatch):
    rows = drawn(9)
    import numpy as np

    monkeypatch.setattr(repeat_columns, "_CHUNK", 64)    # texts in overlapping pieces
    data = np.frombuffer(b"".join(t.encode() for _, t in rows[:20]), np.uint8)
    few = repeat_columns.anchors(data, 40, 10)
    monkeypatch.setattr(repeat_columns, "_CHUNK", 1 << 19)
    many = repeat_columns.anchors(data, 40, 10)
    windows = lambda x: {w: (int(h), int(p)) for h, p, a, b in zip(*x, strict=True) for w in range(a, b + 1)}
    assert windows(few) == windows(many)


def test_large_buckets_are_halved(spark, monkeypatch):
    """Many different texts around one passage: their buckets stay too large until the windows' distances part."""
    rng = random.Random(3)
    passage = "the one passage of them all, which every text here quotes in full"
    text = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    rows = [(i, text(60) + passage + text(60)) for i in range(30)] + [(50 + i, rng.choice("xy") + passage * 2) for i in range(6)]
    deep = []
    children = repeat_columns._children
    monkeypatch.setattr(repeat_columns, "_children", lambda *a: deep.append(1) or children(*a))
    got = repeat_columns.without_repeats(cases.odd(spark, rows), 40, 10, 3).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, 40)
    assert len(deep) > 2


def test_buckets_are_large_by_segments_not_texts(spark, monkeypatch):
    """Two texts that repeat one line among changing neighbours: few texts, many segments."""
    rng = random.Random(5)
    line = "one line that two long texts repeat again and again"
    text = lambda n: "".join(rng.choice("abcdef ") for _ in range(n))
    rows = [(i, "".join(text(40) + line + text(40) for _ in range(12))) for i in range(2)] + [(9, text(300))]
    entered = []
    of_large = repeat_columns.spans_of_large
    monkeypatch.setattr(repeat_columns, "spans_of_large", lambda *a: entered.append(1) or of_large(*a))
    got = repeat_columns.without_repeats(cases.odd(spark, rows), 40, 10, 5).drop("kept").collect()
    assert entered
    assert sorted(map(tuple, got), key=str) == brute(rows, 40)
    assert any(r[2] for r in brute(rows, 40))


def test_empty(spark):
    assert repeat_columns.without_repeats(cases.empty(spark)).count() == 0


def test_segments_are_counted_as_ordered(spark):
    """Segments by anchor, equal ones of a text once, as the rows that a bucket is made of."""
    rows = [(k, t) for k, (_, t) in enumerate([*drawn(40), *cases.ROWS])]
    keyed = cases.odd(spark, rows).selectExpr("doc_id AS key", "text")
    counted = {(r.hash, r.key): r.segments for r in repeat_columns.map_arrow(
        keyed, repeat_columns._anchor_rows(40, 10), "hash long, key long, n int, segments int").collect()}
    wanted = spark.createDataFrame([(k, [h for h, x in counted if x == k]) for k in {x for _, x in counted}], "key long, hashes array<long>")
    made = Counter((r.hash, r.key) for r in repeat_columns.map_arrow(
        keyed.join(wanted, "key"), repeat_columns._segment_rows(40, 10),
        "hash long, place int, segment binary, key long, starts array<int>").select("hash", "key").collect())
    assert counted == dict(made)
