from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

import cases
from vigilspark.llm import piece_sampling as ps
from vigilspark.llm import textblocks as tb


def decoded(p, texts, keys=None):
    keys = ps.row_keys(pa.array(range(len(texts)), pa.int64()), 1) if keys is None else keys
    ids, cuts = ps.encode_texts(p, texts, keys)
    raw, at = ps.decode_bytes(p, ids, cuts)
    return [raw[at[i]:at[i + 1]].tobytes().decode() for i in range(len(texts))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_round_trip(texts):
    assert decoded(ps.pieces(), texts) == texts


def test_long_chunks():
    texts = ["x" * 5000, "é🙂" * 300 + " end", "", "▁" * 50, "a" * (ps.LONG + 1) + "\n" + "b" * 30]
    assert decoded(ps.pieces(), texts) == texts


def segmentations(p, chunk):
    points, out = tuple(ps._points([chunk]).tolist()), {}

    def go(i, path, weight):
        if i == len(points):
            out[path] = weight
        for j in range(i + 1, min(len(points), i + p.longest) + 1):
            k = p.ids.get(points[i:j])
            if k is not None:
                go(j, (*path, k), weight + p.weight[k])

    go(0, (), 0.0)
    z = np.logaddexp.reduce(list(out.values()))
    return {k: float(np.exp(v - z)) for k, v in out.items()}


def test_samples_follow_the_lattice():
    p, n = ps.pieces(), 30_000
    want = segmentations(p, " then")
    ids, cuts = ps.encode_texts(p, ["then"] * n, tb.mix(np.arange(n, dtype=np.uint64)))
    got = Counter(tuple(ids[cuts[i]:cuts[i + 1]].tolist()) for i in range(n))
    assert set(got) <= set(want)
    assert max(abs(got[k] / n - v) for k, v in want.items()) < 0.015
    few = Counter(tuple(ps.sample_long(p, " then", 1.0, int(tb.mix(np.array([i], np.uint64))[0]), 0)) for i in range(3000))
    assert max(abs(few[k] / 3000 - v) for k, v in want.items()) < 0.05


def test_sample_depends_on_the_row_only():
    p = ps.pieces()
    texts, keys = [cases.PROSE, "other text " * 40, cases.PROSE], ps.row_keys(pa.array([1, 2, 3]), 1)
    ids, cuts = ps.encode_texts(p, texts, keys)
    alone, _ = ps.encode_texts(p, texts[2:], keys[2:])
    assert ids[cuts[2]:cuts[3]].tolist() == alone.tolist()
    assert ids[cuts[0]:cuts[1]].tolist() != alone.tolist()


def test_frames(spark):
    docs = cases.odd(spark)
    out = ps.encode(docs)
    assert out.columns[:-3] == docs.columns and out.count() == docs.count()
    assert out.where("text IS NOT NULL AND NOT lossless").count() == 0
    assert out.where("text IS NULL AND (piece_ids IS NOT NULL OR lossless IS NOT NULL)").count() == 0
    back = ps.decode(out.withColumnRenamed("text", "original"))
    assert back.where("NOT (text <=> original)").count() == 0
    assert ps.encode(docs, spell=True).select(docs.columns).exceptAll(docs).count() == 0
    moved = {(r.doc_id, r.text): r.piece_ids for r in ps.encode(docs.repartition(5)).collect()}
    assert all(moved[r.doc_id, r.text] == r.piece_ids for r in out.collect())
    assert ps.encode(cases.empty(spark)).count() == 0
