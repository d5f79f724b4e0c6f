import random

import numpy as np
import pytest
import xxhash

import cases
from vigilspark.llm import simhash_trie as st


def fingerprint(text, size=4):
    w = cases.spaced_words(cases.lower(text or ""))
    shingles = [" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(fps, bits):
    fps = sorted(set(fps))
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= bits:
                parent[find(b)] = find(a)
    groups = {}
    for f in fps:
        groups.setdefault(find(f), set()).add(f)
    return {frozenset(g) for g in groups.values()}


def test_documents(spark):
    docs = [(i, t) for i, t in cases.ROWS] + [(30 + i, cases.PROSE + " " + "tail " * i) for i in range(6)]
    got = st.near_duplicates(cases.odd(spark, docs)).collect()
    prints = [(i, fingerprint(t)) for i, t in docs]
    assert sorted((r.doc_id, r.fingerprint) for r in got if r.doc_id) == sorted((i, f"{f:016x}") for i, f in prints if i)
    groups = roots([f for _, f in prints], st.BITS)
    least = {f: min((i for i, g in prints if g in group and i is not None), default=None) for group in groups for f in group}
    for r in got:
        assert r.component_id == least[int(r.fingerprint, 16)]
    assert st.near_duplicates(cases.empty(spark)).count() == 0
    one = st.keep_one(cases.odd(spark, docs))
    assert one.columns == cases.odd(spark, docs).columns and one.count() == len(groups)


@pytest.mark.parametrize("max_leaves", [4096, 8])
@pytest.mark.parametrize("bits", [4, 3])
def test_links_close_to_the_same_components(spark, bits, max_leaves):
    rng = random.Random(bits)
    fps = {0, (1 << 64) - 1}
    for _ in range(25):
        f = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 30)):
            fps.add(f)
            for _ in range(rng.randrange(1, 3)):
                f ^= 1 << rng.randrange(64) if rng.random() < 0.7 else 0
    fps |= {rng.getrandbits(64) for _ in range(300)}
    signed = [(int(np.uint64(f).view(np.int64)),) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    marked = st.rooted(df, bits, max_leaves).collect()
    groups = {}
    for r in marked:
        groups.setdefault(r.root, set()).add(r.fp % (1 << 64))
    assert {frozenset(g) for g in groups.values()} == roots(fps, bits)


def test_blocks_cover_all_bits():
    for bits in (0, 1, 3, 4, 6):
        assert sum(st.block_sizes(bits)) == 64 and st.allowed(bits).shape == (bits + 1, 64)
