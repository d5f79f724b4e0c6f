import hashlib
import random

import pytest

import cases
from vigilspark.llm import winnowing


def brute(docs, items, window=13):
    windows = {}
    for item, text in items:
        w = cases.alnum_words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault((n, tuple(w[i:i + n])), set()).add("null" if item is None else str(item))
    out = []
    for i, text in docs:
        w = cases.alnum_words(text)
        hit, found = set(), set()
        for n in {n for n, _ in windows}:
            for a in range(len(w) - n + 1):
                of = windows.get((n, tuple(w[a:a + n])))
                if of:
                    hit |= set(range(a, a + n))
                    found |= of
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def drawn(seed):
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice("aa bb cc dd EE ff".split()) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 3, 5, 8, 12, 13, 14, 20, 40]))) for i in range(12)] + [(99, None), (98, "..."), (None, text(15)), (3, text(13))]
    docs = []
    for i in range(40):
        parts = [text(rng.randrange(0, 30))]
        for _ in range(rng.randrange(3)):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randrange(0, len(w) + 1)
            parts += [" ".join(w[a:a + rng.randrange(5, 30)]), text(rng.randrange(0, 10))]
        docs.append((i, ", ".join(parts)))
    return docs, items


@pytest.mark.parametrize("broadcast", [500_000, -1])
@pytest.mark.parametrize("drop_short", [True, False])
def test_equals_brute_force(spark, monkeypatch, broadcast, drop_short):
    monkeypatch.setattr(winnowing, "BROADCAST_ROWS", broadcast)
    docs, items = drawn(4)
    if drop_short:
        items = [(i, t) for i, t in items if t is None or len(t.split()) >= 12]
    rows = [*docs, *cases.ROWS]
    got = winnowing.contamination(cases.odd(spark, rows), cases.bench(spark, items)).drop("_key").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, items)


@pytest.mark.parametrize("limit", [64 << 20, 2_000])
def test_items_are_broadcast_by_bytes(spark, monkeypatch, limit):
    """Few items with many words are not broadcast, though their rows are few."""
    monkeypatch.setattr(winnowing, "BROADCAST_BYTES", limit, raising=False)
    sent = []
    broadcast = winnowing.F.broadcast
    monkeypatch.setattr(winnowing.F, "broadcast", lambda df: sent.append(df.columns) or broadcast(df))
    docs, items = drawn(6)
    items = [*items, (50, docs[0][1] + " zz" * 3000)]
    got = winnowing.contamination(cases.odd(spark, docs), cases.bench(spark, items)).drop("_key").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
    assert any("words" in columns for columns in sent) == (limit > 2_000)


def test_empty_tables_and_keep_clean(spark):
    docs = cases.odd(spark)
    nothing = cases.bench(spark, [])
    assert winnowing.contamination(docs, nothing).where("n_hit > 0 OR contaminated").count() == 0
    assert winnowing.contamination(cases.empty(spark), nothing).count() == 0
    clean = winnowing.keep_clean(docs, cases.bench(spark, [(1, cases.PROSE)]))
    assert clean.columns == docs.columns
    of = {(i, t): b for (i, t), b in zip(sorted(cases.ROWS, key=str), [r[-1] for r in brute_in_order(cases.ROWS)], strict=True)}
    kept = [(r.doc_id, r.text) for r in clean.collect()]
    assert sorted(kept, key=str) == sorted((r for r in cases.ROWS if not of[r]), key=str)
    assert (3, None) in kept and (1, cases.PROSE) not in kept


def brute_in_order(rows):
    return [brute([r], [(1, cases.PROSE)])[0] for r in sorted(rows, key=str)]


def test_a_hot_phrase_proposes_nothing(spark, monkeypatch):
    """200 documents and 300 items share ten words, and two of them a whole window."""
    phrase = "one two three four five six seven eight nine ten"
    docs = [(i, f"d{i} e{i} f{i} {phrase} g{i} h{i} j{i}") for i in range(200)]
    items = [(i, f"q{i} r{i} s{i} {phrase} t{i} u{i} v{i}") for i in range(300)]
    items.append((900, f"xx yy {docs[7][1]} zz"))
    rows = []
    keep = winnowing.stored
    monkeypatch.setattr(winnowing, "stored", lambda df, label: rows.append((label, (out := keep(df, label)).count())) or out)
    got = winnowing.contamination(cases.odd(spark, docs), cases.bench(spark, items)).drop("_key").collect()
    assert sorted(map(tuple, got), key=str) == brute(docs, items)
    assert dict(rows)["hit-windows"] == 4 and dict(rows)["hits"] <= 200       # 16 words hold four windows of 13
