"""The z-fast trie against a trie of Python dictionaries."""

import hashlib
import random
import zlib

import pytest

from vigilspark.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, path string, first int, high long, n long, part int, node string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, 2, 3, 4, "n") for r in rows], SCHEMA)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def brute(rows):
    members = {}
    for c, turns in rebuilt(rows).items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append((c, d == len(turns)))
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        yield p
        for c in children.get(p, []):
            yield from below(c)

    out = []
    for p, ms in members.items():
        ids = ",".join(str(c) for c, ended in sorted(ms) if ended)
        sub = list(below(p))
        out.append((min(c for c, _ in ms), len(p), min(c for c, _ in members[p[:-1]]) if p else None, len(ms), len(children.get(p, [])),
                    sum(1 for s in sub if s not in children), sum((len(members[s]) - 1) * len(s[-1][1].encode()) for s in sub if s),
                    hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    return sorted((tuple(r) for r in P.report(frame(spark, rows)).collect()), key=str)


def draws(n, words, longest, seed):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "system"]), rng.choice(words)) for c in rng.sample(range(3 * n), n) for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("rows", [
    draws(40, ["é", "bb"], 7, 1), draws(25, ["a"], 20, 2), draws(30, ["a", "b", "c", "dd"], 3, 3),
    [(c, t, "user", "same") for c in range(30) for t in range(4)],                                       # copies of one conversation
    [(5 * c, t, "user", "x" if t < c else f"y{c}") for c in range(12) for t in range(14)],                # cuts at every depth of an edge
    [(5 * c, t, "user", "x") for c in range(12) for t in range(c + 1)],                                    # each a prefix of the next
], ids=["few words", "long", "wide", "copies", "cuts", "prefixes"])
def test_against_dictionaries(spark, rows):
    assert got(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (0, None, None, None), (0, None, "a", ""), (0, 1, "user", None), (0, 1, "user", None), (7, 3, "user", "z" * 5000),
            (7, None, "user", ""), (8, 0, "r", "t"), (-3, 1, "user", "q")]
    keep = [r for r in rows if r[0] is None or r[0] >= 0]
    assert got(spark, keep) == brute(keep)
    assert {r[0] for r in got(spark, rows)} >= {-3}
    assert got(spark, []) == []
    alone = [(c, 0, "user", "one turn") for c in range(1, 5)]      # no base: most lose their only turn and end at the root
    assert got(spark, alone) == brute(alone)


def test_long_conversations(spark):
    rows = [(0, t, "user", f"w{t % 3}") for t in range(700)] + [(5, t, "user", f"w{t % 3}" if t < 650 else "new") for t in range(690)]
    assert got(spark, rows) == brute(rows)


@pytest.mark.parametrize("low, high, f", [(0, 1, 1), (0, 7, 4), (4, 7, 6), (6, 7, 7), (8, 23, 16), (0, 1 << 40, 1 << 40), (5, 6, 6)])
def test_fattest(spark, low, high, f):
    df = spark.createDataFrame([(low, high)], "low long, high long")
    assert df.select(P.fattest("low", "high")).first()[0] == f


def test_search_finds_where_a_sequence_leaves(spark):
    """Sequences that were never inserted, against the longest shared prefix found by hand."""
    stored, asked = draws(30, ["a", "b"], 9, 4), draws(30, ["a", "b", "z"], 9, 5)
    paths = [P.sequences(P.paths(P.rebuilt(P.turns(frame(spark, x))))) for x in (stored, asked)]
    trie, longest = P.build(paths[0])
    extents = {(r.high, r.ea, r.eb) for r in trie.collect()} | {(0, 0, 0)}
    known = {(d, k.a, k.b) for s in paths[0].collect() for d, k in enumerate(s.path)}
    for r in P.locate(paths[1], trie, max(longest, 20)).collect():
        keys = [(d, k.a, k.b) for d, k in enumerate(r.path)]
        assert r.left == max(d for d, *k in keys if (d, *k) in known)
        assert r.reached == max(d for d, *k in keys if (d, *k) in extents)


def test_ids_packed_in_several_texts(spark, monkeypatch):
    monkeypatch.setattr(P, "ID_BITS", 2)
    rows = [(c, 0, "user", "same") for c in range(0, 200, 5)] + [(c, 0, "user", "other") for c in range(1000, 1100, 5)]
    assert got(spark, rows) == brute(rows)
