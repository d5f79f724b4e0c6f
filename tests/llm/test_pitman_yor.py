"""The language model: counts by plain Python, seatings against exact sums, probabilities that add up."""

import math
import pickle
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from vigilspark.llm import pitman_yor as P

SF = "/root/testdata/sf0.01"


def words(text):
    return [*cases.spaced_words(cases.lower(text or "")), "</s>"]


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7


def held(rows, got):
    """Everything but the model's score, by plain Python."""
    counts = Counter(w for i, t in rows if fold(i) not in (None, 2) for w in words(t))
    n, v = sum(counts.values()), len(counts)
    told = [(i, fold(i) == 2, len(words(t)), sum(counts[w] > 0 for w in words(t)), n,
             round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words(t)), 6)) for i, t in rows]
    assert sorted(map(str, told)) == sorted(str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))) for r in got)
    assert all(math.isfinite(r.score) and r.score <= 1e-9 and math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens), rel_tol=1e-9) for r in got)


def test_counts_and_held_out_perplexity(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = P.report(docs).collect()
    held([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], got)
    unseen = [r for r in got if r.held_out]
    mean = lambda c: sum(r[c] for r in unseen) / sum(r.n_tokens for r in unseen)
    assert mean("score") > mean("base_score") + 0.3


def test_odd_rows(spark):
    df = cases.odd(spark)
    held(cases.ROWS, P.report(df).collect())
    assert P.report(cases.empty(spark)).count() == 0
    nothing = P.language_model(df, F.lit(False), F.lit(True)).collect()
    assert {round(r.score, 9) for r in nothing} == {0.0} and {r.train_tokens for r in nothing} == {0}
    named = spark.createDataFrame([("a", "x y"), ("b", None)], "doc_id string, text string")
    assert {r.doc_id for r in P.report(named).collect()} == {"a", "b"}


def test_cut_differently_the_scores_stay(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 300")
    monkeypatch.setattr(P, "BUCKET_BYTES", 100_000)        # several buckets, split contexts
    one = {r.doc_id: r for r in P.report(docs).collect()}
    two = {r.doc_id: r for r in P.report(docs.repartition(5)).collect()}
    assert all(math.isclose(one[i].score, two[i].score, rel_tol=1e-9) for i in one)
    held([(r.doc_id, r.text) for r in docs.collect()], one.values())


def test_a_text_in_chunks_is_the_text_whole(monkeypatch):
    import pyarrow as pa

    text = "Words of any LENGTH " * 300 + "x" * 900 + " end"
    whole = P.tokens(next(P.tb.blocks(pa.RecordBatch.from_pydict({"text": [text]}))))
    monkeypatch.setattr(P, "CHUNK", 256)
    cut = P.tokens(next(P.tb.blocks(pa.RecordBatch.from_pydict({"text": [text]}))))
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all() and len(cut[0]) == len(words(text))


def exact_tables(c, p, d, theta):
    """Mean number of tables of c customers who eat one dish of base probability p, alone in a restaurant."""
    stirling = np.zeros((c + 1, c + 1))
    stirling[0, 0] = 1
    for n in range(c):
        for t in range(1, n + 2):
            stirling[n + 1, t] = stirling[n, t - 1] + (n - t * d) * stirling[n, t]
    weight = [0] + [stirling[c, t] * math.prod(theta + d * i for i in range(t)) * p**t for t in range(1, c + 1)]
    return sum(t * w for t, w in enumerate(weight)) / sum(weight)


@pytest.mark.parametrize("c, p", [(2, 0.5), (5, 0.3), (5, 0.9), (12, 0.6)])
def test_seating_samples_the_exact_distribution(c, p):
    n, rng = 6000, np.random.default_rng(3)
    mean, last = P.seat(np.full(n, c), np.arange(n), np.full(n, p), n, 0.6, 1.0, rng, burn=60, keep=6, reseats=12)
    assert abs(mean.mean() - exact_tables(c, p, 0.6, 1.0)) < 0.03
    assert 1 <= last.min() and last.max() <= c


def stirling_mean(c, y, d):
    row = P._stirling(np.array([c]), d)[c] + np.arange(1, c + 1) * math.log(y)
    weight = np.exp(row - row.max())
    return weight / weight.sum() @ np.arange(1, c + 1)


@pytest.mark.parametrize("c, p, tables", [(100, 0.05, 30), (100, 0.9, 30), (2000, 0.02, 4000), (3000, 0.02, 4000)])
def test_all_customers_of_a_frequent_pair_sit_down_again(c, p, tables):
    """With the sweeps of the model, from the first seating on; 3.7, 30.4, 179 and 198 tables when six customers moved a sweep."""
    n = 400
    mean, _ = P.seat(np.full(n, c), np.arange(n), np.full(n, p), n, 0.6, 1.0, np.random.default_rng(3), np.full(n, float(tables)))
    exact = stirling_mean(c, (1 + 0.6 * tables) * p, 0.6)
    assert abs(mean.mean() - exact) < 0.02 * exact + 0.05


@pytest.mark.parametrize("d", [0.05, 0.4, 0.7, 0.95])
def test_weights_of_large_types_are_those_of_the_recursion(d):
    for c in (2049, 2600):
        for y in (1e-6, 0.3, 4, 90, c / 2, 2.5 * c, 40 * c, 1e9):
            row = P._stirling(np.array([c]), d)[c] + np.arange(1, c + 1) * math.log(y)
            whole, got = np.exp(row - row.max()), np.zeros(c)
            tilt, middle = P._middle(np.array([c]), np.array([math.log(y)]), d)
            first, weight = P._weights(c, math.log(y), d, tilt[0], middle[0])
            got[first - 1:first - 1 + len(weight)] = weight
            assert np.abs(got / got.sum() - whole / whole.sum()).max() < 1e-6


def test_seating_keeps_to_its_bounds():
    rng = np.random.default_rng(4)
    count, where = rng.zipf(1.6, 3000).clip(1, 50_000), rng.integers(0, 40, 3000)
    mean, last = P.seat(count, where, rng.random(3000), 40, 0.8, 1.0, rng)
    assert (last >= 1).all() and (last <= count).all() and (mean[count == 1] == 1).all()
    again = [P.seat(count, where, np.full(3000, 0.1), 40, 0.8, 1.0, np.random.default_rng(5))[0] for _ in range(2)]
    assert (again[0] == again[1]).all()


def test_probabilities_add_up():
    """All steps in plain Python: the parent's probabilities and those of every context sum to one, split contexts too."""
    texts, n = [f"a b{i % 4} a c{i % 7} a" for i in range(60)] + ["a b0"] * 30, 3
    names = sorted({w for t in texts for w in t.split()})
    code = {w: np.uint64(hash_of) for w, hash_of in zip(names, range(11, 1000, 17))}
    word = np.concatenate([np.array([*(code[w] for w in t.split()), P.END], np.uint64) for t in texts])
    row = np.concatenate([np.full(len(t.split()) + 1, i) for i, t in enumerate(texts)])
    hot = np.sort(np.array([code["a"], P.BEGIN], np.uint64))
    pairs = [(b, ("pairs", 1, data)) for b, data in P._dealt(word, row, np.ones(len(texts), np.int64), hot, n)]
    known, told = P.Known(), []
    for _ in range(2):
        seen = P.Known(**vars(known))
        up = list(P._up(seen, hot, n)(iter(pairs + told)))
        tally, split = next(P._tallied(iter(up)))
        known = P.Known(seen.rounds, 0.6, 0.6, int(tally[0]), int(tally[1]), int(tally[2]), 0.0, split)
        known.roots = float(sum(P._roots(p, t, known).sum() for p, _, _, _, t, _ in P._words(iter(up))))
        last, known = known, P.Known(**vars(known) | {"rounds": known.rounds + 1, "child": 0.6})
        told = told + list(P._replies(last)(iter(up)))
    assert tally[0] == len(word) and tally[1] == len(names) + 1
    base, own, sat = {}, {}, {}
    for number, mine, rest in P._by_bucket(iter(pairs + told)):
        b = P.load(mine, n)
        share = P._shares(rest, f"share{last.rounds}")[0]
        mean, _, customers, tables = P._round(b, number, seen, P._shares(rest, f"share{seen.rounds - 1}")[0], hot, n)
        base |= dict(zip(b.words.tolist(), last.base(share).tolist()))
        for t, (u, w) in enumerate(zip(b.ctx, b.word)):
            own[int(b.contexts[u])] = own.get(int(b.contexts[u]), 0) + b.count[t] - last.child * mean[t]
        for u, h in enumerate(b.contexts.tolist()):
            sat[h] = last.split[h] if h in last.split else (customers[u], tables[u])
    assert math.isclose(sum(base.values()) + last.base(np.zeros(1))[0], 1, rel_tol=1e-6)
    for u, (customers, tables) in sat.items():
        assert math.isclose((own[u] + P.STRENGTH + last.child * tables) / (P.STRENGTH + customers), 1, rel_tol=1e-9)


def test_packing():
    arrays = [np.array([1, 300, 70000]), np.zeros(0, np.int64), np.array([2**63 + 5], np.uint64), np.array([0.5, -3.25])]
    assert all((a == b).all() for a, b in zip(arrays, P.unpack(P.pack(*arrays))))
    assert pickle.loads(P.pack(np.array([255])))[0][0] == "|u1"
