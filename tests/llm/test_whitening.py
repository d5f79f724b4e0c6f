"""Whitening against numpy, its block layout, and odd tables."""

import numpy as np
import pytest

from vigilspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, row long, x string, w double, at int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 5, "x", 0.5, 1) for i, v in rows], SCHEMA)


def brute(vectors):
    """(deviations, eigenvalues falling, whitened rows) of float32 vectors."""
    x = np.floor(np.array(vectors, np.float32).astype(float) * 1024).astype(int) + 100000
    n, s = len(x), x.sum(0)
    c = x - s / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    order = np.argsort(-values)
    values, vectors = values[order], vectors[:, order]
    return [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x], values, c @ vectors / np.sqrt(values)


def draws(n, d, seed=1):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 0.2).astype(np.float32)


def held(spark, vectors, components=8):
    rows = whitening.report(frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors)]), components).toPandas()
    deviations, values, white = brute(vectors)
    k = min(components, vectors.shape[1])
    assert len(rows) == len(vectors) * k and set(rows.n) == {len(vectors)}
    got = rows.pivot(index="vec_id", columns="component", values="whitened").sort_index().to_numpy()
    for j in range(k):   # either sign, the same for all rows
        assert min(np.abs(got[:, j] - white[:, j]).max(), np.abs(got[:, j] + white[:, j]).max()) < 1e-9
    first = rows[rows.component == 1].sort_values("vec_id")
    assert first.deviation.tolist() == deviations
    assert np.allclose(rows.groupby("component").explained.first(), values[:k] / values.sum(), rtol=1e-9)
    assert rows.identity_error.nunique() == 1 and rows.identity_error[0] < 1e-9


def test_against_numpy(spark):
    held(spark, draws(300, 12))
    held(spark, draws(40, 3), components=5)


def test_many_blocks_and_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "LEAST_ROWS", 7)
    monkeypatch.setattr(whitening, "TASK_BYTES", 1000)
    held(spark, draws(205, 6))      # 30 blocks, the last one short


def test_one_table_at_any_partitioning(spark):
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(draws(120, 5))])
    one, two = (whitening.report(x).toPandas().sort_values(["vec_id", "component"]) for x in (df.coalesce(1), df.repartition(7)))
    assert np.abs(np.abs(one.whitened.to_numpy()) - np.abs(two.whitened.to_numpy())).max() < 1e-9
    assert (one.deviation.to_numpy() == two.deviation.to_numpy()).all()


def test_left_out_rows_and_repeated_ones(spark):
    good = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 4.5]), (9, [0.5, -7.25])]
    bad = [(2, None), (3, []), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0]), (8, [1.0, 2.0, 3.0])]
    one = whitening.report(frame(spark, good + bad)).collect()
    assert sorted(r.vec_id for r in one if r.vec_id and r.component == 1) == [1, 1, 9] and len(one) == 8
    assert {r.n for r in one} == {4}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_nothing_to_fit(spark, rows):
    out = whitening.report(frame(spark, rows))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.count() == 0


def test_no_variance(spark):
    rows = whitening.report(frame(spark, [(1, [2.0, 2.0]), (2, [2.0, 2.0])])).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in rows] == [(0, None, None, None)] * 4
    rows = whitening.report(frame(spark, [(1, [1.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert all((r.whitened is None) == (r.component == 2) and r.identity_error < 1e-12 for r in rows)


def test_entries_of_any_size(spark):
    rows = whitening.report(frame(spark, [(1, [3e38, -3e38]), (2, [1.0, 0.0]), (3, [2.0, 5.0])])).collect()
    assert {r.deviation for r in rows} == {None} and all(abs(r.whitened or 0) < 10 for r in rows)
