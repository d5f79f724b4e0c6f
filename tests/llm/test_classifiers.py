"""Held-out accuracy, folds and degenerate tables of both classifiers."""

import math
import random
import zlib

import numpy as np
import pytest

import cases
from vigilspark.llm import quality_ftrl, textblocks, toxicity
from vigilspark.llm.tables import learning_rows

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize("score, label, least", [(quality_ftrl.quality_scores, "quality", 0.97), (toxicity.toxicity, "toxic", 0.97)])
def test_held_out_accuracy(tables, score, label, least):
    got = {r.doc_id: r for r in score(*tables).collect()}
    told = {r.doc_id: r[label] for r in tables[1].collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())
    held = [i for i in told if got[i].held_out]
    assert sum(got[i].predicted == told[i] for i in held) / len(held) >= least


@pytest.mark.parametrize("score", [quality_ftrl.quality_scores, toxicity.toxicity])
def test_odd_tables(spark, score):
    docs = cases.odd(spark)
    for labels in ([], [(1, 1, 0), (2, 1, 0)], [(1, 1, 1), (2, 0, 0), (6, 1, 0), (11, 0, 1), (3, None, None), (9, 1, 0), (9, 0, 1)]):
        got = score(docs, cases.labels(spark, labels)).collect()
        assert len(got) == len(cases.ROWS) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert score(cases.empty(spark), cases.labels(spark, [(1, 1, 0)])).count() == 0


def test_training_ignores_the_held_out_fold(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} thing " * 20) for i in range(60)], "doc_id long, text string")
    labels = [(i, i % 7 % 2, 0) for i in range(60)]
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    one, two = (quality_ftrl.train(docs, cases.labels(spark, x)) for x in (labels, turned))
    assert (one.weights == two.weights).all() and one.bias == two.bias


def test_keep_good_keeps_rows_as_they_are(spark):
    docs = cases.odd(spark)
    model = quality_ftrl.Model(quality_ftrl.np.zeros(2**quality_ftrl.BITS, "float32"), 2.0)
    assert quality_ftrl.keep_good(docs, model).exceptAll(docs).count() == 0
    assert quality_ftrl.keep_good(docs, model).count() == docs.count()
    assert quality_ftrl.keep_good(docs, model, 0.95).count() == 0


def test_ftrl_equals_a_plain_loop():
    """Updates and weights by plain Python numbers, one coordinate at a time."""
    rng = random.Random(3)
    examples = []
    for _ in range(30):
        dims = sorted(rng.sample(range(40), rng.randint(1, 8)))
        examples.append((np.array(dims), np.array([rng.uniform(0.2, 3) for _ in dims]), rng.randint(0, 1)))
    alpha, beta, l1, l2 = 0.4, 1.0, 0.02, 0.002
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    order = np.random.default_rng(9)
    for _ in range(2):
        for k in order.permutation(len(examples)):
            dims, value, y = examples[k]
            x = {**dict(zip(dims.tolist(), value.tolist())), "bias": 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - y) * v
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    model = quality_ftrl.ftrl(examples, epochs=2)
    assert math.isclose(model.bias, weight("bias"), abs_tol=1e-9)
    assert all(math.isclose(model.weights[i], weight(i), abs_tol=1e-6) for i in range(40)) and not model.weights[40:].any()


def test_scores_are_sparse_dot_products():
    model = quality_ftrl.Model(np.random.default_rng(1).normal(size=2**quality_ftrl.BITS).astype(np.float32), 0.25)
    texts = ["one two two one two two one two two one", "", "Ünï 12 34", "a " * 50]
    import pyarrow as pa

    block = next(textblocks.blocks(pa.RecordBatch.from_pydict({"text": texts})))
    rows, dims = quality_ftrl.ngrams(block)
    for i, text in enumerate(texts):
        mine = dims[rows == i]
        total = sum(float(model.weights[d]) for d in mine) * quality_ftrl.SCALE / max(1, len(text.split())) + model.bias
        assert math.isclose(quality_ftrl._block_scores(block, model)[i], 1 / (1 + math.exp(-max(-35, min(35, total)))), rel_tol=1e-5)


def test_learning_rows_are_bounded(spark):
    rows = [(f"d{i}", text) for i in range(80) for text in ("x" * 100, "y" * 100)] + [("d1", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    told = spark.createDataFrame([(f"d{i}", i % 2, 0) for i in range(80)], "doc_id string, quality int, toxic int")
    everything = learning_rows(docs, told, "quality", 1000).collect()
    assert len(everything) == len({r.doc_id for r in everything}) == sum(zlib.crc32(f"d{i}".encode()) % 5 != 0 for i in range(80))
    assert len(learning_rows(docs, told, "quality", 10).collect()) == 10
    few = learning_rows(docs, told, "quality", 1000, max_bytes=1050).collect()
    assert 10 <= len(few) <= 12 and {r.doc_id for r in few} <= {r.doc_id for r in everything}
    got = quality_ftrl.quality_scores(docs, told).collect()      # ids need not be numbers
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)


def test_calibrated_scores_follow_the_margin(spark):
    docs = spark.createDataFrame([(i, "you stupid fool " * (i % 4) + "calm words here and there " * 5) for i in range(120)], "doc_id long, text string")
    told = cases.labels(spark, [(i, 0, int(i % 4 > 1)) for i in range(120)])
    model = toxicity.train(docs, told)
    margins = model.trees.transform(toxicity.features(docs, model.lexicons, "doc_id")).select("doc_id", toxicity._margin()).collect()
    scores = {r.doc_id: r.score for r in toxicity.toxicity(docs, told).collect()}
    ordered = [scores[r.doc_id] for r in sorted(margins, key=lambda r: r.margin)]
    assert all(a <= b + 1e-12 for a, b in zip(ordered, ordered[1:]))
