"""Quality classifier: hashed word n-grams, logistic regression, follow-the-regularised-leader.

A document is the mean of its n-grams' indicator vectors in ``2 ** BITS`` hashed dimensions:
words, word pairs, word shapes, shape pairs, "same word as before" and "four words seen before
in this text".  The score is the logistic of a sparse dot product, computed for every whole
text in numpy blocks.  Weights come from FTRL-proximal updates over a bounded sample of
labelled rows (``MAX_DOCS``, ``MAX_BYTES``); per-coordinate steps and an L1 term keep them sparse.

Nulls and empty texts have no n-grams and score the logistic of the bias; with no usable
label (an empty table, one class) every score is the share of label 1, or 0.5 without any.
Other columns are never read; one result per input row, repeated rows included.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from . import textblocks as tb
from .shipping import map_arrow
from .tables import held_out, learning_rows

BITS = 18
MAX_DOCS = 4000
MAX_BYTES = 64 << 20          # of their texts, which bounds the vectors on the driver
EPOCHS = 4
SCALE = 24.0
THRESHOLD = 0.3


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def ngrams(block: tb.Block) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashed dimension) of every n-gram of the block, ordered by row within each kind."""
    w = tb.words(block, tb.NOT_SPACE)
    if not len(w.start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = tb.range_hash(tb.prefix_sums(block.buf), w.start, w.end)
    shape = tb.shape_hashes(block, w)
    kinds = [(w.doc, word), (w.doc, shape ^ tb.U64(0xA5A5A5A5))]
    same = w.doc[1:] == w.doc[:-1]
    for one in (word, shape + tb.U64(1)):
        kinds.append((w.doc[1:][same], tb.pair_hash(one[:-1], one[1:])[same]))
    again = same & (word[1:] == word[:-1])
    kinds.append((w.doc[1:][again], np.full(again.sum(), 7, tb.U64)))
    if len(word) >= 4:
        two = tb.pair_hash(word[:-1], word[1:])
        four = tb.pair_hash(two[:-2], two[2:])
        inside = w.doc[3:] == w.doc[:-3]
        doc, four = w.doc[:-3][inside], four[inside]
        keyed = tb.pair_hash(four, doc.astype(tb.U64))
        order = np.argsort(keyed, kind="stable")
        seen = np.zeros(len(keyed), bool)
        seen[order[1:]] = keyed[order][1:] == keyed[order][:-1]
        kinds.append((doc[seen], np.full(seen.sum(), 11, tb.U64)))
    rows = np.concatenate([k[0] for k in kinds])
    dims = np.concatenate([tb.mix(k[1] + tb.U64(i)) >> tb.U64(64 - BITS) for i, k in enumerate(kinds)])
    return rows, dims.astype(np.int64)


def counts(block: tb.Block) -> np.ndarray:
    w = tb.words(block, tb.NOT_SPACE)
    return np.maximum(np.diff(w.first), 1)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in tb.blocks(batch):
            rows, dims = ngrams(block)
            key, number = np.unique(rows << BITS | dims, return_counts=True)
            cut = np.searchsorted(key >> BITS, np.arange(block.n + 1))
            value = number / counts(block)[key >> BITS] * SCALE
            lists = lambda v, t: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(v, t))
            yield pa.RecordBatch.from_arrays(
                [block.rows.column("doc_id"), block.rows.column("y"),
                 lists(key & (2**BITS - 1), pa.int32()), lists(value, pa.float32())], ["doc_id", "y", "dims", "value"])


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, alpha: float = 0.4, beta: float = 1.0,
         l1: float = 0.02, l2: float = 0.002) -> Model:
    """FTRL-proximal over the examples in a fixed random order."""
    z, n = np.zeros(2**BITS + 1), np.zeros(2**BITS + 1)

    def weights(at):
        zi = z[at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    rng = np.random.default_rng(9)
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            dims, value, y = examples[i]
            at = np.append(dims, 2**BITS)     # the last place is the bias
            x = np.append(value, 1.0)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(2**BITS + 1))
    return Model(w[:-1].astype(np.float32), float(w[-1]))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = MAX_DOCS, max_bytes: int = MAX_BYTES) -> Model:
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = map_arrow(learning_rows(docs, labels, label, limit, max_bytes).select("doc_id", "y", "text"), _vectors,
                     f"doc_id {kind}, y int, dims array<int>, value array<float>").toArrow()
    rows = rows.sort_by("doc_id").combine_chunks()   # arrival order must not matter
    y = rows["y"].to_numpy()
    examples = [(d.values.to_numpy().astype(np.int64), v.values.to_numpy().astype(float), int(t))
                for d, v, t in zip(rows["dims"], rows["value"], y, strict=True)]
    if len(set(y.tolist())) < 2:
        share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
        return Model(np.zeros(2**BITS, np.float32), float(np.log(share / (1 - share))))
    return ftrl(examples)


def _block_scores(block: tb.Block, model: Model) -> np.ndarray:
    rows, dims = ngrams(block)
    total = np.bincount(rows, model.weights[dims], block.n) * SCALE / counts(block) + model.bias
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch):
                yield pa.RecordBatch.from_arrays([*block.rows.columns, pa.array(_block_scores(block, model))],
                                                 [*block.rows.schema.names, "score"])

    return score


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` (doc_id and text among them) and ``score``; a ``score`` there is replaced."""
    docs = docs.drop("score")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    return map_arrow(docs, _scorer(model), schema)


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or above, as they are."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tb.blocks(batch):
                yield block.rows.filter(pa.array(_block_scores(block, model) >= threshold))

    return map_arrow(docs, keep, docs.schema)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
