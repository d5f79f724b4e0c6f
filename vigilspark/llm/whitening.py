"""Embedding whitening with MLlib block matrices.

Rows are centred, numbered and gathered into distributed blocks.  The scatter matrix is the
blocks' transpose multiplied by the blocks, split along the rows so that one task multiplies a
bounded number of blocks; its eigenvectors are found on the driver (dimensions squared, whatever
the number of rows).  The whitening matrix then projects the blocks by a second multiplication.
For that one the blocks stand in a square grid, each column of the grid above its own copy of the
whitening matrix: MLlib deals out a product by a grid, and a tall one gets only the square root of
the partitions.

Entries become integers first, so sums and deviations are exact.  Rows whose vector is null or
holds a null, NaN or infinite entry are left out, and so are vectors whose length is not the
commonest one (the longer one among equally common lengths).  Repeated rows and rows without an id
count each.  An entry beyond 2**52 / 1024 in size is taken as that bound.  A deviation beyond a
long is null.  A component whose eigenvalue is no more than ``RANK`` of the largest has no
whitened value (null) and no part in the identity error; without variance ``explained`` and the
identity error are null.  An empty table, or one of empty vectors, gives no rows; other columns
are never read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from .tables import stored

COMPONENTS = 8
SCALE, SHIFT, LARGEST = 1024.0, 100_000, 2.0**52
RANK = 1e-12
#: Rows of a block: as many as keep the list of blocks short, within bytes that a task can hold.
LEAST_ROWS, MOST_BLOCKS, BLOCK_BYTES, TASK_BYTES = 1024, 20_000, 32 << 20, 64 << 20
RESULT = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Fit:
    """``n`` vectors with sums ``total`` (exact); eigenvalues falling, eigenvectors as columns."""

    n: int
    total: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def matrix(self, components: int) -> np.ndarray:
        """Centred rows times this are whitened; columns of no variance are zero."""
        values, vectors = self.values[:components], self.vectors[:, :components]
        full = self.full(components)
        return np.where(full, vectors / np.sqrt(np.where(full, values, 1.0)), 0.0)

    def full(self, components: int) -> np.ndarray:
        return self.values[:components] > max(RANK * self.values[0], 0.0)


def integers(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the usable vectors, all of one length."""
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < math.inf))
    rows = embeddings.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where(v.isNotNull() & finite)
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    bound = lambda c: F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))
    x = F.transform(v, lambda c: F.floor(bound(c)).cast("long") + F.lit(SHIFT).cast("long"))
    return rows.where(F.size("v") == (length["d"] if length else 0)).where(F.size("v") > 0).select("vec_id", x.alias("x"))


def _sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension: one row a dimension reaches the driver."""
    sums = (rows.select(F.posexplode("x").alias("i", "c")).groupBy("i")
            .agg(F.count("*").alias("n"), F.sum(F.col("c").cast("decimal(20,0)")).alias("s")).orderBy("i").collect())
    return (sums[0]["n"], [int(r["s"]) for r in sums]) if sums else (0, [])


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in values])


def centred(n: int, total: list[int]) -> Column:
    """x - S/n as doubles: whole numbers first, so that nothing cancels."""
    rest = F.array(*[F.lit(s % n / n) for s in total])
    return F.zip_with(F.zip_with("x", _longs([s // n for s in total]), lambda x, m: x - m), rest, lambda x, r: x.cast("double") - r)


def deviation(n: int, total: list[int]) -> Column:
    """Sum over dimensions of (n * x - S) squared, in longs; null beyond their range."""
    far = F.zip_with(F.zip_with("x", _longs([s // n for s in total]), lambda x, m: F.try_multiply(x - m, F.lit(n).cast("long"))),
                     _longs([s % n for s in total]), F.try_subtract)
    return F.aggregate(far, F.lit(0).cast("long"), lambda a, t: F.try_add(a, F.try_multiply(t, t)))


def _block_rows(n: int, d: int) -> int:
    return max(1, min(max(LEAST_ROWS, -(-n // MOST_BLOCKS)), BLOCK_BYTES // (8 * d)))


def _blocks(numbered: DataFrame, n: int, total: list[int]) -> BlockMatrix:
    """The centred rows as a tall block matrix, one block across."""
    rows = numbered.select(F.col("row").alias("index"), array_to_vector(centred(n, total)).alias("vector"))
    matrix = callMLlibFunc("createIndexedRowMatrix", MLUtils.convertVectorColumnsFromML(rows, "vector"), n, len(total))
    return IndexedRowMatrix(matrix).toBlockMatrix(_block_rows(n, len(total)), len(total))


def _tasks(n: int, d: int) -> int:
    """Tasks over which a multiplication is spread, so that one holds TASK_BYTES of blocks."""
    rows = _block_rows(n, d)
    return max(1, -(-n // (rows * max(1, TASK_BYTES // (2 * 8 * d * rows)))))


def _scatter(blocks: BlockMatrix, n: int, d: int) -> np.ndarray:
    product = blocks.transpose()._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, _tasks(n, d))
    return BlockMatrix(product, d, d).toLocalMatrix().toArray()


def fit(blocks: BlockMatrix, n: int, total: list[int]) -> Fit:
    covariance = _scatter(blocks, n, len(total)) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")
    return Fit(n, total, np.maximum(values[order], 0.0), vectors[:, order], float(np.trace(covariance)))


def _moved(matrix: BlockMatrix, place: tuple[Column, Column], rows: int, cols: int, shape: tuple[int, int]) -> BlockMatrix:
    """The same blocks at other places of the grid."""
    frame = callMLlibFunc("getMatrixBlocks", matrix._java_matrix_wrapper._java_model).toDF("at", "block")
    at = F.struct(place[0].cast("long").alias("i"), place[1].cast("long").alias("j"))
    return BlockMatrix(callMLlibFunc("createBlockMatrix", frame.select(at.alias("at"), "block"), rows, cols, *shape), rows, cols)


def project(blocks: BlockMatrix, whitening: np.ndarray, n: int) -> DataFrame:
    """(row, w) for every row of ``blocks``: the product with ``whitening``."""
    spark, (d, k) = blocks.blocks.ctx, whitening.shape
    rows = blocks.rowsPerBlock
    high = math.ceil(n / rows)
    side = math.isqrt(high - 1) + 1                     # blocks of a column of the square grid
    across = -(-high // side)
    block = F.col("at._1")
    square = _moved(blocks, (block % side, F.floor(block / side)), rows, d, (side * rows, across * d))
    one = DenseMatrix(d, k, whitening.ravel(order="F"))
    copies = spark.parallelize(range(across), max(1, _tasks(n, d))).map(lambda j: ((j, j), one))
    product = square.multiply(BlockMatrix(copies, d, k))
    tall = _moved(product, (F.col("at._2") * side + block, F.lit(0)), rows, k, (n, k))
    found = callMLlibFunc("getIndexedRows", tall.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return found.select(F.col("index").alias("row"), vector_to_array("vector").alias("w"))


def _identity_error(whitened: DataFrame, full: np.ndarray) -> float | None:
    """Largest entry of the covariance of the whitened rows less the identity; sums only reach the driver."""
    used = [i for i in range(len(full)) if full[i]]
    if not used:
        return None
    mean = whitened.agg(*[F.avg(F.col("w")[i]).alias(f"m{i}") for i in used]).first()
    pairs = [(i, j) for i in used for j in used if i <= j]
    moment = whitened.agg(*[F.avg((F.col("w")[i] - mean[f"m{i}"]) * (F.col("w")[j] - mean[f"m{j}"])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(moment[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(embeddings: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, Fit | None]:
    """(vec_id, deviation, w: one value a component) of every usable row, stored, and what was fitted.

    ``w`` is null where a component has no variance.  There are no more components than dimensions.
    """
    spark = embeddings.sparkSession
    numbered = number_rows(integers(embeddings, key, vector), "row", start=-1)
    n, total = _sums(numbered)
    if not n:
        return numbered.select("vec_id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("w")).limit(0), None
    blocks = _blocks(numbered, n, total)
    fitted = fit(blocks, n, total)
    k = min(components, len(total))
    full = fitted.full(k)
    there = F.array(*[F.lit(bool(f)) for f in full])
    w = F.zip_with("w", there, lambda v, f: F.when(f, v))
    rows = numbered.select("row", "vec_id", deviation(n, total).alias("deviation"))
    out = rows.join(project(blocks, fitted.matrix(k), n), "row").select("vec_id", "deviation", w.alias("w"))
    return stored(out, "whitened"), fitted


def report(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row for each usable vector and component."""
    whitened, fitted = whiten(embeddings, components)
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], RESULT.format(id=kind))
    k = min(components, len(fitted.total))
    error = _identity_error(whitened, fitted.full(k))
    share = F.array(*[F.lit(float(v / fitted.trace) if fitted.trace > 0 else None).cast("double") for v in fitted.values[:k]])
    rows = whitened.select("vec_id", "deviation", F.posexplode("w").alias("_i", "whitened"))
    return rows.select("vec_id", (F.col("_i") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation",
                       "whitened", share[F.col("_i")].alias("explained"), F.lit(error).cast("double").alias("identity_error"))
