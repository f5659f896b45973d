"""Embedding whitening with distributed block matrices.

Entries become whole numbers (``floor(64 * c) + 1000000``). The fit list holds each
distinct vector once, numbered without gaps. Its sums are exact, so that rows are centred
before anything is multiplied: ``(n * x - S) / n`` from the whole number ``n * x - S``.
The centred rows, cut into blocks, are multiplied with their transpose; the scatter
matrix has a side as long as a vector, and its eigenvectors are found on the driver.
Multiplying the blocks by the whitening matrix projects every distinct vector
once, and rows take the projection of their vector.

Defined results: rows whose vector is null or empty, holds a null, NaN, infinite or
too large entry (64 times it beyond 2**52), or has another length than most
vectors (ties: the longer) are dropped; null ids, equal ids and repeated rows keep a row
each; components without variance are left out; without rows, or when all vectors are
equal, the result is empty; other columns are ignored. A deviation beyond 64 bits
is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallycheck.llm.common import numbered, written


@dataclass(frozen=True)
class Fit:
    """``n`` distinct vectors, their ``sums``, and of the components by falling
    variance: ``variances``, unit ``vectors`` (columns) and ``explained`` shares.
    ``identity_error``: how far the whitened vectors' covariance is from the identity."""

    n: int
    sums: np.ndarray
    variances: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float


def _whole(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(64 * c.cast("double")) + F.lit(1_000_000).cast("long"))


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) > 2.0**46))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def product(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """``left`` times ``right``; the inner dimension is dealt to ``splits`` times as
    many tasks as the product has blocks, so that a small product of long
    matrices isn't computed in one task."""
    found = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(found, left.rowsPerBlock, right.colsPerBlock)


def _scatter(rows: BlockMatrix) -> np.ndarray:
    """The rows' transpose times the rows: as many entries as a vector's length squared."""
    splits = -(-rows.numRows() // rows.rowsPerBlock)
    return product(rows.transpose(), rows, splits).toLocalMatrix().toArray()


def _by_index(matrix: BlockMatrix) -> DataFrame:
    """(index, vector) of the rows, kept in the JVM."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select("index", vector_to_array(F.col("vector")).alias("whitened"))


def whiten(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 16,
           block_entries: int = 1 << 20) -> tuple[DataFrame, Fit | None]:
    """A row per usable vector: row, id, deviation (sum of ``(n * x - S) ** 2``) and
    whitened (up to ``most`` components); and the fit."""
    spark = vectors.sparkSession
    rows = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                          F.col(vector_col).alias("vector")).filter(_usable(F.col("vector")))
    rows = written(rows.select("row", "id", _whole(F.col("vector")).alias("x")))
    lengths = rows.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    none = rows.select("row", "id", F.lit(0).cast("long").alias("deviation"), F.array().cast("array<double>").alias("whitened")).limit(0)
    if lengths is None:
        return none, None
    d = lengths["length"]
    rows = rows.filter(F.size("x") == d)
    distinct = numbered(rows.select("x").distinct(), "index")
    sums = (distinct.select(F.posexplode("x").alias("at", "v")).groupBy("at")
            .agg(F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")).orderBy("at").collect())
    n, s = sums[0]["n"], [r["s"] for r in sums]

    off = F.zip_with("x", F.lit(s).cast("array<bigint>"), lambda x, y: n * x - y)
    centred = distinct.select("index", array_to_vector(F.transform(off, lambda v: v.cast("double") / n)).alias("vector"))
    block = max(1, block_entries // d)
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(centred, "vector"), n, d).toBlockMatrix(block, d)
    covariance = _scatter(matrix) / n
    e, v = np.linalg.eigh((covariance + covariance.T) / 2)
    e, v = e[::-1], v[:, ::-1]
    k = int((e[:most] > max(e[0], 0) * d * np.finfo(float).eps).sum())
    if not k:
        return none, None
    scaled = v[:, :k] / np.sqrt(e[:k])
    project = spark.sparkContext.parallelize([((0, 0), Matrices.dense(d, k, scaled.ravel(order="F")))])
    whitened = matrix.multiply(BlockMatrix(project, d, k, d, k))
    error = float(np.abs(_scatter(whitened) / n - np.eye(k)).max())
    fit = Fit(n, np.array(s), e[:k], v[:, :k], e[:k] / np.trace(covariance), error)

    deviation = F.aggregate(off, F.lit(0).cast("long"), lambda a, x: a + x * x)
    found = distinct.withColumn("deviation", deviation).join(_by_index(whitened), "index")
    found = found.select(F.col("x").alias("vector"), "deviation", "whitened")
    return rows.join(found, F.col("x") == F.col("vector")).select("row", "id", "deviation", "whitened"), fit

