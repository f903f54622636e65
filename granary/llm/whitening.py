"""Whitening of embeddings with distributed block matrices.

Rows are numbered, centred exactly and turned into an MLlib BlockMatrix. Its
transpose times itself is the scatter matrix, whose eigenvectors, divided by the
roots of the eigenvalues, form the whitening matrix: dimensions by components,
small enough for one machine. A second block product projects the rows. The
projection's own covariance, taken the same way, tells how far from the identity
it is.

The middle dimension of the scatter, the rows, is split into many partial
products, which are added up; with a single split all blocks would meet in one
task, since the product has only one block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import ranked, stage

RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
WIDE = "decimal(38,0)"


@dataclass(frozen=True)
class Settings:
    """``scale``, ``offset``: an entry c becomes floor(scale * c) + offset.

    ``numbers``: most numbers in a block, ``blocks``: blocks whose products are
    added up in one task; ``floor``: least eigenvalue kept, as a share of the
    largest.
    """

    components: int = 32
    scale: int = 64
    offset: int = 1_000_000
    numbers: int = 1 << 16
    blocks: int = 16
    floor: float = 1e-11

    def rows(self, size: int) -> int:
        return max(1, self.numbers // size)


def usable(vectors: DataFrame, use: Settings) -> DataFrame:
    """``vec_id, x``: the vectors that take part, as whole numbers."""
    scaled = F.transform("embedding", lambda c: F.lit(float(use.scale)) * c.cast("double"))
    fine = F.forall("s", lambda c: c.isNotNull() & (F.abs(c) < 2.0**62)) & (F.size("s") > 0)
    kept = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("s")).filter(F.coalesce(fine, F.lit(False)))
    kept = kept.select("vec_id", F.transform("s", lambda c: F.floor(c) + F.lit(use.offset).cast("long")).alias("x"))
    sizes = kept.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return kept.filter(F.size("x") == (sizes["size"] if sizes else 0))


def block_matrix(rows: DataFrame, count: int, size: int, use: Settings) -> BlockMatrix:
    """``rows(index, values)`` as blocks of some rows and all columns; rows stay in the JVM."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("values").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, count, size).toBlockMatrix(use.rows(size), size)


def times(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """``left`` times ``right``, the middle dimension in ``splits`` parts; Python's own ``multiply`` cannot pass that number on."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def covariance(rows: DataFrame, count: int, size: int, use: Settings) -> np.ndarray:
    """Covariance with divisor ``count`` of centred ``rows(index, values)``; only size x size numbers reach the driver."""
    matrix = block_matrix(rows, count, size, use)
    return times(matrix.transpose(), matrix, -(-matrix.numRowBlocks // use.blocks)).toLocalMatrix().toArray() / count


def axes(cov: np.ndarray, use: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of the components that can be whitened, at most ``use.components``."""
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(-values, kind="stable")[: use.components]
    kept = [i for i in order if values[i] > max(use.floor * values.max(), 0.0)]
    return values[kept], vectors[:, kept]


def projected(rows: DataFrame, count: int, weights: np.ndarray, use: Settings) -> DataFrame:
    """``index, z``: the rows of ``rows(index, values)`` times ``weights``."""
    spark, (size, wide) = rows.sparkSession, weights.shape
    height = use.rows(size)
    right = DenseMatrix(size, wide, weights.ravel(order="F"))
    blocks = BlockMatrix(spark.sparkContext.parallelize([((0, 0), right)], 1), size, wide, size, wide)
    product = times(block_matrix(rows, count, size, use), blocks)

    def lines(block):
        (i, _), values = block
        return [(i * height + k, line) for k, line in enumerate(values.toArray().tolist())]

    return spark.createDataFrame(product.blocks.flatMap(lines), "index long, z array<double>")


def by_dimension(rows: DataFrame, column: str, what) -> list:
    """``what`` of each dimension of an array column, in order; one value a dimension and task is shuffled."""
    each = rows.select(F.posexplode(column).alias("at", "value"))
    return [row["of"] for row in each.groupBy("at").agg(what(F.col("value")).alias("of")).orderBy("at").collect()]


def whiten(vectors: DataFrame, use: Settings = Settings()) -> DataFrame:
    """The columns of ``RESULT`` for each row of ``vectors(vec_id, embedding, ...)`` that takes part, and each component.

    A vector takes no part if it is NULL or empty, holds NULL or non-finite
    entries or one that is 2^62 or more when scaled, or has another length than
    the commonest (of several, the smallest). Rows count one by one, repeated
    ids and NULL ids included. ``deviation`` is NULL if it does not fit into a
    long. There are as many components as there are dimensions with variance,
    32 at most: where all vectors are equal, none, and no rows. Eigenvalues of
    less than 1e-11 of the largest are taken for zero, since rounding hides them.
    """
    spark = vectors.sparkSession
    numbered = ranked(usable(vectors, use).withColumn("g", F.lit(0)), "g", [], "whitening-rows").select("vec_id", "x", F.col("rank").alias("index"))
    head = numbered.select(F.size("x").alias("size")).first()
    if head is None:
        return spark.createDataFrame([], RESULT)
    size = head["size"]
    count = numbered.count()
    totals = by_dimension(numbered, "x", lambda x: F.sum(x.cast("decimal(28,0)")))
    sums = F.array(*[F.lit(str(total)).cast(WIDE) for total in totals])
    # n * x - S is whole, so centring is exact; one division then rounds once.
    moved = F.zip_with("x", sums, lambda x, s: (x.cast(WIDE) * F.lit(count).cast(WIDE) - s).cast(WIDE))
    squares = F.aggregate("moved", F.lit(0).cast(WIDE), lambda a, d: F.try_add(a, F.try_multiply(d, d)).cast(WIDE))
    exact = numbered.select("index", "vec_id", moved.alias("moved"))
    exact = exact.select("index", "vec_id", squares.try_cast("long").alias("deviation"), F.transform("moved", lambda d: d.cast("double") / F.lit(float(count))).alias("values"))
    exact = stage(exact, "whitening-centred")

    cov = covariance(exact, count, size, use)
    values, vectors_ = axes(cov, use)
    if not len(values):
        return spark.createDataFrame([], RESULT)
    white = stage(projected(exact, count, vectors_ / np.sqrt(values), use), "whitening-projected")
    centre = F.array(*[F.lit(float(m)) for m in by_dimension(white, "z", F.avg)])
    inner = white.select("index", F.zip_with("z", centre, lambda z, m: z - m).alias("values"))
    error = float(np.abs(covariance(inner, count, len(values), use) - np.eye(len(values))).max())

    explained = F.array(*[F.lit(float(v / np.trace(cov))) for v in values])
    rows = exact.select("index", "vec_id", "deviation").join(white, "index")
    each = rows.select("vec_id", "deviation", F.posexplode(F.arrays_zip(F.col("z").alias("z"), explained.alias("e"))).alias("at", "c"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(count).cast("long").alias("n"), "deviation",
        F.col("c.z").alias("whitened"), F.col("c.e").alias("explained"), F.lit(error).alias("identity_error"),
    )
