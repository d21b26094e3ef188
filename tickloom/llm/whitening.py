"""Whitening of embeddings by MLlib block matrices.

The centred rows are indexed into distributed blocks; the transpose times the blocks is the scatter matrix,
whose eigenvectors are taken locally (it is as wide as a vector, however many rows there are), and the
blocks times the whitening matrix are the projected rows. The covariance of what came out is measured the
same way. Entries are whole numbers on a grid, so sums and means are exact and centring loses nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import written

GRID, OFFSET = 64, 1_000_000
#: Rows and columns of a block, and how many blocks of a product meet in one task.
BLOCK_ROWS, BLOCK_COLUMNS, MEETING = 1024, 1024, 64
#: Products of the grid beyond this are no longer exact as doubles; such entries count as not finite.
EXACT = float(2**53)

_OUTPUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def _grid_rows(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """The rows that take part, as whole numbers; ``part`` and ``at`` say where each one is stored."""
    usable = f"size({vector}) > 0 AND forall({vector}, c -> c IS NOT NULL AND abs(double(c)) * {GRID} < {EXACT!r})"
    slim = vectors.select(F.col(key).alias("vec_id"), F.col(vector).alias("v")).where(usable.replace(vector, "v"))
    grid = slim.selectExpr("vec_id", f"transform(v, c -> floor(double(c) * {GRID}D) + {OFFSET}L) AS x")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = written(grid.select("*", F.spark_partition_id().alias("part"), at.alias("at")), "whitening-rows")
    widths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    return rows.where(F.size("x") == widths[0].width) if widths else rows


def _indexed(rows: DataFrame) -> DataFrame:
    """``rows`` with gapless row numbers: those of a partition follow those of the partitions before it."""
    counts = rows.groupBy("part").agg((F.max("at") + 1).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition
    starts = counts.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, "part").selectExpr("start + at AS index", "vec_id", "x")


def _blocks(rows: DataFrame, vector: str) -> BlockMatrix:
    """``index`` and an array column as a distributed matrix; nothing passes through Python."""
    dense = rows.select("index", array_to_vector(vector).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(dense, "vector")).toBlockMatrix(BLOCK_ROWS, BLOCK_COLUMNS)


def _scatter(rows: DataFrame, vector: str) -> np.ndarray:
    """The transpose times the matrix; its inner sum is split so that a task holds a bounded number of blocks."""
    blocks = _blocks(rows, vector)
    splits = max(1, -(-blocks.numRowBlocks // MEETING))
    right, turned = blocks._java_matrix_wrapper, blocks.transpose()._java_matrix_wrapper
    product = BlockMatrix(turned.call("multiply", right._java_model, splits), BLOCK_COLUMNS, BLOCK_COLUMNS)
    local = product.toLocalMatrix().toArray()
    return (local + local.T) / 2


def _local_blocks(matrix: np.ndarray, like: DataFrame) -> BlockMatrix:
    height, width = matrix.shape
    parts = [
        ((i // BLOCK_COLUMNS, j // BLOCK_COLUMNS), _dense(matrix[i : i + BLOCK_COLUMNS, j : j + BLOCK_COLUMNS]))
        for i in range(0, height, BLOCK_COLUMNS)
        for j in range(0, width, BLOCK_COLUMNS)
    ]
    blocks = like.sparkSession.sparkContext.parallelize(parts, 1)
    return BlockMatrix(blocks, BLOCK_COLUMNS, BLOCK_COLUMNS, height, width)


def _dense(block: np.ndarray) -> DenseMatrix:
    return DenseMatrix(*block.shape, block.ravel(order="F").tolist())


def whitening_matrix(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors over the roots of their eigenvalues, and each one's share of the trace.

    Largest first, the largest entry of each positive. A component without variance projects to zero.
    """
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(order))])
    trace = np.trace(covariance)
    live = values > max(trace, 0) * 1e-14
    scale = np.where(live, 1 / np.sqrt(np.where(live, values, 1)), 0)
    return vectors * scale, values / trace if trace > 0 else np.zeros(len(order))


def whitened(vectors: DataFrame, components: int = 32, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each vector and component: its whitened coordinate and the figures of the fit.

    Vectors that are null, empty or hold an entry that is null, not finite or 2^53/64 and more take no part, nor
    do those of another width than most (the greater of equally frequent widths). Null and repeated ids are rows like others;
    other columns are not read. A component without variance is 0 in all rows; ``identity_error`` is then that
    of the components with variance. Without vectors there are no rows.
    """
    spark = vectors.sparkSession
    rows = _indexed(_grid_rows(vectors, key, vector))
    entries = rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col"), F.count("*"))
    sums = {at: (total, count) for at, total, count in entries.collect()}  # a row for each dimension
    if not sums:
        return spark.createDataFrame([], _OUTPUT)
    n = sums[0][1]
    whole = [sums[i][0] // n for i in range(len(sums))]
    rest = [sums[i][0] - n * w for i, w in enumerate(whole)]
    near = f"transform(x, (c, i) -> c - array({', '.join(f'{w}L' for w in whole)})[i])"
    exact = rows.selectExpr("index", "vec_id", f"{near} AS c")
    left = f"array({', '.join(f'{r}L' for r in rest)})[i]"
    centred = exact.selectExpr("index", f"transform(c, (c, i) -> c - {left} / {n}D) AS c")
    covariance = _scatter(centred, "c") / n
    matrix, explained = whitening_matrix(covariance, components)
    projected = _blocks(centred, "c").multiply(_local_blocks(matrix, rows)).toIndexedRowMatrix()
    frame = MLUtils.convertVectorColumnsToML(callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model), "vector")
    points = written(frame.select("index", vector_to_array("vector").alias("w")), "whitening-points")
    live = np.abs(matrix).max(0) > 0
    identity = _scatter(points, "w") / n - np.eye(len(explained))
    error = float(np.abs(identity[np.ix_(live, live)]).max()) if live.any() else 0.0
    square = f"transform(c, (c, i) -> CAST({n}L * c - {left} AS DECIMAL(19, 0)))"
    total = "aggregate(s, CAST(0 AS DECIMAL(38, 0)), (a, d) -> CAST(a + d * d AS DECIMAL(38, 0)))"
    figures = exact.selectExpr("index", "vec_id", f"{square} AS s").selectExpr("index", "vec_id", f"CAST({total} AS LONG) AS deviation")
    shares = f"array({', '.join(f'{float(e)!r}D' for e in explained)})"
    return (
        figures.join(points, "index")
        .selectExpr("vec_id", "deviation", "posexplode(w) AS (at, whitened)")
        .selectExpr(
            "CAST(vec_id AS LONG) AS vec_id", "at + 1 AS component", f"{n}L AS n", "deviation", "whitened",
            f"{shares}[at] AS explained", f"{error!r}D AS identity_error",
        )
    )
