"""Whitened principal components of embeddings by distributed block matrices.

Entries become whole numbers ``floor(scale * c)``, so equal vectors are equal for certain. Every distinct vector counts
once in the fit. Centred rows are indexed into a ``BlockMatrix``; its transpose times itself, with the middle dimension
split over the cluster, is the scatter matrix, the only thing of which the driver sees all: d x d numbers for vectors
of d entries. ``eigh`` of it gives the whitening matrix, and a second multiplication by that projects every row.

A row whose vector is null or holds a null, NaN or infinite entry is left out. Shorter vectors count as ending in zeros.
Rows that repeat an id or a vector each give their own rows, equal vectors with equal values; a null id stays null. A
component without variance has a null ``whitened``; if no component has any, ``explained`` is null too and
``identity_error`` is 0. An empty table gives an empty one. ``deviation`` is null where a long cannot hold it.
Columns besides id and vector are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from logtide.scratch import materialize

ROWS_PER_BLOCK = 1024
COLUMNS_PER_BLOCK = 1024
#: Blocks whose products one task adds up.
BLOCKS_PER_TASK = 32
#: The driver holds the place of each block, so blocks hold more rows beyond this many.
MOST_BLOCKS = 65_536


def whole_vectors(rows: DataFrame, scale: float, id_col: str, vector_col: str) -> DataFrame:
    """``(_id, _x)``: vectors of whole numbers, without those that are null or not finite throughout."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return rows.where(F.coalesce(fine, F.lit(False))).select(
        F.col(id_col).alias("_id"), F.transform(v, lambda c: F.floor(c * scale)).alias("_x")
    )


def indexed(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """Written rows with a dense ``_index`` from 0, vectors padded to one length; the number of rows, and that length."""
    written = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "vectors")
    part = F.shiftright("_row", 33)
    parts = written.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_x")).alias("d"))
    found = sorted((r["part"], r["n"], r["d"]) for r in parts.collect())  # one entry for each task that wrote
    before = np.cumsum([0] + [n for _, n, _ in found])
    d = max((d for *_, d in found), default=0)
    offsets = rows.sparkSession.createDataFrame([(p, int(b)) for (p, *_), b in zip(found, before)], "_part long, _before long")
    padded = F.concat("_x", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("_x")))
    placed = written.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(
        "_id", padded.alias("_x"), (F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before")).alias("_index")
    )
    return placed, int(before[-1]), d


def block_matrix(rows: DataFrame, vector: Column, n: int, d: int) -> BlockMatrix:
    """The rows' vectors as lines ``_index`` of an n x d matrix; lines without a row are zero.

    A block's lines meet in one row of flat numbers, so Python sees a row for each block.
    """
    height, width = max(ROWS_PER_BLOCK, -(-n // MOST_BLOCKS)), min(d, COLUMNS_PER_BLOCK)
    line = F.struct((F.col("_index") % height).cast("int").alias("at"), vector.alias("v"))
    grouped = rows.groupBy(F.floor(F.col("_index") / height).alias("block")).agg(F.collect_list(line).alias("lines"))  # at most `height`
    flat = grouped.select("block", F.col("lines.at").alias("at"), F.flatten("lines.v").alias("v"))

    def blocks(r: Row) -> Iterator[tuple[tuple[int, int], DenseMatrix]]:
        full = np.zeros((min(height, n - r["block"] * height), d))
        full[r["at"]] = np.reshape(r["v"], (-1, d))
        for j, left in enumerate(range(0, d, width)):
            part = full[:, left : left + width]
            yield (r["block"], j), DenseMatrix(*part.shape, part.ravel(order="F"))

    return BlockMatrix(flat.rdd.flatMap(blocks), height, width, n, d)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The matrix's transpose times the matrix, products of ``BLOCKS_PER_TASK`` blocks added up in a task each."""
    splits = max(1, -(-matrix.numRowBlocks // BLOCKS_PER_TASK))
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def projected(matrix: BlockMatrix, weights: np.ndarray, spark: SparkSession) -> DataFrame:
    """``(_index, _z)``: each line times ``weights``, d x k numbers."""
    size, height, k = matrix.colsPerBlock, matrix.rowsPerBlock, weights.shape[1]
    parts = [((j, 0), weights[at : at + size]) for j, at in enumerate(range(0, len(weights), size))]
    right = [(place, DenseMatrix(len(w), k, w.ravel(order="F"))) for place, w in parts]
    product = matrix.multiply(BlockMatrix(spark.sparkContext.parallelize(right, 1), size, k))
    flat = product.blocks.map(lambda b: (b[0][0], b[1].toArray().ravel().tolist()))
    blocks = spark.createDataFrame(flat, "block long, v array<double>")
    lines = F.transform(F.sequence(F.lit(0), (F.size("v") / k).cast("int") - 1), lambda i: F.slice("v", i * k + 1, F.lit(k)))
    return blocks.select("block", F.posexplode(lines)).select((F.col("block") * height + F.col("pos")).alias("_index"), F.col("col").alias("_z"))


@dataclass
class Whitening:
    """Sums over ``n`` distinct vectors, eigenvalues in falling order, and one whitening column for each that isn't zero."""

    n: int
    sums: list[int]
    greatest: int
    values: np.ndarray
    weights: np.ndarray

    def centred(self) -> Column:
        mean = F.lit([s / self.n for s in self.sums])
        return F.zip_with("_x", mean, lambda x, m: x.cast("double") - m)

    def deviation(self) -> Column:
        """Sum of ``(n * x - S) ** 2``, in whole numbers throughout."""
        kind = "decimal(38,0)"
        if (self.n * self.greatest + max(map(abs, self.sums), default=0)) ** 2 * max(len(self.sums), 1) < 1 << 63:
            kind = "bigint"
        sums = F.array(*[F.lit(str(s)).cast(kind) for s in self.sums])
        n = F.lit(str(self.n)).cast(kind)
        apart = F.zip_with("_x", sums, lambda x, s: F.try_subtract(F.try_multiply(x.cast(kind), n), s).try_cast(kind))
        total = F.aggregate(apart, F.lit(0).cast(kind), lambda a, v: F.try_add(a, F.try_multiply(v, v)).try_cast(kind))
        return total.try_cast("bigint")


def fit_whitening(distinct: DataFrame, n_lines: int, d: int, components: int) -> Whitening:
    """From distinct vectors ``_x`` at lines ``_index``."""
    half = F.posexplode("_x").alias("k", "x")
    sums = distinct.select(half).groupBy("k").agg(  # two halves, so that no sum overflows
        F.count(F.lit(1)).alias("n"), F.sum(F.shiftright("x", 32)).alias("high"),
        F.sum(F.col("x").bitwiseAND(F.lit((1 << 32) - 1))).alias("low"), F.min("x").alias("least"), F.max("x").alias("most"),
    )
    found = sorted(tuple(r) for r in sums.collect())  # d rows
    model = Whitening(
        found[0][1], [(high << 32) + low for _, _, high, low, _, _ in found],
        max(max(abs(r[4]), abs(r[5])) for r in found), np.zeros(d), np.zeros((d, 0)),
    )
    spread = scatter(block_matrix(distinct, model.centred(), n_lines, d)) / model.n
    values, vectors = np.linalg.eigh((spread + spread.T) / 2)
    model.values = np.maximum(values[::-1], 0)
    live = int((model.values[:components] > model.values.sum() * d * 1e-15).sum())
    model.weights = vectors[:, ::-1][:, :live] / np.sqrt(model.values[:live])
    return model


def identity_error(lines: DataFrame, k: int) -> float:
    """Greatest absolute entry of the covariance of ``_z`` minus the identity, centred first."""
    if not k:
        return 0.0
    means = lines.agg(*[F.avg(F.col("_z")[j]).alias(f"m{j}") for j in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    products = [F.avg((F.col("_z")[i] - means[i]) * (F.col("_z")[j] - means[j])).alias(f"p{i}_{j}") for i, j in pairs]
    return max(abs(v - (i == j)) for v, (i, j) in zip(lines.agg(*products).first(), pairs))


def whiten(
    rows: DataFrame, components: int = 4, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for each kept row and component."""
    spark = rows.sparkSession
    placed, n_lines, d = indexed(whole_vectors(rows, scale, id_col, vector_col))
    shown = [F.col("_id").alias(id_col), "component", "n", "deviation", "whitened", "explained", "identity_error"]
    if not n_lines or not d:
        kinds = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], f"_id {rows.schema[id_col].dataType.simpleString()}, {kinds}").select(*shown)
    # one line of each vector; copies meet on the map side first
    distinct = materialize(placed.groupBy("_x").agg(F.min("_index").alias("_index")), "distinct-vectors")
    model = fit_whitening(distinct, n_lines, d, components)
    k = model.weights.shape[1]
    if k:
        lines = materialize(projected(block_matrix(placed, model.centred(), n_lines, d), model.weights, spark), "projected")
    else:
        lines = placed.select("_index", F.array().cast("array<double>").alias("_z"))
    error = identity_error(lines.join(distinct.select("_index"), "_index", "left_semi"), k)
    total = float(model.values.sum())
    parts = F.array(*[
        F.struct(
            F.lit(j + 1).alias("component"), (F.col("_z")[j] if j < k else F.lit(None).cast("double")).alias("whitened"),
            F.lit(float(model.values[j]) / total if total > 0 else None).cast("double").alias("explained"),
        )
        for j in range(min(components, d))
    ])
    kept = placed.select("_id", "_index", model.deviation().alias("deviation"))
    return kept.join(lines, "_index").select("_id", "deviation", F.inline(parts)).select(
        F.lit(model.n).cast("long").alias("n"), F.lit(error).alias("identity_error"), "*"
    ).select(*shown)
