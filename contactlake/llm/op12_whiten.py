"""Operator 12: whitening of embeddings with distributed block matrices.

Centred rows are indexed into blocks of a BlockMatrix; its transpose times itself is the
scatter matrix, whose eigenvectors are found locally (dimensions by dimensions); the block
matrix times the whitening matrix projects all rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactlake.llm.common import col, small_batches, staged, table

#: components of a result at most; rows and bytes of one block at most
COMPONENTS, BLOCK_ROWS, BLOCK_BYTES = 32, 4096, 2 << 20
#: blocks that one task multiplies in the scatter product
BLOCKS_PER_TASK = 8
#: eigenvalues below this share of the largest are rounding, not variance
LEAST_SHARE = 1e-12
#: entries are counted in steps of 1 / SCALE from -OFFSET on; larger ones are no numbers here
SCALE, OFFSET, MOST = 64, 1_000_000, float(1 << 40)

_INDEX = T.StructType([T.StructField("i", T.LongType()), T.StructField("j", T.LongType())])
_BLOCK = T.StructType([T.StructField("index", _INDEX), T.StructField("matrix", MatrixUDT())])
_DOUBLES = T.ArrayType(T.DoubleType())
_MATRIX_FIELDS = ["type", "numRows", "numCols", "colPtrs", "rowIndices", "values", "isTransposed"]


def quantised(vector: Column) -> Column:
    """Entries as longs ``floor(64 c) + 1000000``; null for a vector that is null or holds a
    null, a NaN, an infinity or an entry of 2^34 or more in size."""
    entries = F.transform(vector, lambda c: c.cast("double") * SCALE)
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) >= MOST))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)),
                  F.transform(entries, lambda c: F.floor(c).cast("long") + OFFSET))


def deviations(n: int, x: np.ndarray, sums: list[int]) -> tuple[np.ndarray, list[int | None]]:
    """Centred rows ``(n x - S) / n`` rounded once, and per row the exact sum of ``(n x - S)^2``
    (None beyond a 64-bit number)."""
    if n * max(int(np.abs(x).max(initial=0)), 1) < 1 << 61:
        away = n * x - np.array(sums, np.int64)
        most = int(np.abs(away).max(initial=0))
    else:
        away = n * x.astype(object) - np.array(sums, object)
        most = max(map(abs, away.ravel().tolist()), default=0)
    if most * most * max(1, x.shape[1]) < 1 << 63:
        square = (away * away).sum(axis=1).tolist()
    else:
        square = [sum(v * v for v in row) for row in away.tolist()]
    return (away / n).astype(np.float64), [s if s < 1 << 63 else None for s in square]


def _blocks(fit: DataFrame, n: int, sums: list[int], rows: int) -> DataFrame:
    """``(part, seq, rows, deviation, centred)``: every task's rows in blocks of ``rows``, the
    last one filled up with zeros, which add nothing to a scatter. Nothing is shuffled."""
    d = len(sums)
    kind = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("seq", T.LongType()),
        T.StructField("rows", T.ArrayType(fit.schema["row"].dataType)),
        T.StructField("deviation", T.ArrayType(T.LongType())), T.StructField("centred", _DOUBLES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held, size, seq = [], 0, 0

        def block(table: pa.Table) -> pa.RecordBatch:
            x = table.column(1).combine_chunks().flatten()
            centred, square = deviations(n, x.to_numpy(zero_copy_only=False).reshape(-1, d), sums)
            flat = np.zeros(rows * d)
            flat[:centred.size] = centred.ravel()
            took = table.column(0).combine_chunks()
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([seq]), pa.ListArray.from_arrays(pa.array([0, len(took)], pa.int32()), took),
                 pa.array([square], pa.list_(pa.int64())),
                 pa.ListArray.from_arrays(pa.array([0, rows * d], pa.int32()), pa.array(flat))],
                ["part", "seq", "rows", "deviation", "centred"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            while size >= rows:
                whole = pa.Table.from_batches(held)
                yield block(whole.slice(0, rows))
                held, size, seq = whole.slice(rows).to_batches(), size - rows, seq + 1
        if size:
            yield block(pa.Table.from_batches(held))

    return fit.mapInArrow(run, kind)


def _matrix(blocks: DataFrame, first: np.ndarray, rows: int, d: int) -> BlockMatrix:
    """The block matrix of the blocks; ``first`` is the number of each part's first block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k = b.num_rows
            at = first[b.column(0).to_numpy()] + b.column(1).to_numpy()
            none = pa.nulls(k, pa.list_(pa.int32()))
            matrix = pa.StructArray.from_arrays(  # a dense matrix, written row by row
                [pa.array(np.ones(k, np.int8)), pa.array(np.full(k, rows, np.int32)), pa.array(np.full(k, d, np.int32)),
                 none, none, b.column(2), pa.array(np.ones(k, bool))], _MATRIX_FIELDS)
            index = pa.StructArray.from_arrays([pa.array(at), pa.array(np.zeros(k, np.int64))], ["i", "j"])
            yield pa.RecordBatch.from_arrays([index, matrix], ["index", "matrix"])

    made = blocks.select("part", "seq", "centred").mapInArrow(run, _BLOCK)
    total = int(first[-1])
    # what BlockMatrix(rdd, ...) calls, without sending the entries through Python objects
    return BlockMatrix(callMLlibFunc("createBlockMatrix", made, rows, d, total * rows, d), rows, d)


def _times(a: BlockMatrix, b: BlockMatrix, splits: int) -> BlockMatrix:
    """The product, its middle dimension dealt over ``splits`` groups of blocks."""
    got = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(got, a.rowsPerBlock, b.colsPerBlock)


def _local(spark: SparkSession, values: np.ndarray) -> BlockMatrix:
    """A small matrix as one block."""
    df = spark.createDataFrame([((0, 0), Matrices.dense(*values.shape, values.ravel("F").tolist()))], _BLOCK)
    r, c = values.shape
    return BlockMatrix(callMLlibFunc("createBlockMatrix", df, r, c, r, c), r, c)


def _projected(product: BlockMatrix, first: np.ndarray, rows: int, k: int) -> DataFrame:
    """``(part, seq, w)``: per block the projected rows."""
    kind = T.StructType([T.StructField("part", T.LongType()), T.StructField("seq", T.LongType()),
                         T.StructField("w", T.ArrayType(_DOUBLES))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j in range(b.num_rows):
                at = b.column(0)[j].as_py()
                part = int(np.searchsorted(first, at, "right")) - 1
                one = b.column(1).field("values")[j].values.to_numpy(zero_copy_only=False)
                turned = b.column(1).field("isTransposed")[j].as_py()
                flat = one if turned else one.reshape(k, rows).T.ravel()
                inner = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * k, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part]), pa.array([at - int(first[part])]),
                     pa.ListArray.from_arrays(pa.array([0, rows], pa.int32()), inner)], ["part", "seq", "w"])

    blocks = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model).toDF("index", "matrix")
    key = blocks.schema["index"].dataType.fieldNames()[0]
    return blocks.select(F.col("index")[key].cast("long").alias("i"), "matrix").mapInArrow(run, kind)


def moments(rows: DataFrame, name: str, k: int, centre: np.ndarray | None = None) -> np.ndarray:
    """Sums of the vectors (``centre`` None), or of the products of the centred vectors. A task
    sends its sums only; they are added by entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k if centre is None else k * k)
        for b in batches:
            w = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            total += w.sum(axis=0) if centre is None else ((w - centre).T @ (w - centre)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["at", "v"])

    got = rows.select(name).mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(k if centre is None else k * k)
    for r in got:
        out[r["at"]] = r["v"]
    return out


def whiten(vectors: DataFrame, vector: str = "x", keep=None, components: int = COMPONENTS
           ) -> tuple[DataFrame, dict]:
    """``(row, deviation, w)`` of every vector of longs, and the fit: ``n``, ``eigenvalues``,
    ``explained`` (shares of the trace), ``axes`` (unit eigenvectors as columns) and
    ``identity_error`` (largest entry of the covariance of ``w`` minus the identity).

    ``w`` has at most ``components`` entries, by falling eigenvalue; directions without
    variance (below 1e-12 of the largest) have none. ``deviation`` is the exact sum of
    ``(n x - S)^2``, null beyond a 64-bit number. Rows whose vector is null, holds a null, or
    is empty are dropped, and rows of another length than most (of equally frequent lengths
    the shortest counts). Repeated rows count each, tied eigenvalues have any axes of their
    space, and an empty table, or one without variance, gives no rows. Vectors have a bounded
    number of dimensions: the driver holds one matrix of dimensions by dimensions, the number
    of blocks of each part and, by BlockMatrix, the index of each block.
    """
    spark = vectors.sparkSession
    small_batches(spark, BLOCK_ROWS)
    columns = vectors.columns if keep is None else list(keep)
    x = col(vector).cast("array<bigint>")
    fit = vectors.select(F.struct(*[col(c) for c in columns]).alias("row"), x.alias("x")) \
        .filter(F.col("x").isNotNull() & (F.size("x") > 0) & ~F.exists("x", lambda c: c.isNull()))
    empty = spark.createDataFrame([], T.StructType([fit.schema["row"], T.StructField("deviation", T.LongType()),
                                                    T.StructField("w", _DOUBLES)]))
    lengths = fit.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).collect()
    if not lengths:
        return empty, {"n": 0, "eigenvalues": [], "explained": [], "identity_error": 0.0}
    most = max(lengths, key=lambda r: (r["n"], -r["d"]))
    n, d = most["n"], most["d"]
    fit = fit.filter(F.size("x") == d)
    sums = [int(s) for s in fit.agg(*[F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]).first()]

    parts = max(1, fit.rdd.getNumPartitions())
    rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * d), -(-n // parts)))
    blocks = staged(_blocks(fit, n, sums, rows), "blocks")
    of_part = {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.count("*").alias("n")).collect()}
    first = np.zeros(max(of_part) + 2, np.int64)
    first[1:] = np.cumsum([of_part.get(p, 0) for p in range(max(of_part) + 1)])
    matrix = _matrix(blocks, first, rows, d)
    splits = max(1, -(-int(first[-1]) // BLOCKS_PER_TASK))
    scatter = _times(matrix.transpose(), matrix, splits).toLocalMatrix().toArray()
    covariance = (scatter + scatter.T) / (2 * n)
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")
    values, axes = values[order], axes[:, order]
    k = min(components, int((values > max(values[0], 0) * LEAST_SHARE).sum()))
    fitted = {"n": n, "eigenvalues": values.tolist(), "axes": axes, "identity_error": 0.0,
              "explained": (values / np.trace(covariance)).tolist() if k else []}
    if not k:
        return empty, fitted

    product = _times(matrix, _local(spark, axes[:, :k] / np.sqrt(values[:k])), 1)
    joined = blocks.select("part", "seq", "rows", "deviation") \
        .join(_projected(product, first, rows, k), ["part", "seq"])
    zipped = F.arrays_zip("rows", "deviation", F.slice("w", F.lit(1), F.size("rows")).alias("w"))
    out = joined.select(F.inline(zipped).alias("row", "deviation", "w"))
    out = staged(out, "whitened")
    mean = moments(out, "w", k) / n
    whitened = moments(out, "w", k, mean).reshape(k, k) / n
    fitted["identity_error"] = float(np.abs(whitened - np.eye(k)).max())
    return out, fitted


def op12_whiten_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whitened components of every embedding, one row for each."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", quantised(F.col("embedding")).alias("x"))
    out, fit = whiten(rows, "x", ["vec_id"])
    share = F.lit(fit["explained"][:COMPONENTS] or [0.0])
    long = out.select("row.vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return long.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(fit["n"]).cast("long").alias("n"),
                       "deviation", "whitened", F.element_at(share, F.col("at") + 1).alias("explained"),
                       F.lit(fit["identity_error"]).alias("identity_error"))
