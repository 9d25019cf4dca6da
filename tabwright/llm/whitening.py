"""Whitening of embeddings with distributed block matrices.

Vectors become whole numbers, ``floor(steps * c)``. The statistics are those of the fit list, which holds each distinct vector
once. Rows of the fit list, centred by its exact sums, are indexed into the blocks of a distributed matrix; its transpose times
itself is the scatter, whose blocks are added up from many partial products. The scatter is as wide as a vector, so its
eigenvectors are found on the driver; scaled by their eigenvalues they are a small block matrix, by which the rows' own block matrix
is multiplied. The same product over the fit list gives the covariance of what comes out, which should be the identity.

The driver holds numbers per dimension, the scatter, and the places of blocks: blocks hold about a megabyte, and up to sixteen where
there are more than ``MOST_BLOCKS`` of them. No task gets more than ``PANEL`` blocks of a product's inner dimension.

Nulls: vectors that are null, empty, or hold null or non-finite entries take no part; null keys do. Vectors of other lengths than
the most frequent one (of equals, the longest) take no part either. Repeated vectors count once in the fit and are all projected.
Entries beyond the range of a long stop at its end. A deviation that no long holds is null. Directions without variance, up to rounding,
are no components: with one distinct vector there are none, and the result is empty, as that of an empty table. Other
columns of the input are not read, so that their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import placed, stage

#: Bytes of a block, the most blocks of this size, how far blocks grow beyond, and the widest block.
BLOCK_BYTES, MOST_BLOCKS, GROWTH, WIDEST = 1 << 20, 100_000, 16, 1024
#: Blocks along the inner dimension that one task multiplies.
PANEL = 16


def whole(vector: Column, steps: int = 256) -> Column:
    """Entries as whole numbers; null where an entry is null or not finite, and for vectors without entries."""
    x = vector.cast("array<double>")
    usable = (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    # Spark's floor stops at the ends of a long.
    return F.when(usable, F.transform(x, lambda c: F.floor(F.lit(float(steps)) * c).cast("long")))


def blocked(rows: DataFrame, width: int, count: int) -> DataFrame:
    """Rows as blocks, written once: a gapless number, the keys, and the vectors one behind the other.

    Each task fills blocks of one size, of which only its last one may hold fewer rows.
    """
    height = block_rows(width, count)
    keys = T.ArrayType(rows.schema["key"].dataType)
    schema = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("nth", T.LongType()), T.StructField("keys", keys),
                           T.StructField("x", T.ArrayType(T.LongType()))])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, held, waiting = TaskContext.get().partitionId(), 0, 0, []

        def block(table: pa.Table) -> pa.RecordBatch:
            key, x = (table.column(c).combine_chunks() for c in ("key", "x"))
            ends = pa.array([0, len(table)], pa.int32())
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([nth], pa.int64()), pa.ListArray.from_arrays(ends, key),
                                               pa.array([x.flatten()], pa.list_(pa.int64()))], names=schema.names)

        for batch in batches:
            waiting.append(batch)
            held += len(batch)
            while held >= height:
                table = pa.Table.from_batches(waiting)
                yield block(table.slice(0, height))
                waiting, held, nth = table.slice(height).to_batches(), held - height, nth + 1
        if held:
            yield block(pa.Table.from_batches(waiting))

    blocks = stage(rows.mapInArrow(fill, schema))
    starts = stage(placed(blocks, []).select("part", "start"))
    return blocks.join(starts, "part").select((F.col("start") + F.col("nth")).alias("block"), "keys", "x")


def block_rows(width: int, count: int) -> int:
    least = max(1, BLOCK_BYTES // (8 * min(width, WIDEST)))
    return min(max(least, -(-count // MOST_BLOCKS)), GROWTH * least)


def centred(blocks: DataFrame, mean: np.ndarray, count: int) -> BlockMatrix:
    """Blocks of rows without their mean as a distributed matrix; blocks that are not full end in rows of zeros."""
    width, height = len(mean), block_rows(len(mean), count)
    place = T.StructType([T.StructField("_1", T.LongType()), T.StructField("_2", T.LongType())])
    schema = T.StructType([T.StructField("_1", place), T.StructField("_2", MatrixUDT())])
    dense = pa.struct([("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
                       ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_())])
    places = pa.struct([("_1", pa.int64()), ("_2", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, x in zip(batch.column("block").to_pylist(), batch.column("x")):
                whole = np.zeros((height, width))
                found = x.values.to_numpy().reshape(-1, width)
                whole[: len(found)] = found - mean
                for j, at in enumerate(range(0, width, WIDEST)):
                    part = whole[:, at : at + WIDEST]
                    columns = [pa.array([v], t.type) for v, t in zip((1, height, part.shape[1], None, None, part.ravel(order="F"), False), dense)]
                    yield pa.RecordBatch.from_arrays([pa.array([{"_1": block, "_2": j}], places), pa.StructArray.from_arrays(columns, fields=list(dense))],
                                                     names=schema.names)

    number = blocks.agg(F.max("block")).first()[0] + 1
    matrix = callMLlibFunc("createBlockMatrix", blocks.select("block", "x").mapInArrow(cut, schema), height, min(width, WIDEST), number * height, width)
    return BlockMatrix(matrix, height, min(width, WIDEST))


def product(left: BlockMatrix, right: BlockMatrix, inner: int) -> BlockMatrix:
    """A product whose inner dimension is cut among tasks, the partial products being added up."""
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, max(1, -(-inner // PANEL)))
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose of a tall matrix times itself, as a local matrix."""
    found = product(matrix.transpose(), matrix, -(-matrix.numRows() // matrix.rowsPerBlock))
    return found.toLocalMatrix().toArray()


def projected(matrix: BlockMatrix, weights: np.ndarray) -> BlockMatrix:
    """The rows of a matrix times a small one."""
    local, rows, cols = [], matrix.colsPerBlock, weights.shape[1]
    for i, a in enumerate(range(0, len(weights), rows)):
        part = weights[a : a + rows]
        local.append(((i, 0), Matrices.dense(len(part), cols, part.ravel(order="F"))))
    sent = SparkContext.getOrCreate().parallelize(local, len(local))
    return product(matrix, BlockMatrix(sent, rows, cols, len(weights), cols), 1)


def components(total: np.ndarray, n: int, most: int | None) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues above rounding, by falling size, their vectors, and the trace of a covariance given as a scatter."""
    covariance = (total + total.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    known = int((values > max(values[0], 0) * len(values) * 1e-13).sum())
    keep = known if most is None else min(known, most)
    return values[:keep], vectors[:, :keep], float(np.trace(covariance))


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int | None = None, steps: int = 256) -> DataFrame:
    """One row per usable vector and component: key, component, n, deviation, whitened, explained, identity_error.

    ``most`` bounds the components; without it, there is one for every direction that varies.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("key"), whole(F.col(vector), steps).alias("x")).where("x IS NOT NULL")
    common = rows.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    kind = rows.schema["key"].dataType.simpleString()
    empty = spark.createDataFrame([], f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if common is None:
        return empty
    width = common["width"]
    rows = rows.where(F.size("x") == width)
    vectors = stage(rows.select("x").distinct())
    sums = vectors.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n"))
    found = sorted(sums.collect())
    n, exact = found[0]["n"], [int(r["s"]) for r in found]
    mean = np.array([s / n for s in exact])
    matrix = centred(blocked(vectors.select(F.lit(0).alias("key"), "x"), width, n), mean, n)
    values, directions, trace = components(scatter(matrix), n, most)
    if not len(values):
        return empty
    weights = directions / np.sqrt(values)
    error = float(np.abs(scatter(projected(matrix, weights)) / n - np.eye(len(values))).max())
    blocks = blocked(rows, width, common["n"])
    places = projected(centred(blocks, mean, common["n"]), weights).blocks.map(lambda b: (b[0][0], b[1].toArray().ravel().tolist()))
    whitened = spark.createDataFrame(places, "block long, whitened array<double>")
    number = len(values)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, x, y in zip(*(batch.column(c) for c in ("keys", "x", "whitened"))):
                own = keys.values
                size = len(own)
                columns = [own.take(pa.array(np.repeat(np.arange(size), number))), pa.array(np.tile(np.arange(1, number + 1, dtype=np.int32), size)),
                           pa.array(np.repeat(np.array(deviations(x.values.to_numpy().reshape(size, width), n, exact), object), number), pa.int64()),
                           y.values.slice(0, size * number)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "component", "deviation", "whitened"])

    spread_rows = blocks.join(whitened, "block").select("keys", "x", "whitened").mapInArrow(
        spread, f"key {kind}, component int, deviation long, whitened double")
    return spread_rows.select(
        F.col("key").alias(key), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*[F.lit(float(v / trace)) for v in values]), F.col("component")).alias("explained"),
        F.lit(error).alias("identity_error"))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of (n * x - S)^2 over the dimensions of each row, exact; None beyond a long."""
    far = n * float(np.abs(x.astype(np.float64)).max(initial=0)) + max(map(abs, sums))
    if x.shape[1] * far * far < 2.0**62:
        away = n * x - np.array(sums, np.int64)
        return (away * away).sum(1).tolist()
    totals = (sum((n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
    return [t if t < 1 << 63 else None for t in totals]
