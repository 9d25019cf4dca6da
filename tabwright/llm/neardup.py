"""Near-duplicate vectors within a label, by randomised-rotation binary codes.

Every vector is rotated at random and kept as the signs of its components, with a correction factor: the
inner product of the vector with its own code. From a code, its factor and a rotated query follows an
unbiased estimate of their cosine and a bound of its error. A pair whose upper bound lies below the
threshold is dropped; all others are computed exactly, in doubles, on the original vectors.

Codes are compared within buckets: vectors of one label that agree on the signs of a few random
projections. Several tables of buckets are used, as many as it takes to bring a pair at the threshold
together with the wanted ``recall``; bits per table grow with the size of the label, so that a bucket's size
does not. A pair that meets in several tables is counted in the first. Large buckets are split in
blocks, and all pairs of blocks are compared in tasks of their own; what leaves a task is a number of links per
vector and a spanning forest, not the pairs. Equal vectors of a label are one node with a weight.

Nulls: vectors that are null, zero, empty or hold null or non-finite components, and rows without a
label, link with nothing. Vectors of different length are never compared. Rows that repeat an id are separate
vectors. A null id is never the name of a component, unless all its ids are null. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import stage
from tabwright.llm.components import connected
from tabwright.llm.vectors import matrix, planes, rotation, scaled, usable

#: Vectors wanted in a bucket, and at most in a block.
BUCKET, BLOCK = 512, 1024
#: Width of the confidence bound, in standard errors; pairs in a piece of exact recomputation.
WIDTH, PIECE = 3.0, 100_000
SEED_BUCKETS, SEED_ROTATION, MOST_BITS = 11, 23, 24


def tables_for(bits: int, threshold: float, recall: float) -> int:
    """How many tables bring a pair at the threshold together with this probability."""
    together = (1 - acos(threshold) / pi) ** bits
    return 1 if together >= 1 else ceil(log(1 - recall) / log(1 - together))


def bits_for(rows: int, bucket: int = BUCKET) -> int:
    return min(MOST_BITS, max(0, ceil(log2(max(rows, 1) / bucket))))


def prefixes(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """The bucket of each vector in each table."""
    if not bits:
        return np.zeros((len(x), tables), np.int64)
    signs = (x @ planes(x.shape[1], bits * tables, SEED_BUCKETS) > 0).reshape(len(x), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def candidates(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of unit vectors whose estimated cosine may reach the threshold."""
    n = x.shape[1]
    turned = (x @ rotation(n, SEED_ROTATION)).astype(np.float32)
    code = np.where(turned > 0, np.float32(1), np.float32(-1)) / np.float32(np.sqrt(n))
    factor = (code * turned).sum(1)
    query = (y @ rotation(n, SEED_ROTATION)).astype(np.float32)
    estimate = (code @ query.T) / factor[:, None]
    error = WIDTH * np.sqrt(np.maximum(1 - factor**2, 0) / factor**2) / np.sqrt(n - 1) if n > 1 else np.full(len(x), np.inf)
    return np.nonzero(estimate + error[:, None] + 1e-5 >= threshold)


def exact(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Which of the pairs reach the threshold, in doubles."""
    out = np.zeros(len(i), bool)
    for a in range(0, len(i), PIECE):
        b = slice(a, a + PIECE)
        out[b] = np.einsum("ij,ij->i", x[i[b]], y[j[b]]) >= threshold
    return out


def forest(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Edges that connect what the pairs connect, at most one per node."""
    order = np.argsort(np.concatenate([i, j]), kind="stable")
    near = np.concatenate([j, i])[order]
    first = np.searchsorted(np.concatenate([i, j])[order], np.arange(n + 1))
    seen, out = np.zeros(n, bool), []
    for start in np.unique(i):
        if seen[start]:
            continue
        seen[start], todo = True, [start]
        while todo:
            at = todo.pop()
            fresh = np.unique(near[first[at] : first[at + 1]])
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            out += [(at, f) for f in fresh]
            todo += fresh.tolist()
    return out


def links(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.93,
          recall: float = 0.9999, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept."""
    good = usable(vector) & F.col(label).isNotNull()
    rows = vectors.select(F.col(key).alias("id"), F.when(good, F.col(vector)).alias("x"), F.col(label).cast("string").alias("label"))
    rows = rows.withColumn("node", F.when(F.col("x").isNotNull(), F.xxhash64("label", "x")))
    named = stage(rows.select("id", "node"))
    nodes = rows.where("x IS NOT NULL").groupBy("node", "label").agg(F.first("x").alias("x"), F.count("*").alias("weight"), F.min("id").alias("id"))
    nodes = stage(nodes.withColumn("size", F.size("x")))
    # Bits and tables by the size of each label: one row per label and length of vector.
    counts = nodes.groupBy("label", "size").agg(F.count("*").alias("n"))
    bits = F.udf(lambda n: bits_for(n, bucket), "int")("n")
    tables = F.udf(lambda b: tables_for(b, threshold, recall), "int")("bits")
    counts = counts.withColumn("bits", bits).withColumn("tables", tables).drop("n")

    def spread(batches):
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("size", "bits", "tables")), strict=True))
            for one in sorted(set(keys)):
                at = np.flatnonzero([k == one for k in keys])
                part = batch.take(pa.array(at))
                for a in range(0, len(at), 2048):
                    piece = part.slice(a, 2048)
                    found = prefixes(scaled(matrix(piece.column("x")))[0], one[1], one[2])
                    row, table = np.divmod(np.arange(found.size), one[2])
                    picked = piece.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays(
                        [*picked.columns, pa.array(table.astype(np.int32)), pa.array(found.ravel())], names=[*picked.schema.names, "table", "bucket"])

    item = nodes.schema["x"].dataType.simpleString()
    placed = stage(nodes.join(counts, ["label", "size"]).select("node", "label", "size", "bits", "tables", "weight", "x").mapInArrow(
        spread, f"node long, label string, size int, bits int, tables int, weight long, x {item}, table int, bucket long"))
    home = ["label", "size", "table", "bucket"]
    blocks = placed.groupBy(*home).agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / block)).drop("n")
    placed = placed.join(blocks, home).withColumn("block", F.pmod(F.xxhash64("node", "table"), "blocks"))
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    paired = paired.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))

    def compare(rows: pa.Table) -> pa.Table:
        x = scaled(matrix(rows.column("x")))[0]
        node, weight, block = (rows.column(c).to_numpy() for c in ("node", "weight", "block"))
        one, two = rows.column("one")[0].as_py(), rows.column("two")[0].as_py()
        left, right = np.flatnonzero(block == one), np.flatnonzero(block == two)
        i, j = candidates(x[left], x[right], threshold)
        i, j = left[i], right[j]
        if one == two:
            i, j = i[i < j], j[i < j]
        near = exact(x, x, i, j, threshold)
        i, j = i[near], j[near]
        table = rows.column("table")[0].as_py()
        if table and len(i):
            earlier = prefixes(x, rows.column("bits")[0].as_py(), rows.column("tables")[0].as_py())[:, :table]
            new = np.ones(len(i), bool)
            for t in range(table):
                new &= earlier[i, t] != earlier[j, t]
            i, j = i[new], j[new]
        number = np.bincount(i, weight[j], len(node)) + np.bincount(j, weight[i], len(node))
        tree = forest(i, j, len(node))
        at = np.flatnonzero(number)
        return pa.table({
            "a": pa.array(np.concatenate([node[at], node[[e[0] for e in tree]] if tree else node[:0]]), pa.int64()),
            "b": pa.array(np.concatenate([node[at], node[[e[1] for e in tree]] if tree else node[:0]]), pa.int64()),
            "n": pa.array(np.concatenate([number[at].astype(np.int64), np.zeros(len(tree), np.int64)]))})

    found = stage(paired.groupBy(*home, "one", "two").applyInArrow(compare, "a long, b long, n long"))
    number = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = connected(found.where("a <> b").select("a", "b"))
    small = nodes.select("node", "id", "weight").join(roots, "node").groupBy("root").agg(F.min("id").alias("least"))
    of_node = nodes.select("node", "weight", F.col("id").alias("own")).join(number, "node", "left").join(roots, "node", "left").join(small, "root", "left")
    of_node = of_node.select("node", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("least", "own").alias("component_id"))
    out = named.join(of_node, "node", "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
