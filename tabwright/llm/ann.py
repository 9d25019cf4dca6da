"""Approximate nearest neighbours by inner product: a hash-prefix forest.

Each tree gives every vector a long string of bits, the signs of random projections. In a tree's array of
sorted strings, the vectors that share a prefix with a query lie side by side. A query takes the longest prefix, of one
length in all trees, whose ranges hold enough candidates; these are ranked by their exact inner product. How long it
is follows from a histogram of the strings' first bits over all vectors, at most ``MOST_LEVELS`` of them: there is no descent
to the longest matches, and no prefix is longer than that, so that ranges cannot be narrowed further on very large tables.

How many candidates are enough is measured: a bounded number of sample queries is compared
with all vectors, and the fewest candidates are taken that find the wanted share of their true neighbours.
Neighbours that are hardly nearer than the rest need many candidates; nothing is capped.

Every vector is indexed. Vectors lie in blocks by a hash of their id, each with the sorted arrays of its
own part of the forest; blocks of queries meet blocks of vectors, and each meeting returns the best k per
query. For inner products, vectors get one more component that makes their lengths equal; queries have
none there, so that the angle orders as the inner product does.

Nulls: vectors that are null, empty, zero or hold null or non-finite components, and rows with a
null id, take no part, neither as query nor as candidate. Vectors whose length is not the commonest one
(of equals, the smallest) take no part either. Equal scores are ordered by id; rows with the query's own id are not its
neighbours; other repeated rows are candidates each. Without queries or vectors the result is empty. Other columns are
not read.
"""

from __future__ import annotations

from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import stage
from tabwright.llm.vectors import matrix, planes, usable

#: Bits of a hash string, trees, and the seed of their projections.
BITS, TREES, SEED = 32, 32, 41
#: Vectors and queries in a block; sample queries; the share of true neighbours to be found among these.
VECTORS, QUERIES, SAMPLE, RECALL = 8_192, 1_024, 256, 0.95
#: The histogram counts prefixes of at most so many bits.
MOST_LEVELS = 14


def strings(x: np.ndarray, longest: float, trees: int, query: bool = False) -> np.ndarray:
    """The hash string of each vector in each tree, as a number whose first bit is the highest."""
    if query:
        x = x / np.abs(x).max(1, keepdims=True)
        x = np.hstack([x / np.sqrt((x * x).sum(1, keepdims=True)), np.zeros((len(x), 1))])
    else:
        x = x / longest
        x = np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))])
    signs = (x @ planes(x.shape[1], trees * BITS, SEED) > 0).reshape(len(x), trees, BITS)
    return signs @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bits strings have in common from the first on."""
    return BITS - np.ceil(np.log2((a ^ b) + 1.0)).astype(np.int64)


def visited(query: np.ndarray, sums: np.ndarray, levels: int) -> np.ndarray:
    """Candidates in the ranges of each query (with repetition over trees) at each level from 0."""
    out = np.zeros((len(query), levels + 1), np.int64)
    cell = query >> (BITS - levels)
    for level in range(levels + 1):
        wide = levels - level
        low = (cell >> wide) << wide
        for t in range(query.shape[1]):
            out[:, level] += sums[t, low[:, t] + (1 << wide)] - sums[t, low[:, t]]
    return out


def depth(seen: np.ndarray, enough: int) -> np.ndarray:
    """The deepest level at which a query sees enough candidates."""
    return np.maximum(0, (seen >= enough).sum(1) - 1)


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The k best, ties to the smaller id."""
    at = np.arange(len(score))
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort([ids[at], -score[at]])[:k]]


def _enough(near: list, sample: np.ndarray, sums: np.ndarray, levels: int, recall: float, most: int, k: int) -> int:
    """The fewest candidates with which the sample finds the wanted share of its neighbours."""
    seen = visited(sample, sums, levels)
    query = np.array([r["query"] for r in near], np.int64)
    level = np.array([r["level"] for r in near], np.int64)
    if not len(query):
        return most
    for enough in np.unique(np.geomspace(max(k, 1), max(most, k, 2), 200).astype(np.int64)):
        # Fewer candidates mean deeper ranges; the search goes from few to many.
        if (level >= depth(seen, int(enough))[query]).mean() >= recall:
            return int(enough)
    return most


def search(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 20,
           trees: int = TREES, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """The k nearest found for each query: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession

    def clean(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"))
        return rows.where(F.col("id").isNotNull() & usable("x"))

    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows, asked = clean(vectors), clean(queries)
    sizes = rows.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"), F.max(F.expr(
        "sqrt(aggregate(transform(x, v -> v * v), 0D, (a, v) -> a + v))")).alias("longest"))
    common_size = sizes.orderBy(F.desc("n"), "size").first()
    if common_size is None:
        return empty
    size, total, longest = common_size["size"], common_size["n"], common_size["longest"] * (1 + 1e-12)
    rows, asked = stage(rows.where(F.size("x") == size)), stage(asked.where(F.size("x") == size))
    questions = asked.count()
    if not questions or not np.isfinite(longest):
        return empty
    levels = min(MOST_LEVELS, max(4, ceil(log2(total)) - 3))
    drawn = asked.orderBy(F.xxhash64("id"), "id").limit(sample).toPandas()
    sample_x = np.stack(drawn["x"].to_numpy())
    sent = spark.sparkContext.broadcast((drawn["id"].to_numpy(), sample_x, strings(sample_x, longest, trees, query=True)))

    def survey(batches):
        """Counts of first bits over all vectors, and the best of them for each sample query."""
        ids, asked_x, asked_s = sent.value
        counts, held = np.zeros((trees, 1 << levels), np.int64), [(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(ids)
        for batch in batches:
            for a in range(0, len(batch), 2048):
                piece = batch.slice(a, 2048)
                own, x = piece.column("id").to_numpy(), matrix(piece.column("x"))
                found = strings(x, longest, trees)
                for t in range(trees):
                    counts[t] += np.bincount(found[:, t] >> (BITS - levels), minlength=1 << levels)
                score = x @ asked_x.T
                for q in range(len(ids)):
                    at = np.flatnonzero(own != ids[q])
                    at = at[best(score[at, q], own[at], k)]
                    level = common(found[at], asked_s[q]).max(1)
                    every = [np.concatenate(z) for z in zip(held[q], (score[at, q], own[at], level), strict=True)]
                    top = best(every[0], every[1], k)
                    held[q] = tuple(z[top] for z in every)
        tree, cell = np.nonzero(counts)
        n = [len(h[0]) for h in held]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([tree, np.full(sum(n), -1)]).astype(np.int32)), pa.array(np.concatenate([cell, np.repeat(np.arange(len(ids)), n)]).astype(np.int32)),
            pa.array(np.concatenate([counts[tree, cell], *(h[1] for h in held)]).astype(np.int64)),
            pa.array(np.concatenate([np.zeros(len(tree)), *(h[0] for h in held)])),
            pa.array(np.concatenate([np.zeros(len(tree), np.int64), *(h[2] for h in held)]).astype(np.int32))],
            names=["tree", "cell", "n", "score", "level"])

    surveyed = stage(rows.mapInArrow(survey, "tree int, cell int, n long, score double, level int"))
    counts = np.zeros((trees, 1 << levels), np.int64)
    for r in surveyed.where("tree >= 0").groupBy("tree", "cell").agg(F.sum("n").alias("n")).toPandas().itertuples():
        counts[r.tree, r.cell] = r.n
    sums = np.concatenate([np.zeros((trees, 1), np.int64), np.cumsum(counts, 1)], 1)
    near = _first(surveyed.where("tree < 0").select(F.col("cell").alias("query"), "score", F.col("n").alias("vec_id"), "level"), "query", k)
    enough = _enough(near.collect(), sent.value[2], sums, levels, recall, trees * total, k)

    shards, parts = -(-total // VECTORS), -(-questions // QUERIES)
    table = spark.sparkContext.broadcast(sums)

    def descend(batches):
        for batch in batches:
            for a in range(0, len(batch), 1024):
                piece = batch.slice(a, 1024)
                seen = visited(strings(matrix(piece.column("x")), longest, trees, query=True), table.value, levels)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(depth(seen, enough).astype(np.int32))], names=["id", "x", "depth"])

    asked = asked.mapInArrow(descend, "id long, x array<double>, depth int")
    zero = F.lit(0).cast("long")
    left = rows.select("id", "x", F.lit(-1).alias("depth"), F.pmod(F.xxhash64("id"), F.lit(shards)).alias("shard"),
                       F.explode(F.sequence(zero, F.lit(parts - 1).cast("long"))).alias("part"))
    right = asked.select("id", "x", "depth", F.explode(F.sequence(zero, F.lit(shards - 1).cast("long"))).alias("shard"),
                         F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part"))

    def meet(both: pa.Table) -> pa.Table:
        deep, ids, x = both.column("depth").to_numpy(), both.column("id").to_numpy(), matrix(both.column("x"))
        own, own_x, asks, asks_x, deep = ids[deep < 0], x[deep < 0], ids[deep >= 0], x[deep >= 0], deep[deep >= 0]
        out: list[list[np.ndarray]] = [[], [], []]
        if len(own) and len(asks):
            mine, theirs = strings(own_x, longest, trees), strings(asks_x, longest, trees, query=True)
            order = np.argsort(mine, axis=0)
            arrays = np.take_along_axis(mine, order, 0)
            wide = BITS - deep.astype(np.int64)
            low = (theirs >> wide[:, None]) << wide[:, None]
            first = np.stack([np.searchsorted(arrays[:, t], low[:, t]) for t in range(trees)], 1)
            last = np.stack([np.searchsorted(arrays[:, t], low[:, t] + (np.int64(1) << wide)) for t in range(trees)], 1)
            for q in range(len(asks)):
                chosen = np.zeros(len(own), bool)
                for t in range(trees):
                    chosen[order[first[q, t] : last[q, t], t]] = True
                at = np.flatnonzero(chosen & (own != asks[q]))
                score = own_x[at] @ asks_x[q]
                top = best(score, own[at], k)
                for column, part in zip(out, (np.full(len(top), asks[q]), own[at][top], score[top]), strict=True):
                    column.append(part)
        return pa.table({name: pa.array(np.concatenate(c) if c else np.zeros(0), kind) for name, c, kind in
                         zip(("query", "vec_id", "score"), out, (pa.int64(), pa.int64(), pa.float64()), strict=True)})

    found = left.unionByName(right).groupBy("shard", "part").applyInArrow(meet, "query long, vec_id long, score double")
    return _first(found, "query", k).select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


def _first(rows: DataFrame, query: str, k: int) -> DataFrame:
    from pyspark.sql import Window

    order = Window.partitionBy(query).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
