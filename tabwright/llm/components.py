"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import in_one, stage


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))).alias("h")).first()
    return row["n"], row["h"] or 0


def _either(a: str, b: str, c: str, d: str) -> Column:
    """Two rows of each: (a, b) and (c, d)."""
    return F.inline(F.array(*[F.struct(F.col(x).alias("one"), F.col(y).alias("two")) for x, y in ((a, b), (c, d))]))


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another; the root is the smallest node it reaches.

    Alternates the two star operations: each node hands its larger neighbours, then its smaller
    ones, to the smallest node it knows. The number of rounds grows with the logarithm of the graph, and
    no node's neighbours are gathered in one place: only their minimum is.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = stage(edges.select(u, v).where("u <> v").distinct())
    mark = _mark(edges)
    while True:
        edges = in_one(edges, mark[0])
        both = edges.select(_either("u", "v", "v", "u").alias("u", "v"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = in_one(large, mark[0]).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(_either("v", "m", "u", "m").alias("u", "v"))
        edges = stage(small.where("u <> v").distinct())
        before, mark = mark, _mark(edges)
        if mark == before:
            edges = in_one(edges, mark[0])
            return edges.select(_either("u", "v", "v", "v").alias("node", "root")).distinct()
