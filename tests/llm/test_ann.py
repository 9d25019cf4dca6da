"""Nearest neighbours: recall and scores against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import ann

DDL = "vec_id long, embedding array<float>, rank int"


def brute(x, ids, q, k):
    order = sorted((-(x[i] @ x[q]), ids[i]) for i in range(len(ids)) if ids[i] != ids[q])[:k]
    return [(i, -s) for s, i in order]


@pytest.mark.parametrize("scale", [0.0, 0.6])
def test_recall_and_scores(spark, scale):
    draw = np.random.default_rng(4)
    x = draw.standard_normal((1500, 24)) * np.exp(scale * draw.standard_normal((1500, 1)))
    x[100:140] = x[100]  # ties
    x = x.astype(np.float32).astype(float)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 24, [float("nan")] * 24, [None] * 24, [1.0, 2.0]]
    df = spark.createDataFrame(rows + [(4000 + 20 * i, v, 0) for i, v in enumerate(odd)] + [(None, [1.0] * 24, 0)], DDL).repartition(3)
    found = ann.search(df, df.where("vec_id % 20 = 0"), k=20).toPandas()
    assert sorted(found["query_id"].unique()) == list(range(0, 1500, 20))
    hits = 0
    for q, group in found.groupby("query_id"):
        group = group.sort_values("rank")
        assert group["rank"].tolist() == list(range(1, 21))
        assert sorted(zip(-group["score"], group["vec_id"], strict=True)) == list(zip(-group["score"], group["vec_id"], strict=True))
        assert np.allclose(group["score"], [x[q] @ x[i] for i in group["vec_id"]], rtol=1e-12, atol=1e-12)
        hits += len({i for i, _ in brute(x, range(1500), q, 20)} & set(group["vec_id"]))
    assert hits >= 0.9 * 20 * found["query_id"].nunique()


def test_few_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1), (2, [-1.0, 0.0], 1), (2, [-1.0, 0.0], 1)], DDL)
    found = ann.search(df, df.where("vec_id % 20 = 0"), k=20).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found] == [(0, 1, 1, 1.0), (0, 2, 2, -1.0), (0, 3, 2, -1.0)]


def test_empty_tables(spark):
    df = spark.createDataFrame([], DDL)
    assert ann.search(df, df).count() == 0
    one = spark.createDataFrame([(1, [1.0], 1)], DDL)
    assert ann.search(one, one.where(F.lit(False))).count() == 0
    assert ann.search(one, one).count() == 0
