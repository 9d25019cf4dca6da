"""Mixing: targets by hand, totals kept by flights, copies taken as planned."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tabwright.llm import mixing


def test_targets_reshare_the_excess():
    found = mixing.targets([(None, 100), ("b", 100), ("a", 10)])
    # a: weight 5, b: 2, null: 1; 315 words in all, a stops at 20, b at 196.67 of 200, null at 98.33
    assert found["a"] == 20 and found["b"] == pytest.approx(295 * 2 / 3) and found[None] == pytest.approx(295 / 3)
    assert mixing.targets([]) == {}
    assert mixing.targets([("a", 0)]) == {"a": 0}


@given(st.lists(st.tuples(st.integers(0, 5000), st.floats(0, 1)), max_size=60))
def test_flights_keep_totals(units):
    size, chance = np.array([u[0] for u in units], float), np.array([u[1] for u in units])
    out = mixing.flight(size, chance)
    open_ = (out > 0) & (out < 1)
    assert open_.sum() <= 2
    assert out.sum() == pytest.approx(chance.sum(), abs=1e-5)
    assert (out * size).sum() == pytest.approx((chance * size).sum(), rel=1e-6, abs=1e-3)
    assert set(np.unique(mixing.land(size, out))) <= {0.0, 1.0}


def rows(n=3000):
    draw = np.random.default_rng(5)
    out = [(i, " ".join(["w"] * int(draw.integers(0, 80))), ["a", "b", "c", None][min(3, int(draw.integers(0, 6)))], 7) for i in range(n)]
    return out + [(None, "no id", "a", 1), (1, None, "b", 1), (2, "", None, 1)] + [(77, "the same row again", "a", 2)] * 500


def test_mix_meets_targets_and_repeats(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string, size int")
    found = mixing.mix(docs.repartition(7), bucket_rows=50).toPandas()
    again = mixing.mix(docs.repartition(3), bucket_rows=50).toPandas()
    order = ["doc_id", "size", "taken"]
    assert found.sort_values(order)[order].fillna(-1).values.tolist() == again.sort_values(order)[order].fillna(-1).values.tolist()
    assert len(found) == docs.count() and (found["taken"] <= 2 * found["size"]).all()
    for _, group in found.groupby(found["source"].fillna("none")):
        assert abs(group["taken"].sum() - group["target"].iloc[0]) <= 160
        assert group["size"].sum() == group["source_size"].iloc[0]


def test_mixed_rows_follow_the_plan(spark):
    docs = spark.createDataFrame(rows(400), "doc_id long, text string, source string, size int")
    plan = mixing.mix(docs).groupBy("doc_id", "source").sum("copies").collect()
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    seen = {(r["doc_id"], r["source"]): r["count"] for r in out.groupBy("doc_id", "source").count().collect()}
    assert seen == {(r[0], r[1]): r[2] for r in plan if r[2]}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0 and mixing.mixed(docs).count() == 0
