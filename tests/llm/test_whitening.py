"""Whitening: every number against a plain version, and the identity as covariance."""

from __future__ import annotations

import numpy as np
import pytest

from tabwright.llm import queries, whitening

DDL = "vec_id long, embedding array<float>, component int, x string"


def plain(vectors, most):
    """x, deviation, components and projections of vectors without nulls."""
    x = [[int(np.floor(256 * float(c))) for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), np.int64)
    n, sums = len(fit), fit.sum(0)
    deviation = [sum((n * a - int(s)) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    away = fit - sums / n
    covariance = away.T @ away / n
    values, vectors_ = np.linalg.eigh(covariance)
    values, vectors_ = values[::-1][:most], vectors_[:, ::-1][:, :most]
    return n, deviation, values / np.trace(covariance), (np.array(x) - sums / n) @ vectors_ / np.sqrt(values)


def compare(found, keys, vectors, most):
    n, deviation, explained, places = plain(vectors, most)
    found = found.sort_values(["vec_id", "component"], kind="stable")
    assert len(found) == len(keys) * most and (found["n"] == n).all() and found["identity_error"].nunique() == 1
    assert found["identity_error"].iloc[0] < 1e-9
    order = np.argsort(keys, kind="stable")
    grid = found["whitened"].to_numpy().reshape(-1, most)
    assert found["component"].tolist() == list(range(1, most + 1)) * len(keys)
    assert found["deviation"].to_numpy().reshape(-1, most).tolist() == [[deviation[i]] * most for i in order]
    signs = np.sign((grid * places[order]).sum(0))
    assert np.allclose(grid, places[order] * signs, atol=1e-8)
    assert np.allclose(found["explained"].to_numpy().reshape(-1, most), explained)


@pytest.mark.parametrize(("width", "bytes_", "widest"), [(12, 1 << 20, 1024), (12, 700, 1024), (12, 700, 5)])
def test_equals_the_plain_version(spark, monkeypatch, width, bytes_, widest):
    # Small and narrow blocks make many of them in both directions.
    monkeypatch.setattr(whitening, "BLOCK_BYTES", bytes_)
    monkeypatch.setattr(whitening, "WIDEST", widest)
    monkeypatch.setattr(whitening, "PANEL", 3)
    draw = np.random.default_rng(5)
    x = (draw.standard_normal((400, width)) * np.geomspace(3, 0.1, width)).astype(np.float32)
    x[100:220] = x[100]
    rows = [(i, v.tolist(), 1, "y") for i, v in enumerate(x)]
    odd = [None, [], [float("nan")] * width, [None] * width, [float("inf")] + [0.0] * (width - 1), [1.0, 2.0]]
    df = spark.createDataFrame(rows + [(900 + i, v, 1, "y") for i, v in enumerate(odd)], DDL).repartition(7)
    compare(whitening.whiten(df, most=4).toPandas(), list(range(400)), x, 4)
    compare(whitening.whiten(df).toPandas(), list(range(400)), x, width)


def test_few_directions_zeros_and_null_keys(spark):
    rows = [(None if i % 3 else i, [float(i), 2.0 * i, 0.0], 1, "") for i in range(20)] + [(40, [0.0, 0.0, 0.0], 1, "")]
    found = whitening.whiten(spark.createDataFrame(rows, DDL), most=4).toPandas()
    assert len(found) == 21 and (found["component"] == 1).all() and np.allclose(found["explained"], 1) and found["n"].eq(20).all()


def test_one_vector_and_none(spark):
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1, ""), (2, [1.0, 2.0], 1, "")], DDL)).count() == 0
    assert whitening.whiten(spark.createDataFrame([], DDL)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None, 1, "")], DDL)).columns[0] == "vec_id"


def test_large_entries_are_exact():
    x = np.array([[2**40, -5], [3, 2**41]], np.int64)
    sums = [2**40 + 3, 2**41 - 5]
    want = [sum((2 * a - s) ** 2 for a, s in zip(r, sums, strict=True)) for r in x.tolist()]
    assert whitening.deviations(x, 2, sums) == [w if w < 1 << 63 else None for w in want]
    assert whitening.deviations(x // 2**20, 2, [s // 2**20 for s in sums]) == [
        sum((2 * a - s // 2**20) ** 2 for a, s in zip(r, sums, strict=True)) for r in (x // 2**20).tolist()]


def test_query(spark):
    rows = [r for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect() if r["embedding"]]
    compare(queries.op13_embedding_whitening(spark, "/root/testdata/sf0.001").toPandas(), [r["vec_id"] for r in rows], [r["embedding"] for r in rows], 4)
