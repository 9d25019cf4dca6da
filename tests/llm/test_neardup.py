"""Near-duplicate vectors against a comparison of all pairs."""

from __future__ import annotations

import numpy as np

from tabwright.llm import neardup

DDL = "vec_id long, embedding array<float>, label int, node int"


def brute(rows, threshold=0.93):
    def good(r):
        return r[1] and r[2] is not None and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])

    root, number = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    x = [np.array(r[1], np.float32).astype(float) if good(r) else None for r in rows]
    for i in range(len(rows)):
        for j in range(i):
            if x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j]):
                if x[i] @ x[j] / np.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= threshold:
                    number[i] += 1
                    number[j] += 1
                    root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    least = [min([v for v in groups[find(i)] if v is not None], default=None) for i in range(len(rows))]
    return sorted(((rows[i][0], number[i], least[i], rows[i][0] == least[i]) for i in range(len(rows))), key=str)


def vectors():
    draw = np.random.default_rng(3)
    rows = []
    for base in range(120):
        x = draw.standard_normal(32)
        for _ in range(int(draw.choice([1, 1, 3, 8]))):
            rows.append((len(rows), (x + draw.standard_normal(32) * draw.choice([0, 0.1, 0.3, 0.45])).tolist(), int(draw.integers(0, 3)), 1))
    x = draw.standard_normal(32)
    rows += [(1000 + i, (x + draw.standard_normal(32) * 0.12).tolist(), 1, 1) for i in range(300)]
    rows += [(2000 + i, x.tolist(), 1, 1) for i in range(40)]
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [None] * 32, [float("inf")] + [1.0] * 31, [1.0, 2.0], [2.0, 4.0], [1e30] * 32, [1e-30] * 32, [3.0], [5.0]]
    rows += [(3000 + i, v, 1, 1) for i, v in enumerate(odd)]
    return rows + [(4000, x.tolist(), None, 1), (None, x.tolist(), 1, 1), (0, rows[0][1], rows[0][2], 1)]


def test_equals_all_pairs(spark):
    rows = vectors()
    found = neardup.links(spark.createDataFrame(rows, DDL).repartition(4), bucket=32, block=64)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)


def test_bounds_hold():
    draw = np.random.default_rng(1)
    x = draw.standard_normal((400, 64))
    y = x + draw.standard_normal((400, 64)) * 0.35
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    near = set(zip(*map(np.ndarray.tolist, np.nonzero(x @ y.T >= 0.93)), strict=True))
    kept = set(zip(*map(np.ndarray.tolist, neardup.candidates(x, y, 0.93)), strict=True))
    assert near and near <= kept and len(kept) < 0.02 * x.shape[0] ** 2


def test_empty_table(spark):
    assert neardup.links(spark.createDataFrame([], DDL)).count() == 0
