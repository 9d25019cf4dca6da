"""The Jaccard join against a comparison of all pairs."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabwright.llm import common, jaccard


def plain_set(text: str | None, words: int) -> frozenset:
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not found:
        return frozenset()
    n = min(words, len(found))
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1))


def plain_components(rows: list[tuple], words: int, num: int, den: int) -> list[tuple]:
    sets = [plain_set(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                root[find(i)] = find(j)
    groups: dict[int, list] = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(rows[i][0])
    low = {r: min([x for x in g if x is not None], default=None) for r, g in groups.items()}
    return sorted(((rows[i][0], len(sets[i]), low[find(i)]) for i in range(len(rows))), key=str)


def corpus(seed: int) -> list[tuple]:
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = draw.choices(vocabulary, k=25)
    rows: list[tuple] = []
    for base in range(40):
        body = draw.choices(vocabulary, k=draw.choice([1, 2, 3, 5, 9, 12, 15, 20, 22, 30, 40, 80, 200]))
        if base % 3 == 0:
            body = body + passage
        for _ in range(draw.choice([1, 1, 2, 6])):
            copy = list(body)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            if draw.random() < 0.2:
                copy = copy[:-1] or copy
            rows.append((len(rows), " ".join(copy)))
    # one large group whose members drift apart
    body = draw.choices(vocabulary, k=120)
    for _ in range(60):
        copy = list(body)
        for _ in range(draw.randrange(9)):
            copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
        rows.append((len(rows), "\n".join(copy).upper()))
    edge = [None, "", " \t\r\n", "one", "One", "one two", "one  two ", " ", "Ünder übung", "x" * 3_000_000, "a b " * 400_000]
    rows += [(len(rows) + i, t) for i, t in enumerate(edge)]
    return rows + [rows[0], (None, rows[3][1]), (None, "alone with no id here"), (5, "same id other text here")]


@pytest.mark.parametrize("words,num,den,seed", [(3, 9, 10, 1), (5, 8, 10, 2)])
def test_equals_all_pairs(spark, words, num, den, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, node int, n string").repartition(5)
    found = jaccard.components(docs, words=words, threshold=(num, den)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_components(rows, words, num, den)


@pytest.mark.parametrize("rows,held", [(3, 1 << 20), (1 << 20, 4)])
def test_hot_shingles_and_long_lists(spark, monkeypatch, rows, held):
    monkeypatch.setattr(jaccard, "HOT_ROWS", rows)
    monkeypatch.setattr(jaccard, "HELD", held)
    given = corpus(3)
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    found = jaccard.components(docs, words=3, threshold=(9, 10)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_components(given, 3, 9, 10)


@pytest.mark.parametrize("words,num,den,rounds", [(3, 9, 10, 0), (5, 8, 10, 3)])
def test_splits_lists(spark, monkeypatch, words, num, den, rounds):
    monkeypatch.setattr(jaccard, "SHORT", 2)
    monkeypatch.setattr(jaccard, "HUB_ROUNDS", rounds or 1)
    rows = corpus(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = jaccard.components(docs, words=words, threshold=(num, den)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_components(rows, words, num, den)


def test_near_copies_do_not_meet_in_pairs(spark, monkeypatch):
    draw, rows = random.Random(5), []
    body = [f"w{i}" for i in range(150)]
    for i in range(400):
        copy = list(body)
        for at in draw.sample(range(150), draw.choice([1, 2, 2, 3])):
            copy[at] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    made, pairs = [], jaccard._pairs

    def seen(placed, num, den):
        made.append((placed.count(), pairs(placed, num, den).count()))
        return pairs(placed, num, den)

    monkeypatch.setattr(jaccard, "_pairs", seen)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.components(docs, words=3, threshold=(9, 10)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(tuple(r) for r in found) == sorted(plain_components(rows, 3, 9, 10))
    monkeypatch.setattr(jaccard, "SPLIT_ROUNDS", 0)
    jaccard.components(docs, words=3, threshold=(9, 10)).count()
    (members, split), (_, whole) = made
    assert split <= jaccard.SHORT * members // 2 and split * 10 < whole


def test_small_rounds_take_few_tasks(spark, monkeypatch):
    rows = corpus(6)[-75:]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    parts, connect = [], jaccard.connected

    def seen(edges):
        found = connect(edges)
        parts.extend([edges.rdd.getNumPartitions(), found.rdd.getNumPartitions()])
        return found

    monkeypatch.setattr(jaccard, "connected", seen)
    found = jaccard.components(docs, words=3, threshold=(9, 10)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_components(rows, 3, 9, 10)
    assert parts and max(parts) == 1


def test_larger_rounds_are_shuffled(spark, monkeypatch):
    most = 40
    monkeypatch.setattr(jaccard, "PART_SHINGLES", most)
    monkeypatch.setattr(jaccard, "SHORT", 2)
    monkeypatch.setattr(jaccard, "in_one", lambda df, rows, each=1, limit=most: df.coalesce(1) if rows * each <= limit else df)
    rows = corpus(7)[-75:]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = jaccard.components(docs, words=5, threshold=(8, 10)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_components(rows, 5, 8, 10)


def test_many_rows_are_not_sent_through_the_driver(spark, monkeypatch, tmp_path):
    spark.range(4000).selectExpr("id AS node", "0L AS place").write.parquet(str(tmp_path / "placed"))
    placed = spark.read.parquet(str(tmp_path / "placed"))

    def plan(rows):
        lists = common.in_one(placed, rows).join(placed.groupBy("node").agg(F.max("place").alias("high")), "node")
        return lists._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(common.SENT_ROWS) and "BroadcastHashJoin" not in plan(common.SENT_ROWS + 1)
    assert "BroadcastHashJoin" not in plan(common.PART_ROWS + 1)
    # Links are the same where nothing is sent.
    monkeypatch.setattr(common, "SENT_ROWS", 0)
    monkeypatch.setattr(jaccard, "SENT_ROWS", 0)
    rows = corpus(7)[-75:]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = jaccard.components(docs, words=5, threshold=(8, 10)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((tuple(r) for r in found), key=str) == plain_components(rows, 5, 8, 10)


def test_lists_of_like_sets_share_hubs(spark, monkeypatch):
    draw, rows = random.Random(8), []
    body = [f"w{i}" for i in range(150)]
    for i in range(120):
        copy = list(body)
        for at in draw.sample(range(150), draw.choice([2, 3, 4, 5])):
            copy[at] = f"x{draw.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    met, split = [], jaccard._split

    def seen(frame, differing):
        met.append((frame.count(), frame.select("h").distinct().count()))
        return split(frame, differing)

    monkeypatch.setattr(jaccard, "_split", seen)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.components(docs, words=5, threshold=(8, 10)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(tuple(r) for r in found) == sorted(plain_components(rows, 5, 8, 10))
    assert met and all(m <= 300 and hubs <= 3 for m, hubs in met), met


@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), max_size=60), st.integers(1, 7), st.integers(2, 9))
def test_tokens_of_more_than_one_node(rows, size, held):
    rows = sorted(rows)
    parts = [rows[i : i + size] for i in range(0, len(rows), size)]
    batches = [pa.RecordBatch.from_arrays([pa.array([t << 8 for t, _ in p]), pa.array([v for _, v in p]), pa.array([5] * len(p))],
                                          names=["token", "node", "meta"]) for p in parts]
    found = [(r["token"], r["node"], r["n"]) for b in jaccard._shared(iter(batches), held, [], 256) for r in b.to_pylist()]
    nodes = {t: sorted({v for u, v in rows if u == t}) for t, _ in rows}
    level = {t: int(jaccard._level(min(len(v), held))) for t, v in nodes.items()}
    assert sorted(found) == sorted((level[t] << 56 | t, v, 5) for t, vs in nodes.items() if len(vs) > 1 for v in vs)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.components(docs).count() == 0


def test_keeps_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(4, text, 1), (2, text + " more", 2), (2, text + " more", 2), (9, "other words that stand alone here", 3), (7, None, 4), (8, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 7, 8, 9]


def test_keeps_rows_that_link_with_nothing(spark):
    texts = [" ".join(f"t{i}x{k}" for k in range(30)) for i in range(8)]
    rows = [(None, t) for t in texts[:4]] + [(None, texts[3]), (None, texts[4] + " more"), (11, texts[4])]
    rows += [(1, texts[5]), (2, texts[5] + " more"), (2, texts[6]), (3, texts[7]), (3, texts[0] + " more")]
    rows += [(None, None), (None, ""), (None, " \t\n"), (8, ""), (8, None), (2, "\u00a0"), (None, "\u00a0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted((tuple(r) for r in jaccard.keep_one(docs).collect()), key=repr)
    want = [(None, t) for t in texts[1:4]] + [(11, texts[4]), (1, texts[5]), (2, texts[6]), (3, texts[7]), (3, texts[0] + " more")]
    want += [(None, None), (None, ""), (None, " \t\n"), (8, ""), (8, None), (2, "\u00a0")]
    assert kept == sorted(want, key=repr)


@given(st.integers(1, 60), st.integers(1, 60), st.sampled_from([(9, 10), (8, 10), (1, 2)]))
def test_sizes(a, b, threshold):
    num, den = threshold
    least = jaccard.overlap(a, b, num, den)
    assert den * least >= num * (a + b - least) and den * (least - 1) < num * (a + b - least + 1)
    if least <= min(a, b):
        assert b in jaccard.partners(a, num, den) and least in jaccard.subset_sizes(a, num, den)
        assert least >= a - jaccard.entries(a, num, den) + 1
