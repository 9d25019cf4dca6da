"""Toxicity: sentences found from labels of documents, whole texts, odd rows."""

from __future__ import annotations

import random

import numpy as np

from tabwright.llm import queries, toxicity

BAD = ["idiot", "scum", "réeuxpa"]


def sentence(draw: random.Random, bad: bool) -> str:
    words = draw.choices([f"word{i}" for i in range(300)], k=draw.randrange(4, 12))
    if bad:
        words[draw.randrange(len(words))] = draw.choice(BAD)
    return " ".join(words).capitalize() + draw.choice([". ", "! ", ".\n"])


def rows(n=1200):
    draw, out = random.Random(7), []
    for i in range(n):
        toxic = i % 4 == 0
        parts = [sentence(draw, False) for _ in range(draw.randrange(2, 25))]
        if toxic:
            parts[draw.randrange(len(parts))] = sentence(draw, True)
        out.append((i, "".join(parts), int(toxic), 0.5))
    return out


def test_learns_sentences_from_documents(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, toxic int, p double")
    model = toxicity.fit(docs.where("doc_id % 3 <> 1"), max_rows=100_000)
    scored = toxicity.score(docs.where("doc_id % 3 = 1"), model).toPandas()
    assert ((scored["predicted"] == 1) == (scored["toxic"] == 1)).mean() > 0.97
    found = toxicity.offending(docs.where("doc_id % 3 = 1 AND toxic = 1"), model).toPandas()
    assert np.mean([any(w in s.lower() for w in BAD) for s in found["sentence"]]) > 0.97
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and abs(clean.count() - 900) < 20
    # A sentence late in a very long text counts like one in a short text.
    long = "word1 word2 word3. " * 150_000 + "You idiot here. " + "word4 word5. " * 1000
    odd = [(1, long), (2, None), (3, ""), (4, " .,! "), (5, "Idiot"), (5, "Idiot"), (None, "scum " * 3)]
    odd = toxicity.score(spark.createDataFrame([(i, t, 1) for i, t in odd], "doc_id long, text string, n int"), model).toPandas()
    by = dict(zip(odd["doc_id"].fillna(0), zip(odd["score"], odd["predicted"], strict=True), strict=True))
    assert by[1][1] == 1 and by[2] == by[3] == by[4] == (0.0, 0) and by[5][1] == by[0][1] == 1 and len(odd) == 7
    long_found = toxicity.offending(spark.createDataFrame([(1, long)], "doc_id long, text string"), model).collect()
    assert [r["sentence"] for r in long_found] == ["You idiot here"]


def test_score_is_the_noisy_or_of_its_sentences(spark):
    model = toxicity.fit(spark.createDataFrame(rows(300), "doc_id long, text string, toxic int, p double"))
    docs = spark.createDataFrame([(1, "A b c. You idiot. Such scum! Fine then")], "doc_id long, text string")
    each = toxicity.offending(docs, model, least=0.0).collect()
    assert [r["sentence"] for r in each] == ["A b c", "You idiot", "Such scum", "Fine then"]
    whole = toxicity.score(docs, model).first()["score"]
    assert abs(whole - (1 - np.prod([1 - r["probability"] for r in each]))) < 1e-9


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, toxic int")
    model = toxicity.fit(empty)
    assert toxicity.score(empty, model).count() == 0
    one = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, toxic int")
    assert toxicity.score(one, toxicity.fit(one)).first()["score"] < 1e-6


def test_query_covers_all_documents(spark):
    found = queries.op6_toxicity(spark, "/root/testdata/sf0.01").toPandas()
    assert len(found) == 1000 and found["score"].between(0, 1).all()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    tested = labels.merge(found[found["held_out"]], on="doc_id")
    high, low = (tested[tested["toxic"] == k]["score"].to_numpy() for k in (1, 0))
    assert np.mean(high[:, None] > low[None]) > 0.8
