"""Language identification: counts against a plain version, held-out accuracy, odd texts."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tabwright.llm import langid, queries
from tabwright.llm.common import held_out


def test_held_out_accuracy(spark):
    found = queries.op9_language_id(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    tested = [r for r in rows if r["held_out"]]
    assert len(tested) > 200 and np.mean([r["lang"] == r["lang_pred"] for r in tested]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_grams_of_a_batch_are_those_of_its_texts():
    texts = ["Ein Satz, dann 2 mehr!", "", "   ", "a", "Łódź żółw  ", "x" * 1_300_000 + " end", "日本語 テキスト"]
    together: dict[int, Counter] = {i: Counter() for i in range(len(texts))}
    for value, rows, first in langid.grams(texts, 1 << 16):
        for row, part in zip(rows, np.split(value, first[1:]), strict=True):
            together[row].update(part.tolist())
    for i, text in enumerate(texts):
        alone = Counter()
        for value, _, _ in langid.grams([text], 1 << 16):
            alone.update(value.tolist())
        assert alone == together[i]
    assert sum(together[0].values()) and not together[1] and not together[2]


def test_odd_rows(spark):
    train = [("der die das und nicht " * 5, "de"), ("the and of with from " * 5, "en"), (None, "en"), ("les des dans pour ", None)] * 3
    model = langid.fit(spark.createDataFrame(train, "text string, lang string"))
    assert model.languages == ["de", "en"]
    rows = [(1, None), (2, ""), (3, "12 !? 34"), (4, "the and"), (5, "und nicht"), (5, "und nicht"), (None, "with from the " * 200_000)]
    docs = spark.createDataFrame([(i, t, "q", 1.0) for i, t in rows], "doc_id long, text string, lang string, label double")
    found = langid.predict(docs, model)
    got = sorted(((r["doc_id"] or 0, r["lang_pred"]) for r in found.collect()))
    assert got == [(0, "en"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (5, "de")]
    assert found.columns == [*docs.columns, "lang_pred", "score"]
    kept = langid.keep_identified(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 5, 5]


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    model = langid.fit(empty)
    assert langid.predict(empty, model).count() == 0
    assert [r["lang_pred"] for r in langid.predict(spark.createDataFrame([("the", "x")], "text string, lang string"), model).collect()] == ["und"]


def test_held_out_rows_do_not_change_the_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(held_out(F.col("doc_id"), 4, 2), "xx").otherwise(F.col("lang")))
    models = [langid.fit(d.where(~held_out(F.col("doc_id"), 4, 2))) for d in (docs, other)]
    assert models[0].languages == models[1].languages and np.array_equal(models[0].weights, models[1].weights)
