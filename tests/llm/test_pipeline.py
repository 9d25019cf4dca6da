"""The pipeline, stage by stage, against plain versions, and as a whole."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tabwright.llm import jaccard, langid, mixing, packing, queries, toxicity
from tests.llm.test_jaccard import plain_components

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        step(spark, out[-1], FOLDER).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "ngram_jaccard_join", "mixing", "best_fit_packing"]
    assert all(df.columns == steps[0].columns for df in steps[:-1]) and all(df.count() for df in steps)


def test_language_stage(spark, steps):
    model = queries.language_model(spark, FOLDER)
    kept = [r["doc_id"] for r in langid.predict(steps[0].select("doc_id", "text"), model).collect() if r["lang_pred"] != "und" and r["score"] >= 0.5]
    assert ids(steps[1]) == sorted(kept) and len(kept) > 190


def test_toxicity_stage(spark, steps):
    model = queries.toxicity_model(spark, FOLDER)
    kept = [r["doc_id"] for r in toxicity.score(steps[1].select("doc_id", "text"), model).collect() if r["score"] < 0.7]
    assert ids(steps[2]) == sorted(kept)


def test_duplicate_stage(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[2].select("doc_id", "text").collect()]
    want = sorted({c for _, n, c in plain_components(rows, 5, 8, 10) if n} | {i for i, n, _ in plain_components(rows, 5, 8, 10) if not n})
    assert ids(steps[3]) == want
    assert jaccard.keep_one(steps[3]).count() == len(want)


def test_mixing_stage(steps):
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(steps[3]).collect() if r["copies"]}
    assert Counter(ids(steps[4])) == Counter(plan)


def test_packing_stage(steps):
    found = steps[5].toPandas()
    assert Counter(found[found["piece"] == 0]["doc_id"]) == Counter(ids(steps[4]))
    encode = packing.encoder(packing.default_vocabulary())
    texts = {r["doc_id"]: encode(r["text"]) + [packing.END] for r in steps[4].distinct().collect()}
    assert all(list(r.ids) == texts[r.doc_id][r.start : r.start + r.length] for r in found.itertuples())
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group["offset"].tolist() == [0, *np.cumsum(group["length"])[:-1]]


def test_run_gives_the_last_stage(spark, steps):
    found = corpus_pipeline.run(spark, FOLDER)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(map(tuple, steps[5].select(columns).collect()))


def test_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, FOLDER)
    assert docs.count() == 0
