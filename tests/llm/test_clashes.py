"""Stages of the pipeline on tables whose extra columns have the names that the stages use inside."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from tabwright.llm import common, jaccard, langid, mixing, queries, toxicity

NAMES = ["id", "origin", "hash", "copies", "rows", "mark", "nth", "run", "kept_id", "kept_mark", "node", "root", "toxicity", "is_toxic", "score", "predicted",
         "language", "probability", "size", "target", "number", "whole", "chance", "n", "first", "part", "__mark", "__copies", "__toxic", "__language"]
FOLDER = "/root/testdata/sf0.001"


def crowded(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source").where("length(text) < 5000")
    return docs.withColumns({n: F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")) for n in NAMES})


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_stages_pass_clashing_columns_through(spark):
    docs = crowded(spark)
    plain = docs.select("doc_id", "text", "source")
    model, toxic = queries.language_model(spark, FOLDER), queries.toxicity_model(spark, FOLDER)
    for stage in (mixing.mixed, jaccard.keep_one, lambda d: toxicity.keep_clean(d, toxic), lambda d: langid.keep_identified(d, model)):
        found = stage(docs)
        assert found.columns == docs.columns
        every = rows(found)
        assert every and sorted(r[:3] for r in every) == rows(stage(plain))
        assert all(value == f"{name} {r[0]}" for r in every for name, value in zip(NAMES, r[3:], strict=True))


def test_unused_names_and_slices():
    assert common.unused(["ID", "_mark"], "id", "mark", "_mark", "x") == ["_id", "mark", "__mark", "x"]
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 40, None, "", "b" * 500, "c", "d" * 30]), pa.array(range(6))], names=["t", "i"])
    parts = list(common.slices(iter([batch, batch.slice(2, 0)]), "t", 64))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch])) and len(parts) > 2
    assert max(sum(len(v.as_py() or "") for v in p.column("t")) for p in parts) == 500
