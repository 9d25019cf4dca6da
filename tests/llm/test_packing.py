"""Packing: ids, cuts, and sequences without overlap or gap."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from tabwright.llm import packing, queries

ODD = ["", " ", "\n\n  \n", "  lead and trail  ", "<|endoftext|> in text", "it's we'll I'D", "a b c", "日本語 テキスト ١٢٣ ²½", "é‍👩‍👩", "\x00\x07tab\tcr\r\n", "$$$!!!...", "x" * 5000]


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_vocabulary(spark, reference):
    encode = packing.encoder(packing.default_vocabulary())
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in [*ODD, *texts]:
        assert encode(text) == reference(text)
    assert len(encode(" " * 300_000)) and len(encode("ab" * 300_000))


@settings(max_examples=150)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    text = text.encode("utf-8", "replace").decode()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not hasattr(test_ids_of_any_text, "t") else test_ids_of_any_text.t
    test_ids_of_any_text.t = tokenizer
    tokenizer.encode_special_tokens = True
    assert packing.encoder(packing.default_vocabulary())(text) == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def default():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=150)
@given(st.lists(st.one_of(st.text(max_size=20), st.sampled_from(["<|endoftext|>", " ", "\n", "<|", "endoftext|>"])), max_size=8))
def test_added_tokens_are_recognised(default, parts):
    text = "".join(parts).encode("utf-8", "replace").decode()
    assert packing.encoder(packing.default_vocabulary(), packing.ADDED)(text) == default(text)


def test_query_and_pipeline_recognise_added_tokens(spark, default, tmp_path):
    texts = dict(enumerate([*ODD, "a<|endoftext|> in text", "two <|endoftext|> <|endoftext|>\n" * 300]))
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    whole = {i: default(t) + [packing.END] for i, t in texts.items()}
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    found = corpus_pipeline.packed(spark, docs, str(tmp_path)).collect()
    assert all(list(r["ids"]) == whole[r["doc_id"]][r["start"] : r["start"] + r["length"]] for r in found)
    for r in [*found, *queries.op1_best_fit_packing(spark, str(tmp_path)).collect()]:
        ids = whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
    assert sum(r["length"] for r in found) == sum(map(len, whole.values()))


@given(st.integers(1, 5000), st.integers(1, 700))
def test_cuts(total, capacity):
    pieces = packing.cut(total, capacity)
    assert [p[0] for p in pieces] == list(np.cumsum([0, *(n for _, n in pieces)])[:-1]) and sum(n for _, n in pieces) == total
    assert all(n == capacity for _, n in pieces[1:]) and 1 <= pieces[0][1] <= capacity and len(pieces) == -(-total // capacity)


@given(st.lists(st.integers(1, 64), max_size=120))
def test_plans_fill_sequences(lengths):
    sequences: dict[int, list] = {}
    ranks: dict[int, list] = {}
    for length, first, n, sequence, offset in packing.plan(dict(Counter(lengths)), 64):
        ranks.setdefault(length, []).extend(range(first, first + n))
        for k in range(n):
            sequences.setdefault(sequence + k, []).append((offset, length))
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in Counter(lengths).items()}
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    # No two sequences could be one: that is what best fit leaves.
    fills = sorted(sum(n for _, n in s) for s in sequences.values())
    assert len(fills) < 2 or fills[0] + fills[1] > 64


def test_pack(spark, reference):
    texts = ["word " * n for n in (3, 700, 1023, 1024, 1025, 5000, 40, 40, 300)] + [None, "", "x"] + ODD
    rows = [(i if i % 5 else None, t, 1, "s") for i, t in enumerate(texts)] + [(77, "the same " * 100, 1, "s")] * 60
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int, offset string").repartition(4)
    found = packing.pack(docs).toPandas()
    assert found["length"].sum() == sum(len(reference(t or "")) + 1 for _, t, _, _ in rows)
    assert len(found) == sum(-(-(len(reference(t or "")) + 1) // 1024) for _, t, _, _ in rows)
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert group["offset"].tolist() == [0, *np.cumsum(group["length"])[:-1]] and group["length"].sum() <= 1024
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in found.itertuples())
    assert found["sequence_id"].nunique() <= -(-found["length"].sum() // 1024) + 2
    plain = packing.pack(docs, keep_ids=False)
    assert plain.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pieces_come_in_small_batches(spark, monkeypatch):
    """Texts are encoded a block at a time, with the same pieces and ids as all at once."""
    rows = [(i, f"some words {i} " * 400) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    whole = [tuple(r) for r in packing.pieces(docs, keep_ids=True, capacity=100).collect()]
    monkeypatch.setattr(packing, "BLOCK", 20_000)
    small = [tuple(r) for r in packing.pieces(docs, keep_ids=True, capacity=100).collect()]
    assert small == whole and all(r[3] == len(r[-1]) for r in small)
    batch = pa.record_batch([pa.array([t for _, t in rows])], names=["text"])
    sizes = [part.num_rows for part in packing.slices(iter([batch]), "text", packing.BLOCK)]
    assert len(sizes) > 5 and sum(sizes) == 30
