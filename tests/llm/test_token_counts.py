"""Token counts: every prefix against the vocabulary's own tokenizer, and the questions they answer."""

from __future__ import annotations

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabwright.llm import queries, token_counts

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
ODD = ["", " ", "\n\n  \n", "  lead and trail  ", "<|endoftext|> in text", "!<|endoftext|><|endoftext|>'", "it's we'll I'D they're 'r 've'", "日本語 テキスト ١٢٣ ²½",
       "é‍👩‍👩", "\x00\x07tab\tcr\r\n\x1c\x85", "$$$!!!...", "x" * 300, "unassigned ՘࢏ 're", " " * 200 + "y", "a　 　b", "aaaaaaabaaaa" * 9]


def expected(text: str) -> int:
    return len(TOKENIZER.encode(text, add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def known():
    return token_counts.prefixes(token_counts.default_vocabulary())


def test_every_prefix_of_odd_texts(known):
    for text in ODD:
        assert known.counts(text).tolist() == [expected(text[: i + 1]) for i in range(len(text))], text
        assert known.count(text) == expected(text)


PARTS = st.sampled_from(["<|endoftext|>", "<|end", " ", "  ", "\n", "'", "'re", "'ll", "the", " of", "!", "é", "日", "՘", "12", "\x85", "\t"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), PARTS), max_size=7))
def test_every_prefix_of_any_text(known, parts):
    text = "".join(parts).encode("utf-8", "replace").decode()
    assert known.counts(text).tolist() == [expected(text[: i + 1]) for i in range(len(text))]
    assert known.count(text) == expected(text)


def test_pairs_fit_as_their_merges_say(known):
    tokens = list(known.ranks)[::97]
    for a in tokens[::7]:
        for b in tokens[::11]:
            assert known._fits(a, b) == (known.merged(a + b) == [a, b])


def test_bounds_change_nothing(known, monkeypatch):
    monkeypatch.setattr(token_counts, "PIECES", 3)
    monkeypatch.setattr(token_counts, "PAIRS", 3)
    monkeypatch.setattr(token_counts, "LONG", 20)
    small = token_counts.Prefixes(known.path)
    for text in [*ODD, "some more words of a text that is longer, ünd nöt ÄSCII " * 3]:
        assert small.count(text) == expected(text)
        assert small.counts(text)[-1:].tolist() == ([expected(text)] if text else [])


def test_table_and_questions(spark):
    texts = [*ODD, None, "very long " * 200_000, "=" * 200_000]
    rows = [(i if i % 5 else None, t, 1, "c") for i, t in enumerate(texts)] + [(7, "again", 1, "c")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, counts string").repartition(4)
    table = token_counts.token_counts(docs)
    asked = table.select("doc_id", "n_bytes", "n_tokens", F.size("counts").alias("chars"),
                         *[token_counts.tokens_until(k).alias(f"until{k}") for k in (0, 3, 10**7)], token_counts.fitting(4).alias("fit"))
    want = []
    for i, t, _, _ in rows:
        t = t or ""
        short = t if len(t) < 400 else t[:400]
        fit = max([k for k in range(len(short) + 1) if expected(short[:k]) <= 4])
        want.append((i, len(t.encode()), expected(t), len(t), 0, expected(t[:3]), expected(t), fit))
    assert sorted(map(tuple, asked.collect()), key=repr) == sorted(want, key=repr)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.op12_token_counts(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        n = expected(r["text"] or "")
        assert found[r["doc_id"]] == (len((r["text"] or "").encode()), n, n > 1024)


def test_query_takes_the_counts_of_all_prefixes(spark, monkeypatch):
    """Tokens come from the last of the counted prefixes, of each text."""
    asked, counts = [], token_counts.token_counts

    def seen(docs, **options):
        found = counts(docs, **options)
        asked.append(found.columns)
        return found.withColumn("counts", F.transform("counts", lambda c: c + 5))

    monkeypatch.setattr(token_counts, "token_counts", seen)
    found = {r["doc_id"]: r["n_tokens"] for r in queries.op12_token_counts(spark, "/root/testdata/sf0.001").collect()}
    assert asked == [["doc_id", "n_bytes", "n_tokens", "counts"]]
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20).collect()}
    assert all(found[i] == (expected(t) + 5 if t else 0) for i, t in texts.items())


def test_empty_table(spark):
    assert token_counts.token_counts(spark.createDataFrame([], "doc_id string, text string")).count() == 0
