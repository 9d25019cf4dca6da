"""Sharding: the published algorithm, one row at a time, and slots without gaps."""

from __future__ import annotations

import zlib

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from tabwright.llm import sharding


def plain(key: int, shards: int) -> int:
    bucket, place = -1, 0
    while place < shards:
        bucket = place
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        place = int((bucket + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return bucket


@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=30), st.integers(1, 300))
def test_equals_the_plain_form(keys, shards):
    found = sharding.jump(np.array(keys, np.uint64), shards)
    assert found.tolist() == [plain(k, shards) for k in keys]
    grown = sharding.jump(np.array(keys, np.uint64), shards + 1)
    assert all(a == b or b == shards for a, b in zip(found, grown, strict=True))


def test_assign(spark):
    rows = [(i, f"text {i} ünï" if i % 7 else None, i, "x") for i in range(2000)] + [(None, "", 1, "x"), (None, "again", 1, "x")] + [(5, "copy", 1, "x")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, key string")
    found = sharding.assign(docs.repartition(6), shards=16).toPandas()
    assert len(found) == len(rows) and found["law"].eq("key").all() and found["shard"].between(0, 15).all()
    for _, group in found.groupby("shard"):
        assert sorted(group["slot"]) == list(range(len(group)))
    moved = found[found["shard"] != found["grown_shard"]]
    assert moved["grown_shard"].eq(16).all() and len(moved) > 0
    again = sharding.assign(docs.repartition(2), shards=16).toPandas()
    both = [sorted(zip(f["doc_id"].fillna(-1), f["shard"], f["size"], f["text_crc32"], strict=True)) for f in (found, again)]
    assert both[0] == both[1] and found.groupby(found["doc_id"].fillna(-1))["shard"].nunique().eq(1).all()
    want = sorted((-1 if i is None else i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert sorted(zip(found["doc_id"].fillna(-1), found["size"], found["text_crc32"], strict=True)) == want


def test_empty_table(spark):
    assert sharding.assign(spark.createDataFrame([], "doc_id string, text string")).count() == 0
