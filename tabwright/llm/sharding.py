"""Shards by jump consistent hashing.

The shard of a row follows from its key and the number of shards alone, without a ring table:
with one more shard, a row stays or moves to the new shard. Size and shard need one narrow
pass; slots (places within a shard) are counted per writing task, and the counts of all tasks
are added up, so that no shard's rows meet in one task.

Nulls: a null key is a key like any other; a null text has size 1 and the checksum of an empty
text. Rows repeat as often as they occur, each with a slot of its own. An empty table gives an
empty result. Other columns of the input are not read, so that their names cannot clash. Texts of any
length are measured whole. Equal keys share a shard; their slots follow the order of writing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import mix64, placed, stage

# Fixed values of the published algorithm: the multiplier of its generator.
MULTIPLIER = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key: only rows that still jump are worked on."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state, shard = keys.astype(np.uint64).copy(), np.zeros(len(keys), np.int64)
    moving, place = np.arange(len(keys)), np.zeros(len(keys), np.int64)
    while len(moving):
        shard[moving] = place[moving]
        state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        draw = ((state[moving] >> np.uint64(33)) + np.uint64(1)).astype(np.float64)
        place[moving] = ((shard[moving] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        moving = moving[place[moving] < shards]
    return shard


def assign(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 16) -> DataFrame:
    """One row per document: key, size, text_crc32, law, shard, slot, grown_shard."""
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(key).alias("key"), (F.length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
        F.xxhash64(F.col(key)).alias("hash"),
    )
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.drop("hash").schema)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(shards, np.int64)
        for batch in batches:
            keys = mix64(np.asarray(batch.column("hash")).astype(np.int64).view(np.uint64))
            now, grown = jump(keys, shards), jump(keys, shards + 1)
            order = np.argsort(now, kind="stable")
            counts = np.bincount(now, minlength=shards)
            nth = np.empty(len(now), np.int64)
            nth[order] = np.arange(len(now)) - np.repeat(np.cumsum(counts) - counts, counts)
            nth += seen[now]
            seen += counts
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "size", "text_crc32")), pa.array(now.astype(np.int32)),
                 pa.array(grown.astype(np.int32)), pa.array(np.full(len(now), part, np.int32)), pa.array(nth)],
                names=["key", "size", "text_crc32", "shard", "grown_shard", "part", "nth"],
            )

    rows = stage(narrow.mapInArrow(place, f"{fields}, shard int, grown_shard int, part int, nth long"))
    starts = placed(rows, ["shard"]).select("shard", "part", "start")
    return rows.join(starts, ["shard", "part"]).select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("nth")).alias("slot"), "grown_shard",
    )
