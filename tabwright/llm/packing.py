"""Best-fit packing of documents into sequences, bulk-synchronously.

A document longer than a sequence is cut into full pieces, the first piece taking the rest; full
pieces fill a sequence each. The other pieces are packed in rounds. Range-sorted by length, pieces
are runs of equal length, and open sequences are runs of equal gap; lengths and gaps lie between
1 and the sequence length, so the run tables stay small whatever the number of documents. In a
round, runs of pieces sweep over the runs of gaps, each to its successor: the smallest gap that
holds it. Where several runs want one gap, ranks decide: longer pieces come first, and the piece
of rank r within its run takes the gap of rank r within its. Gaps shrink by what they took, new
sequences open for what found none, and rounds repeat until no piece is left. The rounds work
on run tables; the pieces themselves are ranked and placed on Spark, by a join of each piece's
rank with the interval of ranks that its run was given.

Nulls: a null text is an empty document, which is the end token alone. A null id is kept as it
is. Equal rows are packed as often as they occur. An empty table gives an empty result. Other
columns of the input are not read. Texts of any length are encoded whole, and cut into as many pieces as they need. Token ids come from a byte-pair vocabulary given as ranks. Tokens that were added to it
are recognised in texts if they are given (``added``), as its own tokenizer does by default; otherwise they are plain text.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import BLOCK, placed, slices, stage

# Fixed value: the pattern that splits text before the merges, in its form without backtracking.
PATTERN = (r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s")
END = 2
#: The token that was added to the default vocabulary, with its id.
ADDED = (("<|endoftext|>", 50256),)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@cache
def encoder(path: str, added: tuple[tuple[str, int], ...] = ()):
    """Ids of a text by the ranks in ``path``: the same ids as the vocabulary's own tokenizer gives.

    With its ``added`` tokens they are those of its default settings, without those of ``encode_special_tokens``.
    """
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=dict(added))
    return partial(encoding.encode, allowed_special="all") if added else encoding.encode_ordinary


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece; only the first may be shorter than a full one."""
    first = total % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, total, capacity))]


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rounds over run tables: (length, first rank, ranks, first sequence, offset) of each match.

    ``counts`` holds how many pieces there are of each length. Sequences of one run are numbered
    consecutively and all have the same gap.
    """
    left = {length: n for length, n in counts.items() if n}
    given: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of (first sequence, number)
    opened, out = 0, []
    while left:
        # The sweep: pieces from the longest run down, each to the smallest gap that holds it.
        sizes, taken = sorted(gaps), []
        wants: dict[int, list[int]] = defaultdict(list)
        for length in sorted(left, reverse=True):
            at = bisect_left(sizes, length)
            if at < len(sizes):
                wants[sizes[at]].append(length)
        if not wants:
            # No gap holds any piece: the longest run opens sequences of its own.
            # As many as the run fills on its own; the rest of it sweeps again in the next round.
            length = max(left)
            n = -(-left[length] // (capacity // length))
            out.append((length, given[length], n, opened, 0))
            given[length] += n
            left[length] -= n
            if not left[length]:
                del left[length]
            if length < capacity:
                gaps[capacity - length].append((opened, n))
            opened += n
            continue
        # Conflicts: of the runs that want a gap, the longest is served first, by rank.
        for gap, lengths in wants.items():
            runs = gaps.pop(gap)
            for length in lengths:
                while runs and left.get(length):
                    first, n = runs.pop()
                    use = min(n, left[length])
                    out.append((length, given[length], use, first, capacity - gap))
                    given[length] += use
                    left[length] -= use
                    taken.append((gap - length, first, use))
                    if use < n:
                        runs.append((first + use, n - use))
                if not left.get(length):
                    left.pop(length, None)
            if runs:
                gaps[gap].extend(runs)
        for gap, first, n in taken:
            if gap:
                gaps[gap].append((first, n))
    return out


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 1024, vocabulary: str | None = None,
           keep_ids: bool = False, added: tuple[tuple[str, int], ...] = ()) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, part and rank in (part, length); on demand its ids."""
    path = vocabulary or default_vocabulary()
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    fields = [("key", narrow.schema["key"].dataType), ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()),
              ("ids_crc32", T.LongType()), ("part", T.IntegerType()), ("nth", T.LongType())]
    fields += [("ids", T.ArrayType(T.IntegerType()))] if keep_ids else []
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seen = encoder(path, added), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        # Ids take many times the bytes of a text as Python's numbers: few texts at a time, and what is kept as an array.
        for batch in slices(batches, "text", BLOCK):
            row, number, start, length, crc, nth, kept = [], [], [], [], [], [], []
            for i, body in enumerate(batch.column("text")):
                ids = encode(body.as_py() or "")
                ids.append(END)
                ids = np.array(ids, "<i4")
                raw = ids.tobytes()
                for k, (at, n) in enumerate(cut(len(ids), capacity)):
                    row.append(i)
                    number.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(raw[4 * at : 4 * (at + n)]))
                    nth.append(seen[n])
                    seen[n] += 1
                    if keep_ids:
                        kept.append(ids[at : at + n])
            columns = [batch.column("key").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(np.full(len(row), part, np.int32)), pa.array(nth, pa.int64())]
            if keep_ids:
                ends = np.cumsum([0, *length], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(kept)) if kept else pa.array([], pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return narrow.mapInArrow(split, schema)


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 1024, vocabulary: str | None = None,
         keep_ids: bool = True, added: tuple[tuple[str, int], ...] = ()) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset; on demand its ids."""
    rows = stage(pieces(docs, key, text, capacity, vocabulary, keep_ids, added))
    spark = docs.sparkSession
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    # At most one row per pair of a length and a gap: bounded by the capacity, not by the input.
    matches = spark.createDataFrame(plan(counts, capacity), "length long, rank_from long, ranks long, sequence_from long, offset long")
    # Within a run, pieces are ranked per writing task, and a task's ranks begin where the ones before end.
    first = placed(rows, ["length"], "rank_before").select("length", "part", "rank_before", "rows")
    m, p = matches.alias("m"), first.alias("p")
    # The ranks that a task has of one length fall into few intervals; each piece then finds its own.
    spans = p.join(m, (F.col("p.length") == F.col("m.length")) & (F.col("rank_from") < F.col("rank_before") + F.col("rows"))
                   & (F.col("rank_from") + F.col("ranks") > F.col("rank_before")))
    spans = spans.groupBy("p.length", "part", "rank_before").agg(
        F.array_sort(F.collect_list(F.struct("rank_from", "sequence_from", "offset"))).alias("spans"))
    joined = rows.join(spans, ["length", "part"]).withColumn("rank", F.col("rank_before") + F.col("nth"))
    found = joined.withColumn("match", F.expr("element_at(filter(spans, s -> s.rank_from <= rank), -1)"))
    more = ["ids"] if keep_ids else []
    return found.select(
        F.col("key").alias(key), "piece", "start", "length", "ids_crc32",
        (F.col("match.sequence_from") + F.col("rank") - F.col("match.rank_from")).alias("sequence_id"),
        F.col("match.offset").cast("long").alias("offset"), *more)
