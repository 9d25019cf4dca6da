"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.sources.staging import stage

__all__ = ["BLOCK", "PART_ROWS", "SENT_ROWS", "documents_of", "held_out", "in_one", "mix64", "placed", "slices", "stage", "text_blocks", "unsent", "unused", "utf8"]

#: Bytes of text that numpy works on at a time: temporaries then stay in the cache.
BLOCK = 1 << 20

#: Narrow rows that one task works on.
PART_ROWS = 1 << 20

#: Up to so many narrow rows are gathered by the driver and sent to all tasks for a join; more are merged where they are.
SENT_ROWS = 250_000


def in_one(df: DataFrame, rows: int, each: float = 1, most: int = PART_ROWS) -> DataFrame:
    """The frame in one partition if ``rows`` of ``each`` units are ``most`` units at most, else as it is.

    What fits one task needs no shuffle in joins and groupings; more rows are shuffled as usual. An inner join has to be
    put in one again, since Spark no longer knows that of its result. More than ``SENT_ROWS`` rows are ``unsent``, too.
    """
    return unsent(df.coalesce(1) if rows * each <= most else df, rows)


def unsent(df: DataFrame, rows: int) -> DataFrame:
    """The frame, which no join sends to all tasks by way of the driver if it has more than ``SENT_ROWS`` rows.

    Spark would judge by the size of its files, and packed numbers take ten times that in memory.
    """
    return df.hint("merge") if rows > SENT_ROWS else df


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the key's text leaves this remainder; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part


def unused(columns: Sequence[str], *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to differ from all columns."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64 over an array of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", np.uint8), bounds


def text_blocks(bounds: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold about ``limit`` bytes, longer rows alone."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 * BLOCK) -> Iterator[pa.RecordBatch]:
    """Batches in parts that hold about ``limit`` bytes of text, longer texts alone: what is made of a part is as bounded."""
    for batch in batches:
        for first, last in text_blocks(utf8(batch.column(text))[1], limit):
            yield batch.slice(first, last - first)


def documents_of(data: np.ndarray, bounds: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows ``first`` to ``last`` with a space after each, and where each begins."""
    sizes = np.diff(bounds[first : last + 1])
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(int(starts[-1]), 32, np.uint8)
    for i in range(last - first):
        a = int(bounds[first + i])
        out[starts[i] : starts[i] + sizes[i]] = data[a : a + int(sizes[i])]
    return out, starts


def placed(rows: DataFrame, group: list[str], start: str = "start") -> DataFrame:
    """Where the rows of each (group, part) begin among all rows of the group.

    ``rows`` holds a column ``part`` for the task that wrote a row. The running sum goes over
    one row per group and part, not over the rows themselves.
    """
    from pyspark.sql import Window

    counts = rows.groupBy(*group, "part").agg(F.count("*").alias("rows"))
    before = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(start, F.coalesce(F.sum("rows").over(before), F.lit(0)).cast("long"))
