"""Fill-in-the-middle: texts cut into prefix, middle and suffix at boundaries of units, with a wavelet matrix.

Every byte of a text is of one class, by what it ends: nothing (inside a character), a character, a word with its blanks,
a line, or a line and a word. A wavelet matrix over these classes answers how many bytes of a class lie before a
place (rank) with three bit vectors. Ranks of several classes add up to counts of boundaries: lines are ended by two
of the classes, words by two, characters by four. The place after the u-th unit is found by bisection on such counts.
One matrix serves the texts of about a megabyte together, and all their cuts move in step; a longer text has a
matrix of its own, which takes less than twice its size.

A draw per document, from a hash of seed and key, chooses cuts and order; it does not depend on the layout of the input.
A text without units, or one that holds a marker, stays plain, so that every output can be taken apart again.

Nulls: a null text is empty; a null key draws as empty text. Texts of any length are cut at their whole. Both cuts may fall on
one place, also on either end: parts may be empty. Equal rows give equal results, as often as they occur. An empty table
gives an empty result. Other columns of the input are not read, so that their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import text_blocks, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: What a byte ends: nothing, a character, a word as well, a line, a line and a word.
INNER, CHARACTER, WORD, LINE, LINE_AND_WORD = range(5)
#: The classes whose bytes end a unit.
UNITS = {"char": (CHARACTER, WORD, LINE, LINE_AND_WORD), "word": (WORD, LINE_AND_WORD), "line": (LINE, LINE_AND_WORD)}
LEVELS = 3


class WaveletMatrix:
    """Ranks over symbols below 2^levels: per level a bit vector, stably sorted by the bits above it."""

    def __init__(self, symbols: np.ndarray, levels: int = LEVELS):
        self.size, self.levels = len(symbols), []
        for bit in reversed(range(levels)):
            ones = (symbols >> bit & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.zeros(len(packed) // 8 + 1, "<u8")
            words.view(np.uint8)[: len(packed)] = packed
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
            self.levels.append((bit, words, before, self.size - int(before[-1])))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        return before[word] + np.bitwise_count(words[word] & ((np.uint64(1) << rest) - np.uint64(1)))

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of the symbols before each place are this one."""
        ends = np.append(np.asarray(at, np.int64), 0)  # the last one follows where the symbol's own range begins
        for bit, words, before, zeros in self.levels:
            ones = self._ones(words, before, ends)
            ends = zeros + ones if symbol >> bit & 1 else ends - ones
        return ends[:-1] - ends[-1]

    def count(self, symbols: tuple[int, ...], at: np.ndarray) -> np.ndarray:
        return sum(self.rank(s, at) for s in symbols)

    def after(self, symbols: tuple[int, ...], nth: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place behind the nth of these symbols from ``low`` on, at most ``high``: by bisection on counts."""
        wanted, low, high = self.count(symbols, low) + nth, low.copy(), high.copy()
        while (low < high).any():
            middle = (low + high) >> 1
            short = self.count(symbols, middle) < wanted
            low, high = np.where(short & (low < high), middle + 1, low), np.where(short, high, middle)
        return low


def classes(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The class of each byte of UTF-8 texts that lie one behind the other."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    inner, more = np.zeros(len(data), bool), np.zeros(len(data), bool)
    inner[:-1] = (data[1:] & 0xC0) == 0x80
    more[:-1] = blank[1:]
    last = bounds[1:][np.diff(bounds) > 0] - 1
    more[last] = inner[last] = False
    out = np.where(inner, INNER, CHARACTER).astype(np.uint8)
    out[data == 10] = LINE
    out[blank & ~more] += 1
    return out


def restored(output: bytes, form: str) -> bytes:
    """The text from which an output was made."""
    if form == "plain":
        return output
    # Markers begin with their only "<", so that none can be found across the end of a part.
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    at, end = output.index(second), output.index(MIDDLE)
    parts = {first: output[len(first) : at], second: output[at + len(second) : end]}
    return parts[PREFIX] + output[end + len(MIDDLE) :] + parts[SUFFIX]


def draws(key: Column, seed: int) -> list[Column]:
    """Four unsigned numbers of 32 bits that follow from seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", unit: str = "line", seed: int = 7, rate: int = 100,
              spm: int = 50, keep_output: bool = True) -> DataFrame:
    """One row per document: key, n, form, prefix_chars, middle_chars, output (on demand), output_sha256, restored_sha256.

    ``rate`` per cent of the texts are rearranged, ``spm`` per cent of these with the suffix first.
    """
    ends = UNITS[unit]
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), *draws(F.col(key), seed))
    fields = [("key", narrow.schema["key"].dataType), ("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()),
              ("middle_chars", T.LongType()), ("output_sha256", T.StringType()), ("restored_sha256", T.StringType())]
    fields += [("output", T.StringType())] if keep_output else []
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def block(data: np.ndarray, bounds: np.ndarray, h: np.ndarray) -> tuple[list, ...]:
        matrix, begin, end = WaveletMatrix(classes(data, bounds)), bounds[:-1], bounds[1:]
        counts = matrix.count(ends, bounds)
        full = np.diff(counts)
        # A last unit may lack its end.
        n = full + ((begin < end) & (matrix.count(ends, np.maximum(end - 1, 0)) == counts[1:]))
        one, two = h[0] % (n + 1), h[1] % (n + 1)
        taken = np.concatenate([np.minimum(one, two), np.maximum(one, two)])
        cuts = matrix.after(ends, taken, np.tile(begin, 2), np.tile(end, 2))
        places = np.stack([begin, *cuts.reshape(2, -1), end])
        chars = np.diff(np.stack([matrix.count(UNITS["char"], p) for p in places[:3]]), axis=0)
        forms, outputs, digests, backs = [], [], [], []
        raw = data.tobytes()
        for i, (a, b, c, d) in enumerate(places.T.tolist()):
            whole = raw[a:d]
            plain = not whole or h[2, i] % 100 >= rate or any(mark in whole for mark in (PREFIX, SUFFIX, MIDDLE))
            form = "plain" if plain else "spm" if h[3, i] % 100 < spm else "psm"
            before, behind = PREFIX + raw[a:b], SUFFIX + raw[c:d]
            output = whole if plain else b"".join([*([behind, before] if form == "spm" else [before, behind]), MIDDLE, raw[b:c]])
            forms.append(form)
            digests.append(hashlib.sha256(output).hexdigest())
            backs.append(hashlib.sha256(restored(output, form)).hexdigest())
            if keep_output:
                outputs.append(output)
        shown = [[None if f == "plain" else int(x) for f, x in zip(forms, row, strict=True)] for row in chars]
        return n, forms, *shown, digests, backs, outputs

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8(batch.column("text"))
            h = np.stack([batch.column(f"h{i}").to_numpy() for i in range(1, 5)])
            for first, last in text_blocks(bounds):
                low, high = int(bounds[first]), int(bounds[last])
                *found, outputs = block(data[low:high], bounds[first : last + 1] - low, h[:, first:last])
                columns = [batch.column("key").slice(first, last - first),
                           *[pa.array(c, k) for c, k in zip(found, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)]]
                columns += [pa.array(outputs, pa.binary()).cast(pa.string())] if keep_output else []
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return narrow.mapInArrow(cut, schema).withColumnRenamed("key", key)
