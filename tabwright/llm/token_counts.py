"""Token counts of every prefix of a text, by dynamic programming over prefixes.

Of the byte-pair encodings of all prefixes of a piece (a run of letters, digits, marks or blanks, which no token crosses) only the last
token is kept: the encoding of a prefix is that of a shorter one and one more token. From left to right, of the tokens that end at
a place (an automaton finds them) exactly one fits the last token before it, in the sense that the two encode to
themselves; so each place gets its count from an earlier place, in time linear in the text. Two tokens are tried by
merging their bytes once; the answers are kept, and so are the counts of short pieces, both up to a bound.

The counts of a text's prefixes answer how many tokens a part of it takes (``tokens_until``), and how much of it fits a budget
(``fitting``), without encoding anything again. They need not rise: a longer prefix may take fewer tokens.

Counts equal those of the vocabulary's own tokenizer, without tokens added at either end; the tokens that were added to it are
recognised in texts, as it does by default. Places are those between characters. Pieces come from the tokenizer's pattern. Texts
with characters that Python does not know as assigned are cut into pieces by the tokenizer itself, whose tables may be older.

Nulls: a null text is empty and has no prefixes and no tokens. A null key is kept. Texts of any length are counted at their
whole. Equal rows give equal results, as often as they occur. An empty table gives an empty result. Other columns of the input
are not read, so that their names cannot clash.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import text_blocks, utf8

# The pattern that splits text before the merges, for texts of ASCII and for others.
ASCII = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
WIDE = regex.compile(r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
BLANKS, ASCII_BLANKS = regex.compile(r"\p{White_Space}{2,}"), re.compile(r"\s{2,}", re.ASCII)
SHORTENED = ("'ll", "'ve", "'re")

#: Pieces up to this length are remembered, at most this many of them, and at most this many pairs of tokens.
SHORT, PIECES, PAIRS = 64, 1 << 19, 1 << 19
#: Texts beyond this many characters are split piece by piece instead of all at once.
LONG = 1 << 20


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _alphabet() -> dict[str, str]:
    """The characters in which byte-level vocabularies write bytes: printable ones stand for themselves, others follow from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): chr(b) for b in shown} | {chr(256 + i): chr(b) for i, b in enumerate(hidden)}


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Totals(dict):
    """Tokens of pieces, counted when first asked for; short pieces are remembered."""

    def __init__(self, steps):
        self.steps = steps

    def __missing__(self, piece: str) -> int:
        found = self.steps(piece.encode())[-1]
        if len(piece) <= SHORT:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = found
        return found


class Prefixes:
    """A byte-level byte-pair vocabulary that counts tokens of prefixes. Bytes are held as characters below 256."""

    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        spell = _alphabet()

        def plain(token: str) -> str:
            return "".join(spell[c] for c in token)

        model = stored["model"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {(plain(a), plain(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.ranks = dict.fromkeys(map(chr, range(256)), -1) | {a + b: rank for (a, b), rank in self.merges.items()}
        self.halves = {a + b: (a, b) for a, b in self.merges}
        self.added = sorted((t["content"] for t in stored["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, self.added))) if self.added else None
        self.tokens = ahocorasick.Automaton()
        for token in self.ranks:
            self.tokens.add_word(token, token)
        self.tokens.make_automaton()
        self.path, self.fits, self.totals, self.tables, self.known = path, {}, Totals(self.steps), {}, set()

    def merged(self, text: str) -> list[str]:
        """The plain merges: always the pair of the lowest rank, the first of equal ones."""
        parts = list(text)
        while len(parts) > 1:
            rank, at = min((self.merges.get(p, sys.maxsize), i) for i, p in enumerate(zip(parts, parts[1:])))
            if rank == sys.maxsize:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fits(self, last: str, token: str) -> bool:
        """Whether the encoding of two tokens, one behind the other, is these two.

        Their merges are undone from the latest on. Never may the parts at the border be a pair that merges before what is undone
        next; of equal pairs, the left one merges first.
        """
        limit = sys.maxsize
        while self.merges.get((last, token), limit) >= limit:
            left, right = self.ranks[last], self.ranks[token]
            if left < 0 and right < 0:
                return True
            if left > right:
                limit, last = left, self.halves[last][1]
            else:
                limit, token = right + 1, self.halves[token][0]
        return False

    def _fit(self, last: str, token: str) -> bool:
        """The same, remembered; without a token before it, whether a token is the encoding of its own bytes."""
        if len(self.fits) >= PAIRS:
            self.fits.clear()
        known = self.fits[last, token] = self._fits(last, token) if last else self.merged(token) == [token]
        return known

    def steps(self, piece: bytes) -> list[int]:
        """Tokens of each prefix of a piece, the empty one first."""
        counts, last, place, known = [0], [""], 1, self.fits.get
        for end, token in self.tokens.iter(piece.decode("latin-1")):
            if end + 1 == place:
                begin = place - len(token)
                before = last[begin]
                fits = known((before, token))
                if fits or fits is None and self._fit(before, token):
                    counts.append(counts[begin] + 1)
                    last.append(token)
                    place += 1
        return counts

    def table(self, piece: str) -> np.ndarray:
        """Tokens of each prefix of a piece, at its characters' ends."""
        found = self.tables.get(piece)
        if found is None:
            raw = piece.encode()
            found = np.array(self.steps(raw)[1:], np.int32)
            if len(raw) > len(piece):
                data = np.frombuffer(raw, np.uint8)
                found = found[np.append((data[1:] & 0xC0) != 0x80, True)]
            if piece in SHORTENED:  # until its last letter is there, these are two pieces
                found = np.array([1, 2, found[-1]], np.int32)
            if len(piece) <= SHORT:
                if len(self.tables) >= PIECES:
                    self.tables.clear()
                self.tables[piece] = found
        return found

    def pieces(self, text: str) -> Iterator[str]:
        if text.isascii():
            return (m.group() for m in ASCII.finditer(text)) if len(text) > LONG else iter(ASCII.findall(text))
        if not self._assigned(text):
            return (text[a:b] for _, (a, b) in _tokenizer(self.path).pre_tokenizer.pre_tokenize_str(text))
        return (m.group() for m in WIDE.finditer(text)) if len(text) > LONG else iter(WIDE.findall(text))

    def _assigned(self, text: str) -> bool:
        """Whether Python's tables know all characters of a text."""
        new = set(text) - self.known
        fresh = {c for c in new if unicodedata.category(c) != "Cn"}
        self.known |= fresh
        return len(fresh) == len(new)

    def _segments(self, text: str) -> list[tuple[str, str]]:
        """Parts between added tokens, each with the added token behind it, which is empty behind the last."""
        out, at = [], 0
        for match in self.special.finditer(text) if self.special else ():
            out.append((text[at : match.start()], match.group()))
            at = match.end()
        return [*out, (text[at:], "")]

    def count(self, text: str) -> int:
        """Tokens of a text: the last of its prefixes alone."""
        return sum(sum(map(self.totals.__getitem__, self.pieces(part))) + bool(token) for part, token in self._segments(text))

    def counts(self, text: str) -> np.ndarray:
        """Tokens of each prefix of a text, from its first character to all."""
        out, base = [np.zeros(0, np.int32)], 0
        for part, token in self._segments(text):
            # Until an added token is whole, its characters are plain text behind the part.
            begun = self._plain(part + token[:-1])
            out.append(begun + base)
            if token:
                base += (int(begun[len(part) - 1]) if part else 0) + 1
                out.append(np.array([base], np.int32))
        return np.concatenate(out)

    def _plain(self, text: str) -> np.ndarray:
        known, tables = self.tables.get, []
        for piece in self.pieces(text):
            found = known(piece)
            tables.append(self.table(piece) if found is None else found)
        if not tables:
            return np.zeros(0, np.int32)
        # Each piece counts on from the last prefix of the one before it.
        sizes = np.fromiter(map(len, tables), np.int64, len(tables))
        out = np.concatenate(tables)
        bases = np.zeros(len(tables), np.int32)
        np.cumsum(out[np.cumsum(sizes)[:-1] - 1], out=bases[1:])
        out += np.repeat(bases, sizes)
        for run in (ASCII_BLANKS if text.isascii() else BLANKS).finditer(text):
            # A prefix that ends in blanks has them as one piece, wherever the whole text parts them.
            at, end = run.span()
            out[at:end] = self.table(text[at:end]) + (out[at - 1] if at else 0)
        return out


@cache
def prefixes(path: str) -> Prefixes:
    return Prefixes(path)


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
                 keep_counts: bool = True) -> DataFrame:
    """One row per document: key, n_bytes, n_tokens and, on demand, counts: the tokens of each prefix by its characters."""
    path = vocabulary or default_vocabulary()
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    fields = [("key", narrow.schema["key"].dataType), ("n_bytes", T.LongType()), ("n_tokens", T.LongType())]
    fields += [("counts", T.ArrayType(T.IntegerType()))] if keep_counts else []
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = prefixes(path)
        for batch in batches:
            data, bounds = utf8(batch.column("text"))
            for first, last in text_blocks(bounds):
                texts = (data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(bounds[first:last].tolist(), bounds[first + 1 : last + 1].tolist()))
                columns = [batch.column("key").slice(first, last - first), pa.array(np.diff(bounds[first : last + 1]))]
                if keep_counts:
                    all_counts = [known.counts(t) for t in texts]
                    ends = np.cumsum([0, *map(len, all_counts)], dtype=np.int64)
                    columns.append(pa.array([int(c[-1]) if len(c) else 0 for c in all_counts], pa.int64()))
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(all_counts))))
                else:
                    columns.append(pa.array([known.count(t) for t in texts], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return narrow.mapInArrow(counted, schema).withColumnRenamed("key", key)


def tokens_until(characters: Column | int, counts: str = "counts") -> Column:
    """Tokens of the first characters of a text; of all, if it has fewer."""
    wanted = F.least(F.lit(characters) if isinstance(characters, int) else characters, F.size(counts))
    return F.when(wanted > 0, F.try_element_at(F.col(counts), wanted)).otherwise(0)


def fitting(budget: Column | int, counts: str = "counts") -> Column:
    """The characters of the longest prefix that takes at most as many tokens."""
    limit = F.lit(budget) if isinstance(budget, int) else budget
    return F.coalesce(F.array_max(F.transform(F.col(counts), lambda c, i: F.when(c <= limit, i + 1).otherwise(0))), F.lit(0))
