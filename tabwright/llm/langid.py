"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased, everything between them becomes one space, and n-grams of one to three
characters are hashed into buckets. The counts are fitted on a bounded sample of labelled rows;
the matrix of log-probabilities (languages x buckets) is broadcast, and texts are scored in
batches with numpy. The size of that matrix is set by the parameters and the number of languages.

Nulls: a null text, an empty one, and one without a letter are ``und`` with score 0, as is every
text if no labelled row was given to learn from. Rows with a null language are not learned from.
Long texts are scored whole, block by block. Ties go to the first language by name. Repeated rows
are scored alike. Columns of the input that are not named are carried along by ``predict`` and
may have any names but the two it adds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import slices, unused

UNKNOWN = "und"
LETTER = r"\p{L}"
#: Characters that are worked on at a time.
STEP = 1 << 19


@dataclass(frozen=True)
class Model:
    languages: list[str]
    weights: np.ndarray  # languages x buckets, float32
    priors: np.ndarray


@cache
def _letters() -> np.ndarray:
    """For each code point itself if it is a letter, else a space."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c
    return table


def _steps(texts: list[str]) -> Iterator[tuple[str, list[int], list[int]]]:
    """Joined text of about ``STEP`` characters, the rows it holds and where they begin."""
    parts, rows, starts, size = [], [], [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text), STEP):
            piece = text[max(0, at - 2) : at + STEP] if at else text[:STEP]
            parts.append(f" {piece}")
            rows.append(row)
            starts.append(size)
            size += len(piece) + 1
            if size >= STEP:
                yield "".join(parts), rows, starts
                parts, rows, starts, size = [], [], [], 0
    if parts:
        yield "".join(parts), rows, starts


def grams(texts: list[str], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bucket numbers of n-grams, with the rows they belong to and where each row's begin."""
    shift = np.uint32(32 - (buckets.bit_length() - 1))
    for text, rows, starts in _steps([t.lower() for t in texts]):
        code = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        blank = code == 32
        keep = ~blank
        keep[1:] |= ~blank[:-1]  # the first space after a letter stays
        keep[starts] = True  # a row begins with a space
        begin = np.concatenate([[0], np.cumsum(keep)])[starts]
        code = code[keep]
        row_of = np.zeros(len(code), np.int32)
        row_of[begin[1:]] = 1
        row_of = np.cumsum(row_of)
        one = code * np.uint32(0x9E3779B1)
        two = one[:-1] * np.uint32(0x85EBCA6B) + code[1:] * np.uint32(0xC2B2AE35)
        three = two[:-1] * np.uint32(0x27D4EB2F) + code[2:] * np.uint32(0x165667B1)
        solid = code != 32
        for hashed, n, extra in ((one, 1, 1), (two, 2, 7), (three, 3, 13)):
            ok = row_of[: len(hashed)] == row_of[n - 1 :]
            ok &= solid[: len(hashed)] if n == 1 else solid[n - 2 : len(solid) - 1] | solid[n - 1 :]
            value = ((hashed[ok] ^ (hashed[ok] >> np.uint32(15))) + np.uint32(extra)) * np.uint32(0x9E3779B1) >> shift
            of = row_of[: len(hashed)][ok]
            first = np.flatnonzero(np.diff(of, prepend=-1))
            if len(of):
                yield value, np.asarray(rows)[of[first]], first


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", rows_per_language: int = 8_000,
        buckets: int = 1 << 16, smoothing: float = 0.1) -> Model:
    """Fit on about ``rows_per_language`` labelled rows of each language, drawn by a hash of the text."""
    docs = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    docs = docs.where("lang IS NOT NULL")
    known = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(known)
    if not languages:
        return Model([], np.zeros((0, buckets), np.float32), np.zeros(0))
    share = F.create_map(*(F.lit(x) for name in languages for x in (name, min(1.0, rows_per_language / known[name]))))
    drawn = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), buckets), np.int64)
        number = {name: i for i, name in enumerate(languages)}
        for batch in batches:
            of = np.array([number[x] for x in batch.column("lang").to_pylist()])
            for value, rows, first in grams([x or "" for x in batch.column("text").to_pylist()], buckets):
                each = np.repeat(of[rows], np.diff(np.append(first, len(value))))
                total += np.bincount(each * buckets + value, minlength=total.size).reshape(total.shape)
        lang_at, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang_at.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(total[lang_at, bucket])],
            names=["lang", "bucket", "n"])

    # The bounded sample is counted in a few tasks, each of which sends one row per bucket used.
    counts = drawn.repartition(6).mapInArrow(count, "lang int, bucket int, n long")
    counts = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    total = np.full((len(languages), buckets), smoothing)
    total[counts["lang"], counts["bucket"]] += counts["n"]
    prior = np.array([known[x] for x in languages], float)
    return Model(languages, np.log(total / total.sum(1, keepdims=True)).astype(np.float32), np.log(prior / prior.sum()))


def log_odds(texts: list[str], model: Model) -> np.ndarray:
    """Unnormalised log-probability of each language for each text."""
    out = np.tile(model.priors, (len(texts), 1))
    for value, rows, first in grams(texts, model.weights.shape[1]):
        for i, weight in enumerate(model.weights):
            np.add.at(out[:, i], rows, np.add.reduceat(weight[value], first, dtype=np.float64))
    return out


def predict(docs: DataFrame, model: Model, text: str = "text", label: str = "lang_pred", score: str = "score") -> DataFrame:
    """The input with the predicted language and its probability."""
    clash = {label, score} & set(docs.columns)
    if clash:
        raise ValueError(f"the input already has columns {sorted(clash)}")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    mark = "__has_letter"
    while mark in docs.columns:
        mark += "_"
    schema = T.StructType([*docs.schema, T.StructField(label, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in slices(batches, text):
            letters = np.asarray(batch.column(mark))
            found, sure = np.full(len(letters), UNKNOWN, object), np.zeros(len(letters))
            at = np.flatnonzero(letters)
            if len(at) and model.languages:
                odds = log_odds(batch.column(text).take(pa.array(at)).to_pylist(), model)
                best = odds.argmax(1)
                odds -= odds.max(1, keepdims=True)
                found[at] = np.array(model.languages, object)[best]
                sure[at] = 1.0 / np.exp(odds).sum(1)
            columns = [batch.column(c) for c in batch.schema.names if c != mark]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), pa.array(sure)], names=schema.names)

    marked = docs.withColumn(mark, F.coalesce(F.col(text).rlike(LETTER), F.lit(False)))
    return marked.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows with an identified language, in their own columns."""
    names = docs.columns
    label, score = unused(names, "language", "probability")
    found = predict(docs, model, text, label, score)
    return found.where((F.col(label) != UNKNOWN) & (F.col(score) >= least)).select(*names)
