"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence gets a probability from the words and word
beginnings in it; the noisy-or of these, 1 - prod(1 - p), is the document's. The weights are
trained from labels of documents alone, through that noisy-or, and afterwards tell which
sentences offend (``offending``).

Fitting takes a bounded sample of labelled rows. One pass counts in how many documents of either
label each hashed feature occurs; those that tell the labels apart are kept. A second pass reduces
the sample to the kept features per sentence, on which the weights are found by gradient descent.
Scoring reads every whole text, sentence by sentence, in numpy.

Nulls: a null or empty text, or one without a word, has score 0. Rows without a label are not
learned from; with no labelled row every score is 0. Repeated rows score alike. Columns of the
input that are not named are carried along by ``score`` and may have any name but those it adds.
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

from tabwright.llm.common import BLOCK, documents_of, mix64, slices, text_blocks, unused, utf8

#: Bytes of a word's beginning that make a feature, besides the whole word.
PREFIXES = (4, 5, 6, 7, 8)
FEATURE_BITS = 20
THRESHOLD = 0.7


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per byte: its value in the hash, whether it belongs to a word, whether it ends a sentence; powers."""
    byte = np.arange(256)
    low = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    word = ((low >= 97) & (low <= 122)) | ((byte >= 48) & (byte <= 57)) | (byte >= 128) | (byte == 39)
    ends = np.isin(byte, [10, 13, 33, 46, 63])
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    n = 2 * BLOCK
    power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]))
    back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, inverse, np.uint64)]))
    return mix64(low.astype(np.uint64) + np.uint64(1)), word, ends, power, back


def _pieces(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of text with the rows in them and where each begins; long rows come in several,
    cut after a sentence where one ends in the last half of the block, else after a word."""
    _, word, ends, _, _ = _tables()
    for first, last in text_blocks(bounds):
        if last - first > 1 or bounds[last] - bounds[first] <= BLOCK:
            block, starts = documents_of(data, bounds, first, last)
            yield block, np.arange(first, last), starts[:-1]
            continue
        at, stop = int(bounds[first]), int(bounds[last])
        while at < stop:
            piece = data[at : min(stop, at + BLOCK)]
            if at + len(piece) < stop:
                half = len(piece) // 2
                for marks in (ends[piece[half:]], ~word[piece[half:]]):
                    if marks.any():
                        piece = piece[: half + int(np.flatnonzero(marks)[-1]) + 1]
                        break
            at += len(piece)
            yield np.append(piece, np.uint8(32)), np.array([first]), np.array([0])


def features(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Hashed features with the sentence of each, the row of each sentence, and its span in the block's row."""
    value, word, ends, power, back = _tables()
    shift = np.uint64(64 - FEATURE_BITS)
    for block, rows, begin in _pieces(data, bounds):
        inside = word[block]
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(start):
            continue
        breaks = ends[block].astype(np.int32)
        breaks[begin] = 1  # each row begins a sentence
        sentence_at = np.cumsum(breaks)[start]
        first = np.flatnonzero(np.diff(sentence_at, prepend=-1))
        sentence = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(start))))
        row = rows[np.searchsorted(begin, start[first], "right") - 1]
        sums = np.concatenate([[np.uint64(0)], np.cumsum(value[block] * power[: len(block)], dtype=np.uint64)])
        whole = mix64((sums[stop] - sums[start]) * back[start]) >> shift
        found, of = [whole], [sentence]
        for n in PREFIXES:
            long = stop - start > n
            at = start[long]
            found.append(mix64((sums[at + n] - sums[at]) * back[at] + np.uint64(n)) >> shift)
            of.append(sentence[long])
        yield np.concatenate(found).astype(np.int64), np.concatenate(of), row, start[first], stop[np.append(first[1:], len(start)) - 1]


@dataclass(frozen=True)
class Model:
    kept: np.ndarray     # hashed features, sorted
    weights: np.ndarray  # one per kept feature
    bias: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << FEATURE_BITS, np.float32)
        out[self.kept] = self.weights
        return out


def _bags(batch: pa.RecordBatch, keep: np.ndarray) -> Iterator[tuple[int, list[int], list[int], int]]:
    """Per row: kept features, their sentences (numbered among those with any), sentences in all."""
    data, bounds = utf8(batch.column("text"))
    n = len(bounds) - 1
    total, found = np.zeros(n, np.int64), [[] for _ in range(n)]
    before = 0  # sentences are numbered through all blocks of the batch
    for hashed, of, row, _, _ in features(data, bounds):
        np.add.at(total, row, 1)
        hit = keep[hashed]
        pairs = np.unique(np.stack([of[hit], hashed[hit]], 1), axis=0)
        for sentence, feature in pairs.tolist():
            found[row[sentence]].append((before + sentence, feature))
        before += len(row)
    for i in range(n):
        names = {s: k for k, s in enumerate(dict.fromkeys(s for s, _ in found[i]))}
        yield i, [f for _, f in found[i]], [names[s] for s, _ in found[i]], int(total[i])


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", max_rows: int = 20_000, max_features: int = 1_024,
        least: int = 5, rounds: int = 400, rate: float = 0.3, decay: float = 1e-4) -> Model:
    """Fit on about ``max_rows`` labelled rows, drawn by a hash of the text."""
    rows = labelled.select(F.col(text).cast("string").alias("text"), F.col(label).cast("int").alias("label")).where("label IS NOT NULL")
    n = rows.count()
    rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < F.lit(min(1.0, max_rows / max(n, 1)) * (1 << 20))).repartition(6)
    size = 1 << FEATURE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs = np.zeros((2, size), np.int32), np.zeros(2, np.int64)
        for batch in batches:
            labels = np.minimum(np.asarray(batch.column("label")), 1)
            data, bounds = utf8(batch.column("text"))
            docs += np.bincount(labels, minlength=2)
            for hashed, of, row, _, _ in features(data, bounds):
                pairs = np.unique(row[of] * size + hashed)
                np.add.at(seen, (labels[pairs // size], pairs % size), 1)
        at = np.flatnonzero(seen.sum(0) >= 2)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(seen[0, at], docs[0]).astype(np.int64)),
                                          pa.array(np.append(seen[1, at], docs[1]).astype(np.int64))], names=["feature", "n0", "n1"])

    counts = rows.mapInArrow(count, "feature long, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    docs = counts.where("feature = -1").first()
    if docs is None or not docs["n0"] + docs["n1"]:
        return Model(np.zeros(0, np.int64), np.zeros(0), -50.0)
    # How far a feature's share among labelled documents lies above chance, in standard errors.
    share = F.lit(docs["n1"] / (docs["n0"] + docs["n1"]))
    both = F.col("n0") + F.col("n1")
    gap = (F.col("n1") - both * share) / F.sqrt(both * share * (1 - share) + 1)
    kept = counts.where((F.col("feature") >= 0) & (both >= least)).withColumn("gap", gap).where("gap > 4")
    kept = np.sort(np.array([r["feature"] for r in kept.orderBy(F.desc("gap"), "feature").limit(max_features).collect()], np.int64))
    keep = np.zeros(size, bool)
    keep[kept] = True

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, out = batch.column("label").to_pylist(), []
            for i, found, sentence, total in _bags(batch, keep):
                out.append((min(labels[i], 1), found, sentence, total))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("label", "features", "sentences", "total"), x, strict=True)) for x in out],
                pa.schema([("label", pa.int32()), ("features", pa.list_(pa.int64())), ("sentences", pa.list_(pa.int64())), ("total", pa.int64())]))

    bags = rows.mapInArrow(reduce, "label int, features array<long>, sentences array<long>, total long").toPandas()
    return _train(bags, kept, rounds, rate, decay)


def _train(bags, kept: np.ndarray, rounds: int, rate: float, decay: float) -> Model:
    """Adam on the log-likelihood of the noisy-or. Sentences without a kept feature share one probability."""
    y, total = bags["label"].to_numpy(float), bags["total"].to_numpy(float)
    column = np.concatenate([np.searchsorted(kept, np.asarray(f, np.int64)) for f in bags["features"]] or [np.zeros(0)]).astype(np.int64)
    used = np.array([len(set(s)) for s in bags["sentences"]])
    offset = np.cumsum(used) - used
    sentence = np.concatenate([np.asarray(s, np.int64) + o for s, o in zip(bags["sentences"], offset, strict=True)] or [np.zeros(0)]).astype(np.int64)
    doc = np.repeat(np.arange(len(y)), used)
    w, b = np.ones(len(kept)), -5.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-(np.bincount(sentence, w[column], len(doc)) + b)))
        p0 = 1 / (1 + np.exp(-b))
        clean = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y)) + (total - used) * np.log1p(-p0)
        none = np.exp(clean)
        outer = np.where(y > 0, none / np.maximum(1 - none, 1e-6), -1.0)  # of the log-likelihood by -clean
        inner = outer[doc] * p
        grad = np.append(np.bincount(column, inner[sentence], len(w)), inner.sum() + (outer * (total - used) * p0).sum()) / max(len(y), 1)
        grad[:-1] -= decay * w
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8) * min(1.0, 2 * (1 - t / (rounds + 1)))
        w, b = w + step[:-1], b + step[-1]
    return Model(kept, w, float(b))


def _sentences(data: np.ndarray, bounds: np.ndarray, table: np.ndarray, bias: float) -> Iterator[tuple[np.ndarray, ...]]:
    for hashed, of, row, start, stop in features(data, bounds):
        # A word that occurs twice in a sentence counts once, as in training.
        hit = np.flatnonzero(table[hashed])
        pairs = np.unique(of[hit] * (1 << FEATURE_BITS) + hashed[hit])
        total = np.bincount(pairs >> FEATURE_BITS, table[pairs & ((1 << FEATURE_BITS) - 1)], len(row))
        yield 1 / (1 + np.exp(-(total + bias))), row, start, stop


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score", predicted: str = "predicted",
          threshold: float = THRESHOLD) -> DataFrame:
    """The input with the noisy-or of its sentences and whether that reaches the threshold."""
    clash = {name, predicted} & set(docs.columns)
    if clash:
        raise ValueError(f"the input already has columns {sorted(clash)}")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema, T.StructField(name, T.DoubleType()), T.StructField(predicted, T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = sent.value.table(), sent.value.bias
        for batch in slices(batches, text):
            data, bounds = utf8(batch.column(text))
            clean = np.zeros(len(batch))
            for p, row, _, _ in _sentences(data, bounds, table, bias):
                np.add.at(clean, row, np.log1p(-np.minimum(p, 1 - 1e-12)))
            toxic = -np.expm1(clean)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(toxic), pa.array((toxic >= threshold).astype(np.int32))], names=schema.names)

    return docs.mapInArrow(run, schema)


def offending(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """The sentences whose own probability reaches ``least``: key, sentence text, probability."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", narrow.schema["key"].dataType), T.StructField("sentence", T.StringType()),
                           T.StructField("probability", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = sent.value.table(), sent.value.bias
        for batch in batches:
            keys, words, chances = [], [], []
            for i, body in enumerate(batch.column("text")):
                data, bounds = utf8(pa.array([body.as_py()], pa.string()))
                for block, rows, begin in _pieces(data, bounds):
                    one = np.array([0, len(block)])
                    for p, _, start, stop in _sentences(block, one, table, bias):
                        for k in np.flatnonzero(p >= least):
                            keys.append(i)
                            words.append(bytes(block[start[k] : stop[k]]).decode("utf-8", "replace"))
                            chances.append(float(p[k]))
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(keys, pa.int64())), pa.array(words, pa.string()),
                                              pa.array(chances, pa.float64())], names=["key", "sentence", "probability"])

    return narrow.mapInArrow(run, schema).withColumnRenamed("key", key)


def keep_clean(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows below the threshold, in their own columns."""
    names = docs.columns
    chance, toxic = unused(names, "toxicity", "is_toxic")
    return score(docs, model, text, chance, toxic, threshold).where(F.col(toxic) == 0).select(*names)
