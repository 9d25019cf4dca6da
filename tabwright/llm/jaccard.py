"""Exact n-gram Jaccard self-join of documents: size-aware, heavy-light.

A document's set holds its distinct shingles of ``words`` words. Equal sets are one node from the
start. A threshold num/den asks two sets of a and b shingles to share at least
num * (a + b) / (num + den) of them, and all nodes with enough in common are found:

* Light sets, below a boundary in size, enumerate their subsets of each fixed size that a partner
  could ask for; two light sets link only if they have such a subset in common.
* Heavy sets are entered into inverted lists and scan these. A pair has to share one of the
  first n - least overlap + 1 shingles of either set in any common order, so these alone are entered;
  the order goes by how many sets hold a shingle, rarest first, so that passages which many
  documents share come last. Light sets near the boundary are entered as well.
* The boundary is the size at which enumerating, summed over all sets, costs least: it weighs
  subsets to enumerate against entries and the mean length of a list.

The order puts first the shingles of a part of all hashes, ``SHARE``. How many sets hold one of
these is counted exactly, by one shuffle of (shingle, set): it grows with the input and needs no table that does. What
only one set holds is dropped there and comes first of all, so that a set with enough of it enters no list. The rest of the
hashes follows, and is entered by sets that have too little of the part. Shingles that make up more than one in ``HOT_PART``
of all are found before by hashed counters, at most ``HOT_PART`` of these: they are dealt out in ``SALTS`` parts, kept
without a count and come last in their part. Counts above ``HELD`` count as that. All this decides the order and the plan
alone; any order gives the same links.

Lists may be long, and their pairs are not written out. In a round, each list's members are compared
with one hub; what links becomes one component, and a list whose members are in one component
is done. The hub is the member with the fewest rarer shingles, hence with the fewest of its own. Two members
are a pair only if what follows the shared shingle in their order can still be enough. A list that is still open then and holds more than ``SHORT``
members is split: all its members are compared with one hub, and enter new lists by the shingles in which they differ from it, the ones that are rarest among
those who met that hub first. Sets that link, but not both with the hub, have such a shingle in common; near copies of one text differ in few places, so
that they meet only where they were changed alike. New lists that are long are split again, ``SPLIT_ROUNDS`` times at most. Then pairs that are still in
different components are compared: in a list of up to ``SHORT`` members at most half of that for each, in one that is still longer all of them. Every pair is
verified on its whole sets.

Words are runs of bytes other than the ASCII blanks, with A-Z lowered. Shingles and sets are held as
64-bit hashes; a text, however long, may have up to 2^28 different shingles. Nulls: a null text has an empty set, like a text without words: size 0, linked with
nothing. With fewer words than a shingle has, the whole sequence is one shingle. A null id is kept,
and counts for a component only where all its ids are null. Equal rows share a node. An empty
table gives an empty result. Other columns are not read by ``components``.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.common import SENT_ROWS, documents_of, in_one, mix64, slices, stage, text_blocks, unsent, unused, utf8
from tabwright.llm.components import connected

#: Counters that find hot shingles, as a power of two, and per row of them.
COUNTER_BITS, CHUNK_BITS = 20, 14
#: A shingle is hot if it is more than one in so many, and more than so many rows; its rows are dealt out in so many parts.
HOT_PART, HOT_ROWS, SALTS = 4096, 1024, 64
#: The part of all hashes that is counted: more costs shuffle, less lets more sets into the lists.
SHARE = 0.5
#: Sets of one shingle that a task holds in order to count them.
HELD = 1 << 20
#: Smallest hashes from which the number of different shingles is estimated.
SMALLEST = 256
#: Rounds in which lists are compared with a hub, before what is left of them is split or compared in pairs.
HUB_ROUNDS = 3
#: Rounds in which lists of more than so many members are split by what their members differ in from a hub.
SPLIT_ROUNDS, SHORT = 4, 32
#: Sets that a task remembers in order to enter copies once.
SEEN = 100_000
#: Sets above this size are heavy at any cost.
LIGHT_LIMIT = 40
#: Bytes of text that are hashed at a time, and shingles that are counted at a time.
BLOCK, COUNTED = 1 << 18, 1 << 20
#: Shingles of whole sets that a task holds.
PART_SHINGLES = 1 << 23
U = np.uint64


@cache
def _bytes() -> tuple[np.ndarray, np.ndarray]:
    byte = np.arange(256)
    low = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
    return mix64(low.astype(U) + U(11)), ~((byte == 32) | ((byte >= 9) & (byte <= 13)))


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    out = []
    for x in (base, pow(base, -1, 1 << 64)):
        out.append(np.multiply.accumulate(np.concatenate([[U(1)], np.full(1 << bits, U(x))])))
    return out[0], out[1]


def _word_hashes(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of a block and where it begins."""
    value, inside = _bytes()
    power, back = _powers(max(19, int(len(block)).bit_length()))
    edge = np.diff(inside[block].view(np.int8), prepend=np.int8(0), append=np.int8(0))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.concatenate([[U(0)], np.cumsum(value[block] * power[: len(block)], dtype=U)])
    return mix64((sums[stop] - sums[start]) * back[start] + (stop - start).astype(U)), start


def _shingles(hashes: np.ndarray, words: int) -> np.ndarray:
    n = min(words, len(hashes))
    total = np.full(len(hashes) - n + 1, U(n) * U(0xD6E8FEB86659FD93))
    for k in range(n):
        total += mix64(hashes[k : len(hashes) - n + 1 + k] + U(k)) * U(2 * k + 0x9E3779B1)
    return mix64(total)


def sets(data: np.ndarray, bounds: np.ndarray, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row with its distinct shingles, sorted; rows without words are left out."""
    blank = ~_bytes()[1]
    for first, last in text_blocks(bounds, BLOCK):
        if last - first > 1 or bounds[last] - bounds[first] <= BLOCK:
            block, starts = documents_of(data, bounds, first, last)
            hashes, at = _word_hashes(block)
            cuts = np.searchsorted(at, starts)
            for i in range(last - first):
                if cuts[i] < cuts[i + 1]:
                    yield first + i, np.unique(_shingles(hashes[cuts[i] : cuts[i + 1]], words))
            continue
        at, stop, found = int(bounds[first]), int(bounds[last]), []
        while at < stop:
            end = min(stop, at + BLOCK)
            while end < stop and not blank[data[end - BLOCK // 2 : end]].any():
                end = min(stop, end + BLOCK)  # a word longer than that is hashed in one go
            if end < stop:
                end -= int(np.flatnonzero(blank[data[end - BLOCK // 2 : end]][::-1])[0])
            found.append(_word_hashes(data[at:end])[0])
            at = end
        hashes = np.concatenate(found)
        if len(hashes):
            yield first, np.unique(_shingles(hashes, words))


def _key(shingles: np.ndarray) -> np.int64:
    """The node of a set: a hash of its shingles in any order, and of their number."""
    return (mix64(np.sum(mix64(shingles + U(7)), dtype=U, keepdims=True) + U(len(shingles)) * U(0xD6E8FEB86659FD93))).view(np.int64)[0]


def overlap(a: int, b: int, num: int, den: int) -> int:
    """The least number of common shingles of linked sets of these sizes."""
    return -(-num * (a + b) // (num + den))


def partners(n: int, num: int, den: int) -> range:
    """The sizes that a set of n shingles can link with."""
    return range(-(-num * n // den), den * n // num + 1)


def subset_sizes(n: int, num: int, den: int) -> list[int]:
    """The sizes of common subsets that some partner of a set of n shingles asks for."""
    return sorted({o for b in partners(n, num, den) if (o := overlap(n, b, num, den)) <= min(n, b)})


def entries(n: int, num: int, den: int) -> int:
    """How many of the first shingles of a set are entered into the lists."""
    return n - -(-num * n // den) + 1


def boundary(sizes: dict[int, int], mean_list: float, num: int, den: int) -> int:
    """The size from which sets are heavy: that of least cost over the given numbers of sets."""
    light = {n: sum(comb(n, o) for o in subset_sizes(n, num, den)) for n in range(1, LIGHT_LIMIT)}
    heavy = {n: entries(n, num, den) * (1 + mean_list) for n in range(1, LIGHT_LIMIT)}

    def cost(first: int) -> float:
        near = min(partners(first, num, den))  # light sets that are entered, too
        return sum(c * ((light[n] if n < first else heavy[n]) + (heavy[n] if near <= n < first else 0)) for n, c in sizes.items() if n in light)

    return min(range(1, LIGHT_LIMIT + 1), key=cost)


def _subsets(shingles: np.ndarray, num: int, den: int) -> np.ndarray:
    """Hashes of the fixed-size subsets of a light set: its sum without the ones left out."""
    each, n, out = mix64(shingles + U(7)), len(shingles), []
    total = np.sum(each, dtype=U)
    for size in subset_sizes(n, num, den):
        drops = np.array(list(combinations(range(n), n - size)), int).reshape(comb(n, size), n - size)
        out.append(mix64(mix64(total - each[drops].sum(1, dtype=U)) + U(size)))
    return np.concatenate(out) if out else np.zeros(0, U)


def _counted(batches: Iterator[pa.RecordBatch], words: int, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Size, node and smallest shingle of every row; at the end of the task, its counters."""
    total, waiting, held = np.zeros(1 << COUNTER_BITS, np.int64), [], 0
    names, kind = schema.names, None
    for batch in batches:
        data, bounds = utf8(batch.column("text"))
        n, key, low = np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
        for row, shingles in sets(data, bounds, words):
            n[row], key[row], low[row] = len(shingles), _key(shingles), shingles[0] >> U(1)
            waiting.append((shingles >> U(64 - COUNTER_BITS)).astype(np.int32))
            held += len(shingles)
            if held > COUNTED:
                total += np.bincount(np.concatenate(waiting), minlength=len(total))
                waiting, held = [], 0
        kind = batch.schema.field("id").type
        marks = [batch.column("mark")] if "mark" in names else []
        none = [pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(key), pa.array(low), *none, *marks], names=names)
    if waiting:
        total += np.bincount(np.concatenate(waiting), minlength=len(total))
    chunks = [(i, zlib.compress(part.astype("<i8").tobytes(), 1)) for i, part in enumerate(total.reshape(-1, 1 << CHUNK_BITS)) if part.any()]
    if chunks:
        m = len(chunks)
        none = [pa.nulls(m, kind), pa.nulls(m, pa.int32()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())]
        marks = [pa.nulls(m, pa.int64())] if "mark" in names else []
        yield pa.RecordBatch.from_arrays(
            [*none, pa.array([c for c, _ in chunks], pa.int32()), pa.array([d for _, d in chunks], pa.binary()), *marks], names=names)


def _hot(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The counters above ``least`` over all tasks."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, raw in zip(batch.column("chunk").to_pylist(), batch.column("data").to_pylist(), strict=True):
            total[chunk] = total.get(chunk, 0) + np.frombuffer(zlib.decompress(raw), "<i8")
    for chunk, counts in total.items():
        at = np.flatnonzero(counts > least)
        yield pa.RecordBatch.from_arrays([pa.array((at + (chunk << CHUNK_BITS)).astype(np.int32)), pa.array(counts[at])], names=["at", "count"])


def _level(counts: np.ndarray | int) -> np.ndarray:
    """Two levels for each doubling of a count, 63 at most."""
    return np.minimum(63, np.floor(2 * np.log2(counts) + 1e-9)).astype(np.int64)


def _hot_levels(hot: list[tuple[int, int]]) -> np.ndarray:
    levels = np.zeros(1 << COUNTER_BITS, np.int64)
    for at, count in hot:
        levels[at] = int(_level(count))
    return levels


def _later(token: np.ndarray, limit: int) -> np.ndarray:
    """Whether shingles are outside the part of all hashes that is counted."""
    return ((token.view(U) >> U(8)) & U(255)) >= U(limit)


def _ranked(token: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The token as its place in the order of all: by level, then by hash."""
    return ((level.astype(U) << U(56)) | (token.view(U) >> U(8))).view(np.int64)


# Beside each token goes a number: the size of the set, how many of it are counted, and the part of a hot shingle from 1.
_COUNTED, _PART, _SUBSET, _MOST = 28, 56, 127, (1 << 28) - 1


def _shared(batches: Iterator[pa.RecordBatch], held: int, hot: list[tuple[int, int]], limit: int) -> Iterator[pa.RecordBatch]:
    """Of rows (token, node, meta) in the order of these, the tokens of more than one node, ranked, and all hot ones.

    A token's rows wait until their number is known, or until there are ``held`` of them.
    """
    hot_levels = _hot_levels(hot)

    def out(token: np.ndarray, node: np.ndarray, meta: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = meta >> _PART
        subset, salted = part == _SUBSET, (part > 0) & (part < _SUBSET)
        keep = salted | (count > 1)
        if keep.any():
            token, node, meta, count, subset, salted = (x[keep] for x in (token, node, meta, count, subset, salted))
            level = hot_levels[token.view(U) >> U(64 - COUNTER_BITS)]
            level = np.where(_later(token, limit), 64 + level, np.where(salted, level, _level(count)))
            columns = (node, (meta & _MOST).astype(np.int32), ((meta >> _COUNTED) & _MOST).astype(np.int32), subset,
                       np.where(subset, token, _ranked(token, level)))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["node", "n", "counted", "subset", "token"])

    rest = [np.zeros(0, np.int64)] * 3
    many: tuple[int, int] | None = None  # a token of which ``held`` rows are gone, and its last node
    for batch in batches:
        rows = [np.concatenate([r, np.asarray(batch.column(c))]) for r, c in zip(rest, ("token", "node", "meta"), strict=True)]
        token, node, _ = rows
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        if many and len(token):
            fresh[0] = (token[0], node[0]) != many
        token, node, meta = (r[fresh] for r in rows)
        if not len(token):
            rest = [token, node, meta]
            continue
        start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        count = np.diff(np.append(start, len(token)))
        whole = np.repeat(count, count)
        if many and token[0] == many[0]:
            whole[: count[0]] = held
        last = int(start[-1])
        if whole[last] >= held:
            many, last = (int(token[-1]), int(node[-1])), len(token)
        else:
            many = None
        yield from out(token[:last], node[:last], meta[:last], np.minimum(whole, held)[:last])
        rest = [token[last:], node[last:], meta[last:]]
    yield from out(*rest, np.full(len(rest[0]), len(rest[0])))


def components(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
               threshold: tuple[int, int] = (8, 10)) -> DataFrame:
    """One row per document: key, n_shingles, component_id, and the node of its set."""
    rows, nodes, roots = _connected_nodes(docs, key, text, words, threshold)
    best = nodes.join(roots, nodes["node"] == roots["node"]).groupBy("root").agg(F.min("id").alias("smallest"))
    of_node = roots.join(best, "root").select("node", "smallest")
    out = rows.join(of_node, "node", "left").join(unsent(nodes, nodes.count()).select("node", F.col("id").alias("own")), "node", "left")
    component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("smallest", "own"))
    return out.select(F.col("id").alias(key), F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), "node")


def _connected_nodes(docs: DataFrame, key: str, text: str, words: int, threshold: tuple[int, int],
                     marked: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (id, n, node), nodes (node, id, n) and, for nodes that link, their roots; ``marked``, nodes tell the row of
    their smallest id by a hash of its text, too (mark)."""
    num, den = threshold
    if not 0 < num < den:
        raise ValueError("the threshold lies between 0 and 1")
    spark = docs.sparkSession
    narrow = docs.select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    given = narrow.withColumn("mark", F.xxhash64("text")) if marked else narrow
    id_type = narrow.schema["id"].dataType
    schema = T.StructType([T.StructField("id", id_type), T.StructField("n", T.IntegerType()), T.StructField("node", T.LongType()),
                           T.StructField("low", T.LongType()), T.StructField("chunk", T.IntegerType()), T.StructField("data", T.BinaryType()),
                           *([T.StructField("mark", T.LongType())] if marked else [])])
    counted = stage(given.mapInArrow(lambda b: _counted(b, words, schema), schema))
    rows = counted.where("chunk IS NULL").drop("chunk", "data", "low")
    if marked:
        nodes = rows.where("n > 0").groupBy("node").agg(F.min(_in_order("mark")).alias("first"), F.max("n").alias("n"))
        nodes = stage(nodes.select("node", "first.id", "n", "first.mark"))
    else:
        nodes = stage(rows.where("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.max("n").alias("n")))

    total = counted.agg(F.sum("n").alias("n")).first()["n"] or 0
    lowest = [r["low"] for r in counted.where("n > 0").select("low").distinct().orderBy("low").limit(SMALLEST).collect()]
    used = SMALLEST / ((lowest[-1] + 1) / 2**63) if len(lowest) == SMALLEST else total
    small = {r["n"]: r["count"] for r in nodes.where(F.col("n") < LIGHT_LIMIT).groupBy("n").count().collect()}
    first = boundary(small, max(1.0, total / max(used, 1)), num, den)
    near = min(partners(first, num, den))
    # No more than HOT_PART counters can hold more than one in HOT_PART of all shingles.
    least, held = max(HOT_ROWS, total // HOT_PART), HELD
    chunks = counted.where("chunk IS NOT NULL").select("chunk", "data").repartition("chunk")
    hot = [(r["at"], r["count"]) for r in chunks.mapInArrow(lambda b: _hot(b, least), "at int, count long").collect()]

    limit = math.ceil(256 * SHARE)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, seen = _hot_levels(hot), set()
        for batch in slices(batches, "text"):
            data, bounds = utf8(batch.column("text"))
            token, node, meta = [], [], []
            if len(seen) > SEEN:
                seen.clear()
            for _, shingles in sets(data, bounds, words):
                n, own = len(shingles), _key(shingles)
                if own in seen:  # a copy seen a short while ago adds nothing
                    continue
                seen.add(own)
                before = len(token)
                if n >= near:
                    level, later = levels[shingles >> U(64 - COUNTER_BITS)], _later(shingles, limit)
                    first_part, m = np.flatnonzero(~later), entries(n, num, den)
                    counted = len(first_part)
                    if counted < m:
                        others = np.flatnonzero(later)
                        others = others[np.argsort(level[others], kind="stable")][: m - counted]
                        first_part = np.concatenate([first_part, others])
                    part = np.where(level[first_part] > 0, int(own >> 7) % SALTS + 1, 0)
                    token.append(shingles[first_part])
                    meta.append(n | counted << _COUNTED | part << _PART)
                if n < first:
                    token.append(_subsets(shingles, num, den))
                    meta.append(np.full(len(token[-1]), n | _SUBSET << _PART))
                node += [np.full(len(t), own) for t in token[before:]]
            if token:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x)) for x in ([t.view(np.int64) for t in token], node, meta)], names=["token", "node", "meta"])

    entered = narrow.select("text").mapInArrow(enter, "token long, node long, meta long")
    dealt = entered.repartition("token", F.shiftright("meta", _PART)).sortWithinPartitions("token", "node")
    shared = dealt.mapInArrow(lambda b: _shared(b, held, hot, limit), "node long, n int, counted int, subset boolean, token long")
    # A set has its shared shingles in order; the counted ones that it alone holds come before them.
    of_node = shared.repartition("node").groupBy("node").agg(
        F.max("n").alias("n"), F.max("counted").alias("counted"),
        F.sort_array(F.collect_list(F.when(~F.col("subset"), F.col("token")))).alias("shingles"),
        F.collect_list(F.when(F.col("subset"), F.col("token"))).alias("subsets"))
    alone = F.col("counted") - F.size(F.filter("shingles", lambda x: x < F.lit(64 << 56)))
    wanted = F.col("n") - F.ceil(F.col("n").cast("long") * num / den) + 1 - alone
    of_node = of_node.select("node", "n", "subsets", "shingles", alone.alias("alone"), F.greatest(wanted, F.lit(0)).cast("int").alias("wanted"))
    listed = stage(of_node.where((F.size("subsets") > 0) | ((F.col("wanted") > 0) & (F.size("shingles") > 0))).select(
        "node", "n", "alone", "subsets", F.expr("slice(shingles, 1, wanted)").alias("shingles")))
    links = _links(listed, nodes, narrow, words, num, den)
    return rows, nodes, connected(links)


def _in_order(*then: str) -> Column:
    """The smallest id first, null ids last."""
    return F.struct(F.col("id").isNull().alias("open"), "id", *then)


def _fits(one: str, two: str, num: int, den: int) -> Column:
    """Whether two sets can link by a number they share in a list, if they share none that comes before it.

    They differ in all that comes before its place, in either set, and may differ in (den - num) of (num + den) of both sizes.
    """
    def enough(a: str, b: str) -> Column:
        return (num + den) * (F.col(f"{b}d") - F.col(f"{a}d") + 2 * F.col(f"{a}place")) <= (den - num) * (F.col(f"{a}n") + F.col(f"{b}n"))

    return enough(one, two) & enough(two, one)


def _open(placed: DataFrame, num: int, den: int) -> DataFrame:
    """Members of lists of more than one component, without those that fit with no other size and place of their list."""
    n, d, place = (F.col(c) for c in ("n", "d", "place"))
    spare, reach = (den - num) * n - (num + den) * d, (den - num) * n + (num + den) * (d - 2 * place)
    lists = placed.groupBy("token").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.max(spare).alias("spare"), F.max(reach).alias("reach"))
    able = placed.join(lists.where("low < high"), "token").where((F.col("spare") + reach >= 0) & (F.col("reach") + spare >= 0))
    return able.select(*placed.columns)


def _pairs(placed: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (node, h) of members of a list that are in different components."""
    one, two = placed.alias("one"), placed.alias("two")
    pairs = one.join(two, F.col("one.token") == F.col("two.token")).where("one.node < two.node AND one.c <> two.c")
    return pairs.where(_fits("one.", "two.", num, den)).select(F.col("one.node").alias("node"), F.col("two.node").alias("h"))


def _split(met: DataFrame, differing: int) -> DataFrame:
    """Lists of what the sets that met a hub (h, node, n, d, other, c) differ in from it, ``differing`` in all, the rarest among them first.

    Two of them differ in what only one of them differs in from the hub. If nothing is in both differences and they link, both link with the hub.
    """
    groups = in_one(met, differing).groupBy("h").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    met = in_one(met, differing).join(groups.select("h"), "h", "left_semi")
    each = met.select("h", "node", F.explode("other").alias("token")).withColumn("token", F.xxhash64("h", "token"))
    counts = each.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    order = F.sort_array(F.collect_list(F.struct("held", "token")))
    of_node = in_one(each.join(counts, "token"), differing).groupBy("h", "node").agg(order.alias("shared"))
    places = of_node.join(met.select("h", "node", "n", "d", "c"), ["h", "node"])
    entered = places.select("node", "n", "d", "c", (F.col("d") - F.size("shared")).alias("alone"), F.posexplode("shared").alias("at", "one"))
    return entered.select(F.col("one.token").alias("token"), "node", "n", "d", (F.col("alone") + F.col("at")).alias("place"), "alone", "c")


def _links(listed: DataFrame, nodes: DataFrame, narrow: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links (a, b) that connect all nodes which the threshold connects."""
    ends = [F.min("node").alias("low"), F.max("node").alias("high")]
    entered = listed.select("node", "n", "alone", F.posexplode("shingles").alias("place", "token"))
    members = entered.select("token", "node", "n", (F.col("place") + F.col("alone")).alias("place"), "alone")
    members = members.unionByName(listed.select(F.explode("subsets").alias("token"), "node", "n", F.lit(0).alias("place"), F.lit(0).alias("alone")))
    # Within a list, only sets of like size can link: it is split in zones, each of two neighbouring bands of sizes.
    band = F.floor(F.log("n") / (math.log(den / num) * (1 + 1e-9)))
    members = members.withColumn("zone", F.explode(F.array(band, band + 1)))
    members = stage(members.select(F.xxhash64("token", "zone").alias("token"), "node", "n", "place", "alone"))
    members = in_one(members, members.count())
    members = members.join(members.groupBy("token").agg(*ends).where("low < high").select("token"), "token", "left_semi")
    members = stage(members)
    rows = members.count()
    members = in_one(members, rows)

    whole = _sets_of(members.select("node").distinct(), nodes, narrow, words)
    size = whole.agg(F.count("*").alias("sets"), F.sum(F.size("shingles")).alias("shingles")).first()
    mean = (size["shingles"] or 0) / max(1, size["sets"])
    # Pairs that are few are sent to the sets, however many these are; hashes take as much room in files as in memory.
    whole = whole.coalesce(1) if size["sets"] * mean <= PART_SHINGLES else whole

    def sized(df: DataFrame, rows: int) -> DataFrame:
        return in_one(df, rows, 2 * mean, PART_SHINGLES)

    def one_file(df: DataFrame, rows: int) -> DataFrame:
        """The frame, staged: joined in many tasks, it is gathered if one task holds its rows with two sets each."""
        return stage(df.repartition(1) if rows * 2 * mean <= PART_SHINGLES else df)

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs and whether they link, in one file if they fit one task."""
        pairs = stage(pairs)
        rows = pairs.count()
        left = whole.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
        right = whole.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        both = sized(pairs, rows).join(left, "a").join(right, "b")
        common = F.size(F.array_intersect("x", "y"))
        checked = both.select("a", "b", ((num + den) * common >= num * (F.size("x") + F.size("y"))).alias("linked"))
        return in_one(one_file(checked, rows), rows)

    def fresh(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("node", "h").alias("a"), F.greatest("node", "h").alias("b")).distinct()
        return pairs if tried is None else pairs.join(tried.select("a", "b"), ["a", "b"], "left_anti")

    def with_roots(rows: DataFrame, roots: DataFrame) -> DataFrame:
        return rows.join(roots, "node", "left").withColumn("c", F.coalesce("root", "node")).drop("root")

    def added(one: DataFrame, two: DataFrame) -> DataFrame:
        both = one.unionByName(two)
        return in_one(both, both.count())

    columns = ("token", "node", "n", "d", "place", "alone")
    # A member's place counts among the d numbers of it that a list is about: at first, these are all its shingles.
    whole_sizes = members.withColumns({"d": F.col("n").cast("long"), **{c: F.col(c).cast("long") for c in ("n", "place", "alone")}})
    placed, tried = whole_sizes.select(*columns, F.col("node").alias("c")), None
    for _ in range(HUB_ROUNDS):
        alive = placed.groupBy("token").agg(
            F.min("c").alias("low"), F.max("c").alias("high"), F.min(F.struct("place", "node", "n", "d", "c")).alias("hub")).where("low < high")
        hubs = alive.select("token", *[F.col(f"hub.{c}").alias(f"hub_{c}") for c in ("node", "n", "d", "place", "c")])
        pairs = placed.join(hubs, "token").where((F.col("c") != F.col("hub_c")) & _fits("", "hub_", num, den))
        checked = verified(fresh(in_one(pairs.select("node", F.col("hub_node").alias("h")), rows)))
        tried = checked if tried is None else added(tried, checked)
        # A hub has met all members of its list; what is left of the list goes on with their components.
        rest = placed.join(hubs.select("token", F.col("hub_node").alias("node")), ["token", "node"], "left_anti").join(alive.select("token"), "token", "left_semi")
        if checked.where("linked").isEmpty():
            placed = in_one(stage(rest), rows)
            break  # hubs link nothing any more
        placed = in_one(stage(with_roots(rest.drop("c"), connected(tried.where("linked").select("a", "b"))).select(*columns, "c")), rows)

    for _ in range(SPLIT_ROUNDS):
        placed = stage(_open(placed, num, den))
        rows = placed.count()
        placed = in_one(placed, rows)
        # The hub is chosen by what is the same in all lists of a round, so that lists of the same sets mostly share theirs.
        hubs = placed.groupBy("token").agg(F.count("*").alias("members"), F.min(F.struct("alone", "node")).alias("hub"))
        hubs = in_one(stage(hubs.where(F.col("members") > SHORT).select("token", F.col("hub.node").alias("h"))), rows)
        if hubs.isEmpty():
            break
        met = stage(placed.join(hubs, "token").where("node <> h").select("h", "node").distinct())
        meetings = met.count()
        left = whole.select(F.col("node").alias("h"), F.col("shingles").alias("x"))
        both = sized(met, meetings).join(left, "h").join(whole.withColumnRenamed("shingles", "y"), "node")
        both = both.withColumn("other", F.concat(F.array_except("x", "y"), F.array_except("y", "x")))
        both = both.select("h", "node", F.size("y").cast("long").alias("n"), F.size("other").cast("long").alias("d"), F.size("x").alias("hub_n"), "other")
        both = both.withColumn("linked", (num + den) * F.col("d") <= (den - num) * (F.col("n") + F.col("hub_n"))).drop("hub_n")
        met = one_file(both, meetings)
        differing = met.agg(F.sum("d").alias("d")).first()["d"] or 0
        met = in_one(met, differing)
        tried = added(tried, met.select(F.least("node", "h").alias("a"), F.greatest("node", "h").alias("b"), "linked"))
        roots = connected(tried.where("linked").select("a", "b"))
        short = placed.drop("c").join(hubs.select("token"), "token", "left_anti")
        parts = _split(stage(with_roots(met, roots)), differing).select(*columns, "c")
        placed = stage(with_roots(short, roots).select(*columns, "c").unionByName(parts))
        placed = in_one(placed, placed.count())
    # Lists that are still long are dealt out, however few rows there are.
    placed = stage(_open(placed, num, den))
    checked = verified(fresh(_pairs(unsent(placed, placed.count()), num, den)))
    return added(tried, checked).where("linked").select("a", "b")


def _sets_of(wanted: DataFrame, nodes: DataFrame, narrow: DataFrame, words: int) -> DataFrame:
    """The whole set of each wanted node, from the text of one of its documents."""
    ids = stage(nodes.join(wanted, "node", "left_semi").select("node", F.col("id").alias("doc")))
    n = ids.count()
    texts = narrow.join(F.broadcast(ids) if n <= SENT_ROWS else unsent(ids, n), narrow["id"].eqNullSafe(ids["doc"])).select("node", "text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            wanted = np.asarray(batch.column("node"))
            data, bounds = utf8(batch.column("text"))
            if len(seen) > SEEN:
                seen.clear()
            found = []
            for row, s in sets(data, bounds, words):
                # A document may share its id with another one: its set has to be the wanted node's.
                if wanted[row] not in seen and _key(s) == wanted[row]:
                    seen.add(wanted[row])
                    found.append((wanted[row], s.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.list_(pa.int64()))], names=["node", "shingles"])

    found = stage(texts.mapInArrow(whole, "node long, shingles array<long>"))
    # Rows that repeat an id and a text give a set more than once, in different tasks; else there is nothing to drop.
    return found if found.count() == n else stage(found.dropDuplicates(["node"]))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, threshold: tuple[int, int] = (8, 10)) -> DataFrame:
    """The input with one document of each component, the one of the smallest id, in its own columns.

    Documents without words are all kept, and so are all that link with nothing, whether their id is null or stands in other
    rows as well. Of the rows of the chosen id and text one is kept; null ids are chosen last.
    """
    _, nodes, roots = _connected_nodes(docs, key, text, words, threshold, marked=True)
    placed = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = placed.groupBy("root").agg(F.min(_in_order("node", "mark")).alias("first"))
    body = F.col(text).cast("string")
    worded = F.coalesce(body.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    mark, id_, id_mark = unused(docs.columns, "mark", "kept_id", "kept_mark")
    kept = first.select(F.col("first.id").alias(id_), F.col("first.mark").alias(id_mark))
    having = docs.where(worded).withColumn(mark, F.xxhash64(body))
    chosen = having.join(kept, F.col(key).eqNullSafe(F.col(id_)) & (F.col(mark) == F.col(id_mark)), "left_semi")
    return chosen.dropDuplicates([key, mark]).drop(mark).unionByName(docs.where(~worded))
