"""Mixing sources to target weights by cube-method balanced sampling.

The weights fix how many words the mix takes from each source, up to a ceiling per source. A
document is taken whole copies plus one more with a fractional probability. These fractions are
rounded by the flight of the cube method: three documents at a time move through the null space
of the two balancing constraints (words, documents) until one of them is decided, so that the
totals stay exact. Flights run per source and bucket of rows side by side; the two documents
that each leaves undecided meet in the flights of the next level, with a fraction of the rows.
The last two of a source are landed: each way is weighed by its error in words, then documents.

Buckets, order and decisions depend on the rows alone, not on the layout of the input.

Nulls: a null source is a source of its own, after all others; a null text has size 0. Documents
of size 0 take part in the document totals and take no words. A source whose documents are all
empty has target 0. Repeated rows are separate documents; equal rows are interchangeable. An
empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import stage, unused

# What separates words: the space and the five control characters from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one flight, and how many undecided documents meet in one of the next level.
BUCKET_ROWS = 2_000


def targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5,
            ceiling: float = 2.0) -> dict[str | None, float]:
    """The words to take of each source: ``share`` of all, by weight, none above its ceiling.

    What a source cannot take is shared again among the rest, until none is above its ceiling.
    """
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {name: float(weights[i % len(weights)]) for i, (name, _) in enumerate(ordered)}
    most = {name: ceiling * size for name, size in ordered}
    out, open_, left = {}, dict(most), share * sum(size for _, size in ordered)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit >= open_[s]]
        if not full:
            return out | {s: weight[s] * unit for s in open_}
        for s in full:
            out[s] = open_.pop(s)
            left -= out[s]
    return out


def flight(size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Decide all but two or fewer of the chances, keeping the sums of chance and chance * size."""
    sizes, p, last = size.astype(float).tolist(), chance.tolist(), 1e-9
    held: list[int] = []
    for new in range(len(p)):
        if last < p[new] < 1 - last:
            held.append(new)
        while len(held) > 2 or (len(held) == 2 and sizes[held[0]] == sizes[held[1]]):
            a, b = held[0], held[1]
            c = held[2] if len(held) > 2 else None
            if c is None or sizes[a] == sizes[b] == sizes[c]:
                step = [(a, 1.0), (b, -1.0)]
            else:
                step = [(a, sizes[b] - sizes[c]), (b, sizes[c] - sizes[a]), (c, sizes[a] - sizes[b])]
            far = min(((1 - p[i]) / d if d > 0 else p[i] / -d) for i, d in step if d)
            for i, d in step:
                p[i] += far * d
            held = [i for i in held if last < p[i] < 1 - last]
    return np.array([round(x) if not last < x < 1 - last else x for x in p])


def land(size: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """Decide the last two or fewer by the least error in words, then in documents."""
    out, open_ = chance.copy(), [i for i, p in enumerate(chance) if 0 < p < 1]
    if open_:
        words, rows = float(size[open_] @ chance[open_]), float(chance[open_].sum())
        ways = [[n >> k & 1 for k in range(len(open_))] for n in range(1 << len(open_))]
        out[open_] = min(ways, key=lambda w: (abs(float(size[open_] @ np.array(w)) - words), abs(sum(w) - rows)))
    return out


def _decided(rows: DataFrame, group: list[str], bucket: str, final: bool) -> DataFrame:
    """One level of flights. Large documents come first, so that small ones are left to land."""
    def fly(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "spread", "hash"], ascending=[False, True, True], kind="stable", ignore_index=True)
        chance = flight(frame["size"].to_numpy(), frame["chance"].to_numpy())
        return frame.assign(chance=land(frame["size"].to_numpy(), chance) if final else chance)

    return rows.withColumn("bucket", F.expr(bucket)).groupBy(*group, "bucket").applyInPandas(
        fly, rows.withColumn("bucket", F.lit(0).cast("long")).schema).drop("bucket")


def _plan(docs: DataFrame, key: str, text: str, source: str, weights: tuple[float, ...], share: float, ceiling: float,
          bucket_rows: int) -> DataFrame:
    """One row per document, which is known by the text of its id, its source and a hash of id and text."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(key).cast("string").alias("id"), F.col(source).cast("string").alias("origin"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.col(key), F.col(text)).alias("hash"),
    )
    # Equal rows get a number each, so that they spread over buckets in the same way every time.
    run = 100_000
    rows = rows.groupBy("id", "origin", "size", "hash").agg(F.count("*").alias("n"))
    rows = rows.withColumn("run", F.explode(F.expr(f"sequence(0L, (n - 1) div {run})")))
    rows = rows.withColumn("nth", F.explode(F.expr(f"sequence(run * {run}, least(n, (run + 1) * {run}) - 1)")))
    rows = stage(rows.select("id", "origin", "size", "hash", F.xxhash64("hash", "nth").alias("spread")))
    # One row per source comes to the driver; what a source is named has to be few by nature.
    totals = rows.groupBy("origin").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    wanted = targets([(t["origin"], t["size"]) for t in totals], weights, share, ceiling)
    plan = [(str(i), t["origin"], t["size"], float(wanted[t["origin"]]), wanted[t["origin"]] / t["size"] if t["size"] else 0.0,
             -(-t["n"] // bucket_rows)) for i, t in enumerate(sorted(totals, key=lambda t: (t["origin"] is None, t["origin"] or "")))]
    sources = spark.createDataFrame(plan, "number string, name string, source_size long, target double, rate double, buckets long")
    rows = rows.join(sources, F.col("origin").eqNullSafe(F.col("name"))).select(
        "id", "number", "size", "hash", "spread", "buckets", F.floor("rate").alias("whole"),
        (F.col("rate") - F.floor("rate")).alias("chance"))
    done, level, most = [], 0, max((p[-1] for p in plan), default=1)
    while True:
        # Buckets of a level: all rows by hash first, then what many buckets left undecided.
        flown = stage(_decided(rows, ["number"], "pmod(spread, buckets)", final=most == 1))
        if most == 1:
            done.append(flown)
            break
        undecided = (F.col("chance") > 0) & (F.col("chance") < 1)
        done.append(flown.where(~undecided))
        rows, level = flown.where(undecided).withColumn("buckets", F.ceil(F.col("buckets") * 2 / bucket_rows)), level + 1
        most = -(-most * 2 // bucket_rows)
    decided = done[0]
    for more in done[1:]:
        decided = decided.unionByName(more)
    taken = F.col("whole") + F.round("chance")
    return decided.join(sources.drop("buckets"), "number").select(
        "id", F.col("name").alias("origin"), "hash", "size", "source_size", "target", taken.cast("int").alias("copies"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, ceiling: float = 2.0,
        bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per document: key, source, size, source_size, target, copies, taken."""
    return _plan(docs, key, text, source, weights, share, ceiling, bucket_rows).select(
        F.col("id").cast(docs.schema[key].dataType).alias(key), F.col("origin").alias(source), "size", "source_size", "target",
        "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, ceiling: float = 2.0,
          bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The input with each row as often as the mix takes it, in its own columns.

    Rows that agree in key, text and source are interchangeable: of these, one stands for all, as
    often as the mix takes them together.
    """
    names, run = docs.columns, 1_000
    copies, rows, mark, nth, runs, id_, origin, hash_ = unused(names, *("copies", "rows", "mark", "nth", "run", "id", "origin", "hash"))
    plan = _plan(docs, key, text, source, weights, share, ceiling, bucket_rows).groupBy("id", "origin", "hash").agg(
        F.sum("copies").alias("copies"), F.count("*").alias("rows")).toDF(id_, origin, hash_, copies, rows)
    marked = docs.withColumn(mark, F.xxhash64(F.col(key), F.col(text)))
    same = F.col(key).cast("string").eqNullSafe(F.col(id_)) & F.col(source).cast("string").eqNullSafe(F.col(origin)) & (F.col(mark) == F.col(hash_))
    found = marked.join(plan, same).where(F.col(copies) > 0).select(*names, mark, copies, rows)
    alone = found.where(F.col(rows) == 1).withColumn(nth, F.explode(F.expr(f"sequence(1L, `{copies}`)")))
    # Copies of rows that repeat are dealt out in runs, so that no task writes all of them.
    repeated = found.where(F.col(rows) > 1).dropDuplicates([mark, key, source])
    repeated = repeated.withColumn(runs, F.explode(F.expr(f"sequence(0L, (`{copies}` - 1) div {run})"))).repartition(mark, runs)
    repeated = repeated.withColumn(nth, F.explode(F.expr(f"sequence(1L, least({run}L, `{copies}` - `{runs}` * {run}))")))
    return alone.select(*names).unionByName(repeated.select(*names))
