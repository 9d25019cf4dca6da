"""The two plans behind most reports: one aggregate row per column, and value counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.numeric import DEFAULT_ACCURACY
from tabwright.operators.quantile import aggregate


def per_column(df: DataFrame, cells: dict[str, Column], stats: dict[str, Column], medians: dict[str, Column] | None = None,
               beside: dict[str, Column] | None = None, accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """One row per column of aggregates, with the number of rows as ``n_total``.

    ``cells`` maps a column to a value taken from each row, of one type for all columns; ``stats`` are
    aggregates over that value, ``x``, and over the values ``beside`` it, which all columns share. The input
    is read once for any number of columns: its cells become rows, and one hash aggregate keyed by
    column reduces them before the shuffle, so each task sends one row per column. Generated
    code stays small however wide the table is.

    ``medians`` (name: value) take a second pass: sketches use object buffers, for which
    Spark generates no fused loop, so mixing them in would slow all other aggregates down.
    """
    if not cells:
        raise ValueError("no column to aggregate")
    shared = {"_row": F.lit(True)} | (beside or {})
    wide = df.select(*[value.alias(name) for name, value in shared.items()], *[value.alias(c) for c, value in cells.items()])
    long = wide.unpivot(list(shared), list(cells), "column", "x")
    # One cell without a value for each column, so that a column of an empty input has its row, too.
    kinds = dict(long.dtypes)
    blank = df.sparkSession.createDataFrame([(c, False) for c in cells], "column string, _row boolean")
    blanks = blank.select(*[c if c in ("column", "_row") else F.lit(None).cast(kinds[c]).alias(c) for c in long.columns])
    long = long.unionByName(blanks)
    rows = long.groupBy("column").agg(F.count_if(F.col("_row")).alias("n_total"), *[agg.alias(s) for s, agg in stats.items()])
    if medians:
        middle = aggregate(long, ["column"], [], {s: (value, (0.5,)) for s, value in medians.items()}, accuracy)
        middle = middle.select("column", *[F.col(s)[0].alias(s) for s in medians])
        rows = rows.join(F.broadcast(middle), "column")  # one row per profiled column
    return rows


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n) for all columns in one shuffle; null is a value of its own.

    Counts are combined before the shuffle, so a hot value costs one row per input task.
    """
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    cells = texts.unpivot([], list(cols), "column", "value")
    return cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def most_frequent(counts: DataFrame, n: int, by: Sequence[str] = ("column",)) -> DataFrame:
    """The ``n`` commonest values of each column; equal counts are ordered by value."""
    order = Window.partitionBy(*by).orderBy(F.desc("n"), F.asc_nulls_first("value"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def examples(df: DataFrame, cols: Sequence[str], key: Sequence[str], n: int = 3) -> DataFrame:
    """The first ``n`` non-blank values of each column in key order: (column, value).

    One scan for all columns. Each task keeps n rows per column before the shuffle.
    """
    places = [f"_k{i}" for i in range(len(key))]
    wide = df.select(*[F.col(k).alias(p) for k, p in zip(key, places)], *[F.trim(F.col(c).cast("string")).alias(c) for c in cols])
    rows = wide.unpivot(places, list(cols), "column", "value").where("value <> ''")
    order = Window.partitionBy("column").orderBy(*places, "value")
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n).select("column", "value")
