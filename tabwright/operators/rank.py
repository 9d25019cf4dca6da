"""Rankings: extreme rows, top categories and top rows per category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.draw import unit_draw
from tabwright.functions.numeric import DEFAULT_ACCURACY
from tabwright.functions.predicates import present, valid_rows
from tabwright.operators.stats import segment_stats


def preview(df: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    """The preferred columns that exist, limited to ``n`` rows."""
    return df.select(*present(df, cols)).limit(n)


def top_extremes(df: DataFrame, col: str, positive_only: bool = False, n: int = 30,
                 extra: Sequence[str] = (), tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``n`` largest values; runs as one bounded heap per task."""
    keep = present(df, [col, *extra])
    rows = valid_rows(df, col, positive_only).orderBy(F.desc(col), *present(df, tie_break))
    return rows.limit(n).select(*keep)


def top_categories(df: DataFrame, category: str, n: int) -> DataFrame:
    """The ``n`` commonest values of a column with their counts; null may be one of them."""
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc_nulls_first(category)).limit(n)


def in_top_categories(df: DataFrame, category: str, n: int, counted: DataFrame | None = None) -> DataFrame:
    """Rows of the ``n`` commonest categories; rows without a category drop out.

    Catalyst knows that the right side holds at most ``n`` rows, and broadcasts it where that is few.
    """
    top = top_categories(df if counted is None else counted, category, n).select(category)
    return df.join(top, category, "left_semi")


def top_category_stats(df: DataFrame, category: str, col: str, n: int = 20,
                       accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """Segment statistics of the ``n`` commonest categories, highest median first."""
    stats = segment_stats(in_top_categories(df, category, n), col, [category], min_group_size=1, prefix=col,
                          accuracy=accuracy)
    return stats.orderBy(F.desc(f"median_{col}"), category)


def top_rows_per_category(df: DataFrame, category: str, col: str, categories: int = 15, k: int = 5,
                          extra: Sequence[str] = (), tie_break: Sequence[str] = ()) -> DataFrame:
    """The ``k`` highest positive values within each of the commonest categories.

    Spark keeps only ``k`` rows per category in each task before the shuffle.
    """
    rows = in_top_categories(valid_rows(df, col, positive_only=True), category, categories)
    order = Window.partitionBy(category).orderBy(F.desc(col), *present(df, tie_break))
    ranked = rows.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k)
    shown = [c for c in dict.fromkeys([category, *present(df, extra), col, "rn"])]
    return ranked.select(*shown).orderBy(category, "rn")


def in_order(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Sort rows by a stated order of values; any other value comes last."""
    place: Column = F.lit(len(values))
    for i, value in reversed(list(enumerate(values))):
        place = F.when(F.col(col) == value, i).otherwise(place)
    return df.orderBy(place, col)


def random_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows in a repeatable random order."""
    return df.orderBy(unit_draw(key, seed), *key).limit(n)


def option_list(col: Column) -> Column:
    """A bracketed list held as text, in lower case without quotes, brackets or spaces."""
    return F.translate(F.lower(col), "[]'\" \t\n\x0b\f\r", "")


def top_options(df: DataFrame, col: str, n: int = 20, min_pct: float = 1.0, fraction: float = 1.0,
                key: Sequence[str] = (), seed: int = 42, exclude: Sequence[str] = (),
                separator: str = ",", normalise=option_list) -> DataFrame:
    """Commonest list items and the share of rows with a list that hold them.

    With ``fraction`` below 1 the rows are sampled by key; the default reads all of them.
    """
    rows = df.where(F.col(col).isNotNull())
    if fraction < 1.0:
        rows = rows.where(unit_draw(key, seed) < fraction)
    items = rows.select(F.explode(F.split(normalise(F.col(col)), separator)).alias("option"))
    items = items.where(F.length("option") > 3)
    if exclude:
        items = items.where(~F.col("option").isin(*exclude))
    total = rows.agg(F.count(F.lit(1))).scalar()
    counts = items.groupBy("option").agg(F.count(F.lit(1)).alias("n"))
    shares = counts.withColumn("pct", F.round(F.try_divide(F.col("n"), total) * 100, 2))
    return shares.where(F.col("pct") >= min_pct).orderBy(F.desc("n"), "option").limit(n)
