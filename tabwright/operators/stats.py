"""Numeric statistics over a whole table or per segment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.numeric import DEFAULT_ACCURACY, pearson
from tabwright.functions.predicates import present, valid_rows
from tabwright.operators.quantile import aggregate

PERCENTILES = (0.01, 0.05, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)


def _suffix(prefix: str) -> str:
    return f"_{prefix}" if prefix else ""


def round_doubles(df: DataFrame, digits: int = 2) -> DataFrame:
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def global_stats(df: DataFrame, col: str, positive_only: bool = False, prefix: str = "",
                 accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    s = _suffix(prefix)
    found = aggregate(valid_rows(df, col, positive_only), [], [
        F.count(F.lit(1)).alias(f"n{s}"),
        F.min(col).alias(f"min{s}"),
        F.max(col).alias(f"max{s}"),
        F.avg(col).alias(f"mean{s}"),
        F.stddev(col).alias(f"std{s}"),
        F.skewness(col).alias(f"skew{s}"),
        F.kurtosis(col).alias(f"kurt{s}"),
    ], {"_q": (col, (0.5,))}, accuracy)
    return found.select(*[f"{c}{s}" for c in ("n", "min", "max", "mean")], F.col("_q")[0].alias(f"median{s}"),
                        *[f"{c}{s}" for c in ("std", "skew", "kurt")])


def percentile_table(df: DataFrame, col: str, positive_only: bool = False, prefix: str = "",
                     probs: Sequence[float] = PERCENTILES, accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """One row per requested percentile."""
    wide = aggregate(valid_rows(df, col, positive_only), [], [], {"q": (col, probs)}, accuracy)
    rows = [F.struct(F.lit(float(p)).alias("percentile"), F.col("q")[i].alias(f"value_{prefix or col}"))
            for i, p in enumerate(probs)]
    return wide.select(F.inline(F.array(*rows)))


def log_shape(df: DataFrame, col: str, positive_only: bool = True, prefix: str = "") -> DataFrame:
    """Skewness and excess kurtosis of the values and of log(1 + value)."""
    s, logged = _suffix(prefix), F.log1p(col)
    return valid_rows(df, col, positive_only).agg(
        F.skewness(col).alias(f"skew{s}"),
        F.kurtosis(col).alias(f"kurt{s}"),
        F.skewness(logged).alias(f"skew_log{s}"),
        F.kurtosis(logged).alias(f"kurt_log{s}"),
    )


def iqr_bounds(df: DataFrame, q1: str = "q1", q3: str = "q3") -> DataFrame:
    """Add the interquartile range and its 1.5 and 3.0 fences."""
    iqr = F.col(q3) - F.col(q1)
    fences = {"iqr": iqr}
    for k, name in ((1.5, "1_5"), (3.0, "3_0")):
        fences[f"lower_bound_iqr_{name}"] = F.col(q1) - F.lit(k) * iqr
        fences[f"upper_bound_iqr_{name}"] = F.col(q3) + F.lit(k) * iqr
    return df.withColumns(fences)


def global_iqr(df: DataFrame, col: str, positive_only: bool = False, accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    q = F.col("q")
    wide = aggregate(valid_rows(df, col, positive_only), [], [], {"q": (col, (0.25, 0.5, 0.75))}, accuracy)
    return iqr_bounds(wide.select(q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3")))


def segment_stats(df: DataFrame, col: str, segments: Sequence[str], positive_only: bool = False,
                  min_group_size: int = 30, prefix: str = "", digits: int = 2,
                  accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """Distribution of ``col`` in each segment of at least ``min_group_size`` rows.

    The five quantiles share one sketch per group. Sketches and moments are combined before
    the shuffle, so a segment holding most of the rows costs no more than any other.
    """
    s, keys = _suffix(prefix), present(df, segments)
    q = F.col("_q")
    grouped = aggregate(valid_rows(df, col, positive_only), keys, [
        F.count(F.lit(1)).alias("group_n"),
        F.min(col).alias(f"min{s}"),
        F.avg(col).alias(f"mean{s}"),
        F.max(col).alias(f"max{s}"),
        F.stddev(col).alias(f"std{s}"),
        F.skewness(col).alias(f"skew{s}"),
    ], {"_q": (col, (0.25, 0.5, 0.75, 0.95, 0.99))}, accuracy).where(F.col("group_n") >= min_group_size)
    named = grouped.select(
        *keys, "group_n", f"min{s}",
        *[q[i].alias(f"{name}{s}") for i, name in enumerate(("q1", "median", "q3", "p95", "p99"))],
        f"mean{s}", f"max{s}", f"std{s}", f"skew{s}",
        (F.try_divide(F.col(f"std{s}"), F.col(f"mean{s}")) * 100).alias(f"cv_pct{s}"),
    )
    bounded = iqr_bounds(named, f"q1{s}", f"q3{s}")
    floor = F.greatest(F.col("lower_bound_iqr_1_5"), F.lit(0.0))
    return round_doubles(bounded.withColumn("lower_bound_iqr_1_5", floor), digits)


def two_variable_stats(df: DataFrame, x: str, y: str, positive_only: bool = True, x_name: str = "",
                       y_name: str = "", accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """Correlation of two columns and the ratio ``y / x`` in percent, over complete pairs."""
    a, b = x_name or x, y_name or y
    keep = (F.col(x) > 0) & (F.col(y) > 0) if positive_only else F.col(x).isNotNull() & F.col(y).isNotNull()
    pairs = df.where(keep).withColumn("_ratio", F.round(F.try_divide(F.col(y), F.col(x)) * 100, 2))

    columns = {"_ratio": "ratio_pct_{}", y: "{}_" + b, x: "{}_" + a}
    kinds = {"mean": F.avg, "median": None, "min": F.min, "max": F.max}
    found = aggregate(pairs, [], [
        F.count(F.lit(1)).alias("n"),
        F.round(pearson(F.col(x), F.col(y)), 4).alias(f"corr_{a}_{b}"),
        *[F.round(agg(c), 2).alias(name.format(kind)) for c, name in columns.items() for kind, agg in kinds.items() if agg],
    ], {name.format("median"): (c, (0.5,)) for c, name in columns.items()}, accuracy)
    medians = {name.format("median"): F.round(F.col(name.format("median"))[0], 2) for name in columns.values()}
    return found.withColumns(medians).select(
        "n", f"corr_{a}_{b}", *[name.format(kind) for name in columns.values() for kind in kinds])


def pair_correlations(df: DataFrame, pairs: Sequence[tuple[str, str]], digits: int = 4) -> DataFrame:
    """Pearson correlation of each pair of columns, all from one pass."""
    wide = df.agg(*[F.round(pearson(F.col(a), F.col(b)), digits).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    rows = [F.struct(F.lit(a).alias("column_1"), F.lit(b).alias("column_2"), F.col(f"c{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows)))
