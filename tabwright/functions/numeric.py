"""Aggregate expressions that behave the same with ANSI mode on and off."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A sketch keeps O(accuracy) values, so this also bounds memory per group.
DEFAULT_ACCURACY = 10_000


def quantile(col: Column | str, p: float, accuracy: int = DEFAULT_ACCURACY) -> Column:
    return F.percentile_approx(col, p, accuracy)


def quantiles(col: Column | str, probs: Sequence[float], accuracy: int = DEFAULT_ACCURACY) -> Column:
    """All quantiles from one sketch, as an array in the order of ``probs``."""
    return F.percentile_approx(col, list(probs), accuracy)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over rows where both are present; null for a constant side."""
    both = x.isNotNull() & y.isNotNull()
    a = F.when(both, x.cast("double"))
    b = F.when(both, y.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent; null when ``whole`` is zero."""
    return F.try_divide(part * F.lit(100.0), whole)


def tally(condition: Column) -> Column:
    """How many rows satisfy the condition; 0, not null, for no rows."""
    return F.count_if(condition)


def finite(col: Column) -> Column:
    """The value, with NaN and infinities turned into null."""
    value = col.cast("double")
    bad = F.isnan(value) | (F.abs(value) == float("inf"))
    return F.when(~bad, value)
