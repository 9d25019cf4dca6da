"""Predicates and column lists shared by every operator."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words that stand for "no value" in free text and in truck-bed columns.
PLACEHOLDERS = ("null", "none", "--", "n/a", "na")
TRUCK_PLACEHOLDERS = ("", "--", "NULL", "None", "null")

# The three number patterns, each with one capture group.
UNSIGNED_NUMBER = r"([0-9]+\.?[0-9]*)"
FIRST_INTEGER = r"(\d+)"
SIGNED_NUMBER = r"(-?\d+(?:[.,]\d+)?)"


def present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """The given names that exist in ``df``, in the given order, without repeats."""
    have = set(df.columns)
    return [c for c in dict.fromkeys(cols) if c in have]


def resolve_columns(df: DataFrame, roles: dict[str, Sequence[str]]) -> tuple[dict, dict]:
    """Split candidate columns of each role into those present and those missing."""
    found = {role: present(df, cols) for role, cols in roles.items()}
    missing = {role: [c for c in cols if c not in found[role]] for role, cols in roles.items()}
    return found, missing


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def boolean_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.BooleanType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def is_blank(col: Column) -> Column:
    """Null, or nothing but spaces once read as text. Never null."""
    return F.trim(F.coalesce(col.cast("string"), F.lit(""))) == ""


def is_missing(field: T.StructField) -> Column:
    """Missing by type: NaN counts for floating point, blank counts for text. Never null."""
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    if isinstance(field.dataType, T.StringType):
        return is_blank(col)
    return col.isNull()


def is_placeholder(col: Column, words: Sequence[str] = PLACEHOLDERS) -> Column:
    return F.coalesce(F.trim(F.lower(col)).isin(*words), F.lit(False))


def has_number(col: Column, pattern: str = UNSIGNED_NUMBER) -> Column:
    """True where the text holds a match; null text holds none."""
    return F.coalesce(F.regexp_extract(col, pattern, 1) != "", F.lit(False))


def number_in(col: Column, pattern: str = UNSIGNED_NUMBER) -> Column:
    """The first match as a double, or null where there is none.

    Empty matches become null before the cast, since a failing cast costs an exception.
    """
    return F.nullif(F.regexp_extract(col, pattern, 1), F.lit("")).try_cast("double")


def is_zero(col: Column) -> Column:
    """Zero as a number, for text too; text that cannot be a number is not cast."""
    text = col.cast("string")
    return F.when(text.rlike(r"^\s*[-+]?[.0]"), text.try_cast("double")) == 0


def valid_rows(df: DataFrame, col: str, positive_only: bool = False) -> DataFrame:
    """Rows whose ``col`` is not null and, if asked, above zero."""
    return df.where(F.col(col) > 0) if positive_only else df.where(F.col(col).isNotNull())
