"""Feature derivation. Every function adds or replaces columns in one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import geo
from tabwright.functions.numeric import DEFAULT_ACCURACY
from tabwright.functions.predicates import (
    FIRST_INTEGER,
    TRUCK_PLACEHOLDERS,
    number_in,
    present,
)
from tabwright.operators.caps import fit_quantiles
from tabwright.operators.rank import option_list


def _flag(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


# --- geography -------------------------------------------------------------------------

def add_region(df: DataFrame, lat: str = "latitude", lon: str = "longitude", out: str = "geo_region") -> DataFrame:
    return df.withColumn(out, geo.region(F.col(lat), F.col(lon)))


def add_proximity(df: DataFrame, centres: Sequence[tuple[float, float]], lat: str = "latitude",
                  lon: str = "longitude", out: str = "dist_to_major_city_miles",
                  level: str = "urban_level") -> DataFrame:
    """Distance to the nearest centre, and urban, suburban or rural by that distance."""
    near = df.withColumn(out, geo.nearest_miles(F.col(lat), F.col(lon), centres))
    return near.withColumn(level, geo.proximity_level(F.col(out)))


def add_geography(df: DataFrame, centres: Sequence[tuple[float, float]], lat: str = "latitude",
                  lon: str = "longitude") -> DataFrame:
    return add_proximity(add_region(df, lat, lon), centres, lat, lon)


# --- value flags -----------------------------------------------------------------------

def fit_price_thresholds(df: DataFrame, price: str = "price", floor: float = 4000,
                         accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """The 90th and 95th percentiles of prices above the floor, as one row."""
    return fit_quantiles(df, price, [0.90, 0.95], F.col(price) > floor, accuracy)


def add_high_end_flag(df: DataFrame, thresholds: DataFrame, makes: Sequence[str], bodies: Sequence[str],
                      out: str = "gama_alta", price: str = "price", power: str = "horsepower",
                      make: str = "make_name", body: str = "body_type", floor: float = 4000,
                      min_power: float = 300) -> DataFrame:
    """1 from the upper threshold ``q1`` on, or from the lower ``q0`` with a premium trait."""
    limits = thresholds.select(F.struct("q0", "q1")).scalar()
    worth = F.col(price)

    def listed(col: str, names: Sequence[str]) -> Column:
        return F.trim(F.lower(F.col(col))).isin(*names)

    premium = (F.col(power) > min_power) | listed(make, makes) | listed(body, bodies)
    flag = (worth > floor) & ((worth >= F.col("_limits")["q1"]) | ((worth >= F.col("_limits")["q0"]) & premium))
    return df.withColumn("_limits", limits).withColumn(out, _flag(flag)).drop("_limits")


def binarize(df: DataFrame, col: str, out: str, mode: str = "binary") -> DataFrame:
    """``drop`` the column, turn it into a positive flag (``binary``), or ``keep_both``."""
    if mode == "drop":
        return df.drop(col)
    if mode not in ("binary", "keep_both"):
        return df
    flagged = df.withColumn(out, _flag(F.col(col) > 0))
    return flagged.drop(col) if mode == "binary" else flagged


def add_classic_flag(df: DataFrame, year: str = "year", before: int = 1980, out: str = "is_classic") -> DataFrame:
    return df.withColumn(out, _flag(F.col(year) < before))


def add_condition_segment(df: DataFrame, damage: Sequence[str], year: str = "year", usage: str = "mileage",
                          as_of_year: int = 2026, old_before: int = 1996, out: str = "segmento_estado") -> DataFrame:
    """Old, risky, nearly new or standard, in that order of precedence."""
    damaged = F.coalesce(F.greatest(*[F.col(c) for c in damage]), F.lit(False))
    age_ok = F.col(year) >= as_of_year - 2
    # The four segment names.
    segment = (
        F.when(F.col(year).isNull() | (F.col(year) < old_before), "clasico_o_muy_viejo")
        .when(damaged | (F.col(usage) > 200_000), "desguace_o_riesgo")
        .when(age_ok & (F.col(usage) < 50), "nuevo_o_seminuevo")
        .otherwise("estandar")
    )
    return df.withColumn(out, segment)


# --- text ------------------------------------------------------------------------------

def extract_numbers(df: DataFrame, cols: Sequence[str], integers: Sequence[str] = ()) -> DataFrame:
    """Replace text such as ``5.0 L`` by its first number in ``<column>_num``."""
    found = {f"{c}_num": number_in(F.col(c)) for c in present(df, cols)}
    found |= {f"{c}_num": number_in(F.col(c), FIRST_INTEGER) for c in present(df, integers)}
    return df.withColumns(found).drop(*cols, *integers)


def option_flag_name(term: str) -> str:
    return "has_" + "".join(ch if ch.isascii() and ch.isalnum() else "_" for ch in term.lower())


def add_option_features(df: DataFrame, terms: Sequence[str], options: str = "major_options",
                        description: str = "description") -> DataFrame:
    """Description length, number of options and one flag per term found in the list.

    A null list has no options; an empty one, ``[]``, counts as one.
    """
    clean = option_list(F.col(options))
    derived = {
        "description_length": F.coalesce(F.length(F.col(description)), F.lit(0)),
        "option_count": F.when(F.col(options).isNull(), 0).otherwise(F.size(F.split(clean, ","))),
    }
    for term in terms:
        derived[option_flag_name(term)] = F.coalesce(clean.contains(term), F.lit(False)).cast("int")
    return df.withColumns(derived).drop(options, description)


def add_truck_flag(df: DataFrame, body: str = "body_type", truck: str = "Pickup Truck", out: str = "is_pickup",
                   details: Sequence[str] = ("bed", "bed_height", "bed_length", "cabin")) -> DataFrame:
    """Flag trucks and keep truck-only details for them, with placeholders set to null."""
    is_truck = F.coalesce(F.col(body) == truck, F.lit(False))
    changes = {out: _flag(is_truck)}
    for c in present(df, details):
        known = ~F.trim(F.col(c)).isin(*TRUCK_PLACEHOLDERS)
        changes[c] = F.when(is_truck & known, F.col(c).cast("string"))
    return df.withColumns(changes)


def first_match(col: Column, rules: Sequence[tuple[str, str]], missing: str, other: str) -> Column:
    """The label of the first rule whose text occurs in the value, ignoring case."""
    label = F.when(col.isNull(), missing)
    for text, name in rules:
        label = label.when(F.lower(col).contains(text), name)
    return label.otherwise(other)


def normalise_label(df: DataFrame, col: str, out: str, rules: Sequence[tuple[str, str]],
                    missing: str = "unknown", other: str = "other") -> DataFrame:
    return df.withColumn(out, first_match(F.col(col), rules, missing, other)).drop(col)


# --- fills -----------------------------------------------------------------------------

def boolean_as_category(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in present(df, cols)})


def boolean_as_double(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in present(df, cols)})


def flag_and_zero(df: DataFrame, col: str) -> DataFrame:
    """Record where the value was missing, then use zero there."""
    return df.withColumns({f"{col}_missing": F.col(col).isNull().cast("int"),
                           col: F.coalesce(F.col(col), F.lit(0))})


def fill_unknown(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.fillna("unknown", present(df, cols))


# --- time and arithmetic ---------------------------------------------------------------

def add_listing_age(df: DataFrame, date: str = "listed_date", year: str = "year",
                    out: str = "vehicle_age_at_listing") -> DataFrame:
    """Calendar years between model year and listing, unbounded."""
    return df.withColumn(out, F.year(date) - F.col(year))


def add_temporal(df: DataFrame, date: str = "listed_date", year: str = "year",
                 out: str = "vehicle_age_at_listing", max_age: int = 30) -> DataFrame:
    """Listing year and month, and the age where it lies between 0 and ``max_age``."""
    age = F.year(date) - F.col(year)
    return df.withColumns({
        "listed_year": F.year(date),
        "listed_month": F.month(date),
        out: F.when(age.between(0, max_age), age.cast("double")),
    })


def add_ratio(df: DataFrame, numerator: str, denominator: str, out: str) -> DataFrame:
    """Null unless the denominator is above zero."""
    return df.withColumn(out, F.when(F.col(denominator) > 0, F.col(numerator) / F.col(denominator)))


def log_target(df: DataFrame, col: str = "price", out: str = "log_price") -> DataFrame:
    """Natural logarithm; null for values that are not positive."""
    return df.withColumn(out, F.when(F.col(col) > 0, F.log(col))).drop(col)


def back_transform(df: DataFrame, label: str = "log_price", prediction: str = "prediction") -> DataFrame:
    """Actual and predicted values in original units, with absolute and percent error.

    Amounts beyond the range of an integer stop at its end, so that one wild prediction does
    not end the job.
    """
    def amount(log: str) -> Column:
        return F.least(F.round(F.exp(log), 0), F.lit(2147483647.0)).cast("int")

    actual, predicted = amount(label), amount(prediction)
    priced = df.withColumns({"actual": actual, "predicted": predicted})
    gap = F.abs(F.col("actual").cast("long") - F.col("predicted")).cast("int")
    return priced.withColumns({
        "error_abs": gap,
        "error_pct": F.round(F.try_divide(gap, F.col("actual")) * 100, 2),
    })
