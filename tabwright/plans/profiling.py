"""The full exploratory report over listings, as named DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.numeric import DEFAULT_ACCURACY
from tabwright.functions.predicates import present, string_columns
from tabwright.operators import features, outliers, profile, rank, stats
from tabwright.operators.shape import examples
from tabwright.plans import vehicles as v


def profile_listings(df: DataFrame, key: Sequence[str] = ("vin",), accuracy: int | None = DEFAULT_ACCURACY) -> dict[str, DataFrame]:
    """Every report of the exploration, by name.

    Value counts of all text columns and the fences of outliers are computed and written when this is called; the
    reports themselves when they are read. Persist ``df`` first (``files.keep``) if its source is slow to read.
    """
    price, a = v.TARGET, accuracy
    categories = present(df, dict.fromkeys([*v.CATEGORIES, *v.FREQUENCY_CATEGORIES]))
    mistyped = present(df, [*v.CYLINDERS, *v.MEASURES])
    ids = present(df, v.IDENTIFIERS)
    counts = profile.staged_counts(df, [*categories, *mistyped, *ids])

    def counted(cols):
        return counts.where(F.col("column").isin(*cols))

    def by(col, segment, frame=df, size=30, positive=True, prefix=price):
        return stats.segment_stats(frame, col, [segment], positive, size, prefix, accuracy=a)

    aged = features.add_listing_age(df)
    placed = features.add_geography(df, v.CITY_CENTRES)
    options = features.add_option_features(df, v.OPTION_TERMS)
    flags = profile.flag_columns(options)
    by_make = outliers.segment_outliers(
        df, price, ["make_name"], True, 100, 3.0, 4000.0,
        ("year", "model_name", "trim_name", "mileage", "horsepower", "body_type"), a)
    levels = rank.in_order(by(price, "urban_level", placed), "urban_level", ["urban", "suburban"])
    pairs = profile.redundant_pairs_by_name(string_columns(df))
    return {
        "nulls": profile.null_profile(df),
        "numeric": profile.numeric_profile(df, exclude=v.IDENTIFIERS, accuracy=a),
        "price_log_shape": stats.log_shape(df, price, prefix=price),
        "price_and_savings": stats.two_variable_stats(df, price, "savings_amount", y_name="savings", accuracy=a),
        "price_and_mileage": stats.two_variable_stats(df, price, "mileage", accuracy=a),
        "price_and_power": stats.two_variable_stats(df, price, "horsepower", y_name="hp", accuracy=a),
        "price_and_age": stats.two_variable_stats(aged, price, "vehicle_age_at_listing", False, y_name="age", accuracy=a),
        "correlation": profile.target_correlation(df, price),
        "pair_correlation": stats.pair_correlations(
            placed, [("horsepower", "engine_displacement"), ("city_fuel_economy", "highway_fuel_economy"),
                     ("dist_to_major_city_miles", price)]),
        "price_by_top_make": rank.top_category_stats(df, "make_name", price, 10, a),
        "price_by_condition": by(price, "is_new", size=1).orderBy(F.desc("median_price")),
        "price_by_body": by(price, "body_type").orderBy(F.desc("median_price")),
        "price_by_top_fuel": rank.top_category_stats(df, "fuel_type", price, 10, a),
        "price_by_year": by(price, "year", size=1).orderBy(F.desc("year")),
        "most_expensive": rank.top_extremes(df, price, True, 30, v.EXPENSIVE_CONTEXT, key),
        "top_prices_by_make": rank.top_rows_per_category(df, "make_name", price, 15, 5, v.TOP_ROW_CONTEXT, key),
        "price_by_region": by(price, "geo_region", placed).orderBy(F.desc("median_price")),
        "price_by_proximity": levels,
        "all_prices_by_proximity": by(price, "urban_level", placed, positive=False).orderBy(F.desc("median_price")),
        "price_iqr": stats.global_iqr(df, price, True, a),
        "price_outliers": by_make,
        "price_outlier_summary": outliers.summarize_outliers(by_make, price, ["make_name"], accuracy=a),
        "top_prices": rank.top_extremes(
            df, price, True, 20, ("make_name", "model_name", "year", "mileage", "body_type"), key),
        "mileage_by_condition": by("mileage", "is_new", size=1, positive=False, prefix="mileage"),
        "days_by_body": by("daysonmarket", "body_type", positive=False, prefix="dom"),
        "days_by_proximity": by("daysonmarket", "urban_level", placed, positive=False, prefix="dom"),
        "string_content": profile.string_content(df, mistyped, counted(mistyped)),
        "string_top_values": profile.string_top_values(df, mistyped, 20, counted(mistyped)),
        "category_frequency": profile.category_frequency(df, categories, 10, counted(categories)),
        "categorical": profile.categorical_profile(df, v.CATEGORIES, counted(v.CATEGORIES)),
        "boolean": profile.boolean_profile(df, v.BOOLEANS),
        "text": profile.text_profile(df, v.TEXTS, a),
        "text_examples": examples(df, present(df, v.TEXTS), key),
        "top_options": rank.top_options(df, "major_options", 30, exclude=v.EXCLUDED_OPTIONS),
        "flag_frequency": profile.flag_frequency(options, flags),
        "flag_impact": profile.flag_impact(options, flags, price, accuracy=a),
        "price_by_option_count": by(price, "option_count", options).orderBy("option_count"),
        "mistyped": profile.mistyped_profile(df, mistyped),
        "mistyped_examples": profile.extraction_examples(examples(df, mistyped, key)),
        "identifiers": profile.identifier_profile(df, ids, counted(ids)),
        "redundant_pairs": profile.redundant_pairs(df, pairs),
        "geography": profile.geo_quality(df),
        "time": profile.temporal_profile(df),
        "time_distribution": profile.temporal_distribution(df),
        "time_examples": profile.temporal_examples(df, key),
        "functional_groups": profile.group_health(df, v.FUNCTIONAL_GROUPS),
        "summary": profile.dataset_summary(df, price, a),
    }
