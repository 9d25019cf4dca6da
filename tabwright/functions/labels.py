"""Recommendation labels: ordered conditions on profile statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ladder(steps: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """The label of the first condition that holds; a null condition does not hold."""
    (cond, label), *rest = steps
    chain = F.when(cond, label)
    for cond, label in rest:
        chain = chain.when(cond, label)
    return chain.otherwise(otherwise)


def _share(pct: Column, names: Sequence[str]) -> Column:
    """The ladder 0, below 5, below 20, below 50, rest, which most percentages share."""
    zero, few, some, many, most = names
    return ladder([(pct == 0, zero), (pct < 5, few), (pct < 20, some), (pct < 50, many)], most)


def numeric_imputation(null_pct: Column) -> Column:
    return _share(null_pct, ("complete", "median", "median_or_model", "impute_and_flag", "consider_dropping"))


def categorical_imputation(null_pct: Column) -> Column:
    return _share(null_pct, ("complete", "mode", "mode_and_flag", "impute_and_flag", "consider_dropping"))


def text_imputation(blank_pct: Column) -> Column:
    return _share(blank_pct, ("complete", "placeholder", "impute_and_flag", "flag_required", "consider_dropping"))


def extraction_imputation(problem_pct: Column) -> Column:
    return _share(problem_pct, ("complete", "median", "median_and_flag", "median_flag_required", "consider_dropping"))


def zero_inflation(zero_pct: Column) -> Column:
    return _share(zero_pct, ("no_zeros", "marginal", "flag_zero", "flag_required", "mostly_zero"))


def skew_transform(skew: Column) -> Column:
    """Exactly 1 or -1 falls in no band and is left for review."""
    return ladder(
        [(skew.isNull(), "not_computable"), (F.abs(skew) < 0.5, "symmetric"), (F.abs(skew) < 1, "mild_optional"),
         (skew > 1, "log_or_sqrt"), (skew < -1, "reflect_and_log")], "review")


def kurtosis_outliers(kurt: Column) -> Column:
    return ladder(
        [(kurt.isNull(), "not_computable"), (kurt < 0, "flat"), (kurt < 3, "moderate"), (kurt < 7, "heavy_tails")],
        "extreme")


def scaling(low: Column, high: Column, std: Column) -> Column:
    span = high - low
    return ladder(
        [(span.isNull() | std.isNull(), "not_computable"), (span == 0, "constant_drop"),
         ((span > 1000) | (std > 500), "standard_or_minmax"), (span > 100, "minmax")], "optional")


def encoding(distinct: Column) -> Column:
    return ladder(
        [(distinct <= 2, "binary"), (distinct <= 10, "one_hot"), (distinct <= 50, "one_hot_or_target"),
         (distinct <= 500, "target_or_frequency"), (distinct <= 5000, "frequency_group_rare")], "hashing")


def concentration(top_pct: Column, distinct: Column) -> Column:
    return ladder(
        [(top_pct > 95, "near_constant_drop"), (top_pct > 80, "highly_concentrated"), (top_pct > 50, "dominant_value"),
         (distinct > 1000, "group_rare")], "acceptable")


def boolean_balance(true_pct: Column) -> Column:
    minority = F.least(true_pct, 100 - true_pct)
    return ladder([(minority < 1, "near_constant"), (minority < 5, "severe"), (minority < 20, "moderate")], "balanced")


def boolean_usefulness(true_pct: Column, null_pct: Column) -> Column:
    return ladder(
        [(null_pct > 50, "too_many_nulls"), ((true_pct > 98) | (true_pct < 2), "no_variance"),
         ((true_pct > 80) | (true_pct < 20), "low_variance")], "useful")


def text_feature(mean_length: Column) -> Column:
    return ladder(
        [(mean_length == 0, "drop"), (mean_length < 10, "categorical"), (mean_length < 50, "keywords"),
         (mean_length < 200, "tf_idf")], "embeddings")


def text_quality(low: Column, high: Column, mean_length: Column) -> Column:
    span = high - low
    return ladder(
        [(mean_length == 0, "no_content"), (span == 0, "constant_length"), (span > mean_length * 10, "wide_spread")],
        "consistent")


def extractability(number_pct: Column) -> Column:
    return ladder(
        [(number_pct >= 95, "extract"), (number_pct >= 80, "extract_and_flag"), (number_pct >= 50, "partial")],
        "not_extractable")


def extraction_usefulness(number_pct: Column) -> Column:
    return ladder([(number_pct >= 80, "use_as_number"), (number_pct >= 50, "use_with_flag")], "low_value")


def identifier_action(unique_pct: Column) -> Column:
    return ladder([(unique_pct >= 99, "drop"), (unique_pct >= 20, "review")], "group_or_review")


def redundancy(match_pct: Column, distinct_ratio: Column) -> Column:
    return ladder(
        [((match_pct >= 95) & (distinct_ratio >= 0.90), "high"), (match_pct >= 70, "possible"),
         (match_pct >= 20, "partial")], "none")


def redundancy_action(relation: Column) -> Column:
    return ladder([(relation == "high", "drop_one"), (relation == "possible", "review"),
                   (relation == "partial", "analyse")], "keep")


def correlation_strength(r: Column) -> Column:
    size = F.abs(r)
    return ladder(
        [(r.isNull() | F.isnan(r), "no_data"), (size >= 0.6, "strong"), (size >= 0.3, "moderate"), (size >= 0.1, "weak")],
        "none")


def coordinate_quality(valid_pct: Column, null_island_pct: Column) -> Column:
    return ladder(
        [((valid_pct >= 95) & (null_island_pct < 0.5), "excellent"), (valid_pct >= 80, "good"),
         (valid_pct >= 50, "acceptable")], "poor")


def coordinate_action(quality: Column) -> Column:
    return ladder([(quality == "excellent", "use_directly"), (quality == "good", "clean_anomalies"),
                   (quality == "acceptable", "impute_nulls")], "do_not_use")


def coordinate_features(quality: Column) -> Column:
    return ladder([(quality == "excellent", "geohash_6_8, urban_distance, clusters"), (quality == "good", "geohash_5_6, region, clusters"),
                   (quality == "acceptable", "region, has_coordinates")], "from_city_or_postcode")


def place_quality(null_pct: Column, distinct: Column) -> Column:
    fill = ladder([(null_pct < 10, "complete"), (null_pct < 30, "good")], "incomplete")
    size = ladder([(distinct <= 100, "low"), (distinct <= 5000, "high")], "very_high")
    return F.concat_ws("_", fill, size)


def place_action(null_pct: Column, distinct: Column) -> Column:
    return ladder(
        [((null_pct < 30) & (distinct <= 100), "one_hot"), ((null_pct < 30) & (distinct <= 5000), "target_or_frequency"),
         (null_pct < 60, "group_and_frequency")], "presence_flag")


def place_features(action: Column, name: str) -> Column:
    return ladder([(action == "one_hot", f"{name}_one_hot, region"), (action == "target_or_frequency", f"{name}_frequency, urban_level"),
                   (action == "group_and_frequency", f"{name}_hash, region")], f"has_{name}")


def geo_strategy(valid_pct: Column, city_null_pct: Column) -> Column:
    return ladder([(valid_pct >= 80, "coordinates_first"), (city_null_pct < 30, "places_first")], "enrichment_needed")


# What can be derived from a listing's date, model year and days on the market.
TEMPORAL_FEATURES = {
    "date": "listed_year, listed_month, listed_quarter, listed_weekday",
    "year": "vehicle_age_at_listing",
    "days": "fast_turnover, slow_turnover",
}


def date_action(null_pct: Column) -> Column:
    return ladder([(null_pct < 20, "keep_and_derive"), (null_pct < 50, "keep_with_caution")], "limited_use")


def counted_action(null_pct: Column, invalid: Column, last: str) -> Column:
    return ladder([((null_pct < 20) & (invalid == 0), "keep"), (null_pct < 40, "keep_with_review")], last)


def temporal_strategy(date_null_pct: Column, year_null_pct: Column) -> Column:
    return ladder(
        [((date_null_pct < 20) & (year_null_pct < 20), "keep_all"),
         ((date_null_pct < 40) | (year_null_pct < 40), "keep_partly")], "review")


def group_health(mean_null_pct: Column) -> Column:
    return ladder([(mean_null_pct < 5, "solid"), (mean_null_pct < 20, "acceptable")], "critical")


def overfit(r2_train: Column, r2_test: Column, limit: float = 0.05) -> Column:
    return ladder([(r2_train.isNull(), "not_checked"), (F.abs(r2_train - r2_test) > limit, "possible_overfit")], "ok")
