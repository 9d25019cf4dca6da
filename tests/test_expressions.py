"""Predicates, aggregates, labels, draws and distances on edge rows."""

import math

import pytest
from pyspark.sql import functions as F

from tabwright.functions import draw, geo, labels, numeric, predicates


def column(spark, values, kind):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def evaluate(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_missing_depends_on_type(spark):
    for values, kind, expected in [
        ([1.0, None, math.nan], "double", [False, True, True]),
        (["a", None, "", "  "], "string", [False, True, True, True]),
        ([1, None, 0], "int", [False, True, False]),
    ]:
        df = column(spark, values, kind)
        assert evaluate(df, predicates.is_missing(df.schema["x"])) == expected


def test_placeholders_and_numbers(spark):
    df = column(spark, ["null", " None", "--", "N/A", "na", "x", None], "string")
    assert evaluate(df, predicates.is_placeholder(F.col("x"))) == [True] * 5 + [False, False]
    df = column(spark, ["5.0 L", "-3,5", "V6", "none", "", None], "string")
    assert evaluate(df, predicates.number_in(F.col("x"))) == [5.0, 3.0, 6.0, None, None, None]
    assert evaluate(df, F.regexp_extract("x", predicates.SIGNED_NUMBER, 1)) == ["5.0", "-3,5", "6", "", "", None]
    assert evaluate(df, predicates.has_number(F.col("x"))) == [True, True, True, False, False, False]


def test_resolve_columns(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    found, missing = predicates.resolve_columns(df, {"numeric": ["n", "m"], "text": ["s"], "flag": ["f"]})
    assert found == {"numeric": ["n"], "text": ["s"], "flag": []}
    assert missing == {"numeric": ["m"], "text": [], "flag": ["f"]}


def test_valid_rows(spark):
    df = column(spark, [1.0, 0.0, -1.0, None], "double")
    assert predicates.valid_rows(df, "x").count() == 3
    assert predicates.valid_rows(df, "x", positive_only=True).count() == 1


def test_pearson_ignores_incomplete_pairs_and_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, 6.5, 5.0), (9.0, None, 5.0)],
                               "a double, b double, c double")
    row = df.agg(numeric.pearson(F.col("a"), F.col("b")), numeric.pearson(F.col("a"), F.col("c"))).head()
    complete = df.dropna().agg(F.corr("a", "b")).head()[0]
    assert row[0] == pytest.approx(complete, abs=1e-12)
    assert row[1] is None


def test_percent_of_nothing_is_null(spark):
    df = spark.createDataFrame([(0, 0), (1, 4)], "a int, b int")
    assert evaluate(df, numeric.percent(F.col("a"), F.col("b"))) == [None, 25.0]


def test_finite(spark):
    df = column(spark, [1.0, math.nan, math.inf, -math.inf, None], "double")
    assert evaluate(df, numeric.finite(F.col("x"))) == [1.0, None, None, None, None]


@pytest.mark.parametrize(("rule", "values", "expected"), [
    (labels.numeric_imputation, [0.0, 4.9, 5.0, 20.0, 50.0],
     ["complete", "median", "median_or_model", "impute_and_flag", "consider_dropping"]),
    (labels.skew_transform, [None, 0.4, -0.9, 1.0, -1.0, 1.1, -1.1],
     ["not_computable", "symmetric", "mild_optional", "review", "review", "log_or_sqrt", "reflect_and_log"]),
    (labels.kurtosis_outliers, [None, -0.1, 0.0, 3.0, 7.0],
     ["not_computable", "flat", "moderate", "heavy_tails", "extreme"]),
    (labels.encoding, [2.0, 10.0, 50.0, 500.0, 5000.0, 5001.0],
     ["binary", "one_hot", "one_hot_or_target", "target_or_frequency", "frequency_group_rare", "hashing"]),
    (labels.boolean_balance, [0.5, 97.0, 10.0, 50.0], ["near_constant", "severe", "moderate", "balanced"]),
    (labels.text_feature, [0.0, 9.0, 10.0, 50.0, 200.0], ["drop", "categorical", "keywords", "tf_idf", "embeddings"]),
    (labels.extractability, [95.0, 80.0, 50.0, 49.0], ["extract", "extract_and_flag", "partial", "not_extractable"]),
    (labels.identifier_action, [99.0, 20.0, 19.0], ["drop", "review", "group_or_review"]),
    (labels.group_health, [4.9, 5.0, 20.0], ["solid", "acceptable", "critical"]),
    (labels.correlation_strength, [0.6, -0.3, 0.1, 0.0, None, math.nan],
     ["strong", "moderate", "weak", "none", "no_data", "no_data"]),
    (labels.date_action, [19.0, 20.0, 50.0], ["keep_and_derive", "keep_with_caution", "limited_use"]),
])
def test_label_thresholds(spark, rule, values, expected):
    assert evaluate(column(spark, values, "double"), rule(F.col("x"))) == expected


def test_labels_of_two_statistics(spark):
    def one(expr):
        return spark.range(1).select(expr).head()[0]

    lit = F.lit
    assert one(labels.scaling(lit(1.0), lit(1.0), lit(0.0))) == "constant_drop"
    assert one(labels.scaling(lit(0.0), lit(1001.0), lit(1.0))) == "standard_or_minmax"
    assert one(labels.scaling(lit(0.0), lit(50.0), lit(501.0))) == "standard_or_minmax"
    assert one(labels.scaling(lit(0.0), lit(101.0), lit(1.0))) == "minmax"
    assert one(labels.scaling(lit(0.0), lit(100.0), lit(1.0))) == "optional"
    assert one(labels.scaling(lit(0.0), lit(100.0), lit(None).cast("double"))) == "not_computable"
    assert one(labels.concentration(lit(96.0), lit(3))) == "near_constant_drop"
    assert one(labels.concentration(lit(10.0), lit(1001))) == "group_rare"
    assert one(labels.boolean_usefulness(lit(50.0), lit(51.0))) == "too_many_nulls"
    assert one(labels.boolean_usefulness(lit(1.0), lit(0.0))) == "no_variance"
    assert one(labels.boolean_usefulness(lit(19.0), lit(0.0))) == "low_variance"
    assert one(labels.text_quality(lit(3), lit(3), lit(3.0))) == "constant_length"
    assert one(labels.text_quality(lit(1), lit(100), lit(5.0))) == "wide_spread"
    assert one(labels.redundancy(lit(95.0), lit(0.9))) == "high"
    assert one(labels.redundancy(lit(99.0), lit(0.5))) == "possible"
    assert one(labels.coordinate_quality(lit(99.0), lit(0.5))) == "good"
    assert one(labels.place_action(lit(29.0), lit(5001))) == "group_and_frequency"
    assert one(labels.place_action(lit(60.0), lit(1))) == "presence_flag"
    assert one(labels.counted_action(lit(1.0), lit(1), "x")) == "keep_with_review"
    assert one(labels.temporal_strategy(lit(39.0), lit(90.0))) == "keep_partly"
    assert one(labels.overfit(lit(0.9), lit(0.84))) == "possible_overfit"
    assert one(labels.overfit(lit(None).cast("double"), lit(0.8))) == "not_checked"


def test_draw_is_uniform_and_independent_of_partitioning(spark):
    df = spark.range(20_000)
    once = df.select("id", draw.unit_draw(["id"], 42).alias("u"))
    again = df.repartition(7).select("id", draw.unit_draw(["id"], 42).alias("w"))
    assert once.join(again, "id").where("u <> w").count() == 0
    low, high, mean = once.agg(F.min("u"), F.max("u"), F.avg("u")).head()
    assert 0 <= low < high < 1 and mean == pytest.approx(0.5, abs=0.01)
    assert once.select("u").distinct().count() > 19_990
    with pytest.raises(ValueError):
        draw.unit_draw([], 42)


def test_haversine(spark):
    df = spark.createDataFrame([(40.7128, -74.0060), (-40.7128, 105.994), (None, 1.0)], "lat double, lon double")
    miles = evaluate(df, geo.haversine_miles(F.col("lat"), F.col("lon"), 40.7128, -74.0060))
    assert miles[0] == pytest.approx(0, abs=1e-6)
    assert miles[1] == pytest.approx(math.pi * 3958.8, abs=0.1)
    assert miles[2] is None


def test_regions_and_levels(spark):
    rows = [(37.0, -100.1), (36.9, -100.1), (37.0, -100.0), (36.0, -86.0), (37.0, -85.0), (0.0, 0.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    assert evaluate(df, geo.region(F.col("lat"), F.col("lon"))) == [
        "west_north", "west_south", "central_north", "central_south", "east_north", "east_south", "unknown"]
    df = column(spark, [25.0, 25.1, 100.0, 100.1, None], "double")
    assert evaluate(df, geo.proximity_level(F.col("x"))) == ["urban", "suburban", "suburban", "rural", "rural"]
