"""Operators on small frames: null keys, ties, single rows, constants and empty input."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tabwright.functions.draw import unit_draw
from tabwright.operators import caps, features, impute, nearest, outliers, profile, quantile, rank, sample, shape, stats


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_segment_stats_groups_and_bounds(spark):
    values = [("a", float(x)) for x in range(1, 101)] + [("b", 5.0)] + [(None, 7.0)] * 30
    df = spark.createDataFrame(values, "g string, x double")
    found = {r["g"]: r for r in stats.segment_stats(df, "x", ["g", "absent"], accuracy=1_000_000).collect()}
    assert set(found) == {"a", None}  # a single-row group is below the minimum
    a = found["a"]
    assert (a["q1"], a["median"], a["q3"], a["p95"], a["p99"]) == (25, 50, 75, 95, 99)
    assert (a["iqr"], a["lower_bound_iqr_1_5"], a["lower_bound_iqr_3_0"], a["upper_bound_iqr_3_0"]) == (50, 0, -125, 225)
    assert found[None]["std"] == 0 and found[None]["cv_pct"] == 0


def test_segment_stats_of_one_row_and_zero_mean(spark):
    df = spark.createDataFrame([("one", 3.0), ("zero", 1.0), ("zero", -1.0)], "g string, x double")
    found = {r["g"]: r for r in stats.segment_stats(df, "x", ["g"], min_group_size=1).collect()}
    assert found["one"]["std"] is None and found["one"]["skew"] is None
    assert found["zero"]["cv_pct"] is None


def test_statistics_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "x double, y double")
    assert stats.global_stats(df, "x").head()["n"] == 0
    assert stats.global_iqr(df, "x").head()["iqr"] is None
    assert stats.two_variable_stats(df, "x", "y").head()["n"] == 0
    assert profile.numeric_profile(df).where("n_total > 0").count() == 0
    assert {r["value_x"] for r in stats.percentile_table(df, "x").collect()} == {None}


def test_outliers_respect_null_keys_and_minimum(spark):
    values = [("a", float(x)) for x in range(100)] + [("a", 1000.0), ("a", -900.0), (None, 1e9)]
    df = spark.createDataFrame(values, "g string, x double")
    found = outliers.segment_outliers(df, "x", ["g"], min_group_size=1)
    assert [r["x"] for r in found.collect()] == [1000.0, -900.0]
    found = outliers.segment_outliers(df, "x", ["g"], min_group_size=1, min_abs=0.0)
    assert [r["x"] for r in found.collect()] == [1000.0]
    summary = outliers.summarize_outliers(found, "x", ["g"]).head()
    assert (summary["n_suspicious"], summary["max_suspicious_value"]) == (1, 1000.0)
    assert outliers.segment_outliers(df, "x", ["g"], min_group_size=1000).count() == 0


def test_small_fences_are_broadcast_and_large_ones_shuffled(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("g"), F.col("id").cast("double").alias("x"))

    def plan():
        found = outliers.segment_outliers(df, "x", ["g"], min_group_size=1)
        return found._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan()
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
        assert "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_top_rows_break_ties_by_key(spark):
    df = spark.createDataFrame([(i, "a", 5.0) for i in range(9, 0, -1)] + [(10, None, 9.0), (11, "b", 1.0)],
                               "id int, g string, x double")
    found = rank.top_rows_per_category(df.repartition(4), "g", "x", 3, 2, ["id"], ["id"])
    assert rows(found) == [("a", 1, 5.0, 1), ("a", 2, 5.0, 2), ("b", 11, 1.0, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_categories_count_null(spark):
    df = spark.createDataFrame([(None,), (None,), ("b",), ("a",)], "g string")
    assert rows(rank.top_categories(df, "g", 2)) == [(None, 2), ("a", 1)]
    assert rows(rank.in_top_categories(df, "g", 2)) == [("a",)]


def test_top_options(spark):
    df = spark.createDataFrame([("['Sun Roof', 'ABS', 'Tow']",), ("['Sun Roof']",), ("[]",), (None,)], "o string")
    assert rows(rank.top_options(df, "o")) == [("sunroof", 2, 66.67)]
    assert rows(rank.top_options(df, "o", exclude=["sunroof"])) == []
    keyed = df.withColumn("id", F.monotonically_increasing_id())
    assert rows(rank.top_options(keyed, "o", fraction=0.999999, key=["id"])) == [("sunroof", 2, 66.67)]
    with pytest.raises(ValueError):
        rank.top_options(df, "o", fraction=0.5)


def test_in_order(spark):
    df = spark.createDataFrame([("rural",), ("urban",), ("suburban",)], "u string")
    assert rows(rank.in_order(df, "u", ["urban", "suburban"])) == [("urban",), ("suburban",), ("rural",)]


def test_value_counts_partition_the_rows(spark):
    df = spark.createDataFrame([("x", 1), (None, 1), ("x", 2)], "a string, b int")
    counts = shape.value_counts(df, ["a", "b"])
    assert sorted(rows(counts), key=repr) == [("a", "x", 2), ("a", None, 1), ("b", "1", 2), ("b", "2", 1)]
    assert {r["s"] for r in counts.groupBy("column").agg(F.sum("n").alias("s")).collect()} == {3}


def test_columns_are_aggregated_in_one_pass(spark):
    df = spark.range(100).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(1, 8)])
    cells = {f"c{i}": F.col(f"c{i}") for i in range(1, 8)}
    found = shape.per_column(df, cells, {"total": F.sum("x")}, {"middle": F.col("x")})
    assert rows(found, "column") == [(f"c{i}", 100, 4950 * i, 49 * i) for i in range(1, 8)]
    assert rows(shape.per_column(df.limit(0), cells, {"n": F.count("x")}), "column") == [(f"c{i}", 0, 0) for i in range(1, 8)]
    with pytest.raises(ValueError):
        shape.per_column(df, {}, {})


def test_exact_quantiles_of_groups(spark):
    values = [(None if i % 5 == 0 else f"g{i % 2}", float((i * 7919) % 1009), i % 13) for i in range(4000)] + [("one", 2.5, 1), ("none", None, None)]
    df = spark.createDataFrame(values, "g string, x double, n int")
    probs = (0.0, 0.01, 0.5, 0.95, 1.0)
    found = quantile.aggregate(df, ["g"], [F.count("*").alias("c")], {"a": ("x", probs), "b": ("n", (0.5,))}, quantile.EXACT)
    assert dict(found.dtypes)["b"] == "array<int>"
    for row in found.collect():
        known = sorted(x for g, x, _ in values if g == row["g"] and x is not None)
        assert row["a"] == ([known[max(1, math.ceil(p * len(known))) - 1] for p in probs] if known else None)
    nothing = quantile.aggregate(df.limit(0), [], [F.count("*").alias("c")], {"a": ("x", probs)}, quantile.EXACT).collect()
    assert [tuple(r) for r in nothing] == [(0, None)]


@pytest.mark.parametrize("widths", [quantile.WIDTHS, (1e-9, None), (0.0, 1.0, None)])
def test_exact_quantiles_of_wide_types_and_after_missed_brackets(spark, monkeypatch, widths):
    """Brackets without width miss their quantiles: the counts show it, and wider ones follow."""
    monkeypatch.setattr(quantile, "WIDTHS", widths)
    values = [("a" if i % 3 else None, 2**53 + i, i % 7, float(i * i % 997) if i % 5 else -1e300) for i in range(5000)]
    df = spark.createDataFrame(values, "g string, b long, n int, x double").withColumn("d", F.expr("CAST(b AS DECIMAL(30, 2)) * 3"))
    probs = (0.99, 0.0, 0.5, 1.0)
    wanted = {"b": ("b", probs), "n": ("n", (0.25,)), "x": ("x", probs), "d": ("d", (0.1, 0.9))}
    for keys in ([], ["g"]):
        for row in quantile.aggregate(df, keys, [F.count("*").alias("c")], wanted, quantile.EXACT).collect():
            own = [v for v in values if not keys or v[0] == row["g"]]
            for name, at, scale in (("b", 1, 1), ("n", 2, 1), ("x", 3, 1), ("d", 1, 3)):
                known = sorted(v[at] for v in own)
                assert row[name] == [scale * known[max(1, math.ceil(p * len(known))) - 1] for p in wanted[name][1]]
            assert row["c"] == len(own)


@pytest.mark.parametrize("crowded, slots", [(1 << 22, 4096), (3, 5)])
def test_exact_quantiles_by_counted_bins(spark, monkeypatch, crowded, slots):
    """No sketch goes over the rows; narrow, wide, negative, infinite and missing values, also when crowded bins are divided."""
    monkeypatch.setattr(quantile, "CROWDED", crowded)
    monkeypatch.setattr(quantile, "SLOTS", slots)
    plans, staged = [], quantile.stage

    def seen(df, *given):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return staged(df, *given)

    monkeypatch.setattr(quantile, "stage", seen)
    odd = [float("nan"), float("inf"), float("-inf"), -0.0, 0.0, 5e-324, -1.7e308, 1.7e308, None]
    values = [(i % 2, 1.7e9 + i * 37 % 500, 2**60 + i * 11 % 400, odd[i % 9] if i % 3 else i * 0.001 - 0.2) for i in range(600)]
    df = spark.createDataFrame(values, "g int, narrow double, big long, odd double")
    probs = (0.0, 0.37, 0.5, 0.99, 1.0)
    wanted = {c: (c, probs) for c in ("narrow", "big", "odd")}
    for row in quantile.aggregate(df, ["g"], [F.count("*").alias("c")], wanted, quantile.EXACT).collect():
        for name, at in (("narrow", 1), ("big", 2), ("odd", 3)):
            known = sorted((v[at] for v in values if v[0] == row["g"] and v[at] is not None), key=lambda x: (math.isnan(x), x))
            want = [known[max(1, math.ceil(p * len(known))) - 1] for p in probs]
            assert all(a == b or math.isnan(a) and math.isnan(b) for a, b in zip(row[name], want, strict=True)), (name, row[name], want)
    assert not any("percentile_approx" in p and "Scan ExistingRDD" in p for p in plans)


def _miles(a, b):
    (p, q), (r, s) = (map(math.radians, place) for place in (a, b))
    chord = math.sin((r - p) / 2) ** 2 + math.cos(p) * math.cos(r) * math.sin((s - q) / 2) ** 2
    return math.asin(min(1.0, math.sqrt(chord))) * 2 * 3958.8


@pytest.mark.parametrize("cell", [None, 0.5, 0.003])
def test_nearest_centres_across_poles_and_the_date_line(spark, cell):
    draw = random.Random(3)
    centres = [(i, draw.uniform(-90, 90), draw.uniform(-180, 180)) for i in range(120)] + [(500, 89.9, 10.0), (501, -90.0, 0.0), (502, 0.0, 180.0), (503, 0.0, -180.0)]
    centres += [(600 + i, 41.0 + i / 1e4, 2.0) for i in range(60)] + [(900, None, 1.0), (7, centres[7][1], centres[7][2])]
    rows = [(i, draw.uniform(-90, 90), draw.uniform(-180, 180)) for i in range(150)] + [(900 + i, 41.0 + i / 997, 2.0) for i in range(40)]
    rows += [(2000, 0.0, 179.9999), (2001, 90.0, 77.0), (2002, None, 3.0), (2003, 1.0, None), (2004, -89.0, 180.0)]
    kind = "k long, latitude double, longitude double"
    found = nearest.nearest(spark.createDataFrame(rows, kind), spark.createDataFrame(centres, kind), "k", "k", cell=cell).collect()
    assert len(found) == len(rows)
    places = [(k, (a, b)) for k, a, b in centres if a is not None]
    for k, lat, lon in rows:
        row = next(r for r in found if r["k"] == k)
        if lat is None or lon is None:
            assert row["nearest"] is None and row["miles"] is None
            continue
        miles, best = min((_miles((lat, lon), place), i) for i, place in places)
        assert row["miles"] == pytest.approx(miles, abs=1e-5)
        assert row["nearest"] == best or _miles((lat, lon), dict(places)[row["nearest"]]) == pytest.approx(miles, abs=1e-5)


def test_no_centres(spark):
    rows = spark.createDataFrame([(1, 2.0, 3.0)], "k long, latitude double, longitude double")
    assert nearest.nearest(rows, rows.limit(0), "k", "k").collect() == [(1, None, None)]


def test_quantiles_of_several_sets(spark):
    values = [(i % 3 or None, f"k{i % 2}", float(i * 37 % 101), i if i % 4 else None) for i in range(900)]
    df = spark.createDataFrame(values, "a int, b string, x double, y long")
    sets = [([], {"x": ("x", (0.5,)), "y": ("y", (0.5,))}), (["a"], {"x": ("x", (0.25, 0.75))}), (["a", "b"], {"y": ("y", (0.9,)), "x": ("x", (0.1,))})]
    for accuracy in (quantile.EXACT, 10_000):
        for frame, (keys, wanted) in zip(quantile.by_sets(df, sets, accuracy), sets, strict=True):
            rows = frame.collect()
            assert frame.columns == [*keys, *wanted] and len(rows) == (6 if len(keys) == 2 else 3 if keys else 1)
            for row in rows:
                own = [v for v in values if all(v["ab".index(k)] == row[k] for k in keys)]
                for name, (_, probs) in wanted.items():
                    known = sorted(v["abxy".index(name)] for v in own if v["abxy".index(name)] is not None)
                    assert row[name] == [known[max(1, math.ceil(p * len(known))) - 1] for p in probs]


def test_a_sampled_table_splits_like_any_other(spark):
    """The share of the test side, of validation rows and of folds in each stratum of a sample, within four standard errors."""
    df = spark.range(60_000).select("id", (F.col("id") % 3).alias("s"))
    kept = sample.stratified_sample(df, F.col("s"), ["id"], 20_000, 500)
    train, test = sample.split(kept, ["id"])
    n, held = ({r["s"]: r["n"] for r in side.groupBy("s").agg(F.count("*").alias("n")).collect()} for side in (kept, test))
    assert set(held) == {0, 1, 2}
    for s, rows in n.items():
        assert abs(held[s] / rows - 0.2) < 4 * math.sqrt(0.16 / rows)
    for part, purpose in ((train, "validation"), (test, "search"), (train, "fold")):
        total = part.count()
        share = part.where(unit_draw(["id"], 42, purpose) < 0.2).count() / total
        assert abs(share - 0.2) < 4 * math.sqrt(0.16 / total)


def test_draws_for_different_purposes_are_independent(spark):
    names = ["", "sample", "thin", "split", "search", "fold", "validation"]
    draws = spark.range(40_000).select(*[unit_draw(["id"], 42, n).alias(f"d{i}") for i, n in enumerate(names)])
    found = draws.agg(*[F.corr(f"d{i}", f"d{j}").alias(f"{i}_{j}") for i in range(len(names)) for j in range(i)]).head()
    assert all(abs(c) < 4.5 / math.sqrt(40_000) for c in found)


def test_rows_without_a_stratum_are_sampled_too(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("s"))
    assert sample.stratified_sample(df, F.col("s"), ["id"], 10**6).count() == 100
    assert sample.stratified_sample(df, F.col("s"), ["id"], 20, min_rows=5).where("s IS NULL").count() > 0


def test_keys_with_nulls_and_bars_draw_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a|b", "c"), ("a", "b|c"), ("\\0", "a")], "a string, b string")
    assert df.select(unit_draw(["a", "b"], 1)).distinct().count() == 5


def test_numeric_profile_of_a_constant(spark):
    df = spark.createDataFrame([(7, 1.0), (7, None), (7, float("nan"))], "k int, x double")
    found = {r["column"]: r for r in profile.numeric_profile(df).collect()}
    assert found["k"]["scaling"] == "constant_drop" and found["k"]["transform"] == "not_computable"
    assert found["x"]["n"] == 2 and found["x"]["mean"] is None


def test_categorical_profile_prefers_null_on_ties(spark):
    df = spark.createDataFrame([(None,), ("b",), ("a",)], "g string")
    top = profile.categorical_profile(df, ["g", "absent"]).head()
    assert (top["distinct"], top["nulls"], top["top_value"], top["top_count"]) == (2, 1, None, 1)


def test_boolean_counts_add_up(spark):
    df = spark.createDataFrame([(True, 1), (False, 1), (None, 0)], "b boolean, i int")
    (row,) = profile.boolean_profile(df, ["b", "i", "absent"]).collect()
    assert row["nulls"] + row["trues"] + row["falses"] == row["n_total"] == 3


def test_text_and_mistyped_profiles(spark):
    df = spark.createDataFrame([(" abc ",), ("  ",), (None,), ("-3,5 in",)], "t string")
    row = profile.text_profile(df, ["t"]).head()
    assert (row["blanks"], row["nulls"], row["min_length"], row["max_length"]) == (2, 1, 3, 7)
    row = profile.mistyped_profile(df, ["t"]).head()
    assert (row["blanks"], row["with_number"], row["without_number"]) == (2, 1, 1)
    shown = profile.extraction_examples(shape.examples(df, ["t"], ["t"], 2))
    assert rows(shown, "value") == [("t", "-3,5 in", "-3,5"), ("t", "abc", None)]


def test_identifier_profile_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    row = profile.identifier_profile(df, ["k"]).head()
    assert (row["distinct"], row["duplicated_values"], row["blanks"], row["action"]) == (3, 1, 1, "review")


def test_redundant_pairs(spark):
    assert profile.redundant_pairs_by_name(["Wheel_system", "wheel_size", "color"]) == [("Wheel_system", "wheel_size")]
    df = spark.createDataFrame([("A ", "a", "z"), ("b", "B", "z"), (None, "c", None)], "p string, q string, r string")
    found = {(r["column_1"], r["column_2"]): r for r in profile.redundant_pairs(df, [("p", "q"), ("q", "r")]).collect()}
    assert (found["p", "q"]["match_pct"], found["p", "q"]["distinct_1"], found["p", "q"]["distinct_2"]) == (100, 2, 3)
    assert found["p", "q"]["relation"] == "possible" and found["q", "r"]["relation"] == "none"


def test_geo_quality(spark):
    df = spark.createDataFrame([(0.0, 0.0, "x", None), (91.0, 0.0, " ", "1"), (0.0, 5.0, "x", "2"), (None, None, None, None)],
                               "latitude double, longitude double, city string, dealer_zip string")
    row = profile.geo_quality(df).head()
    assert (row["valid"], row["null_island"], row["lat_zero"], row["lon_zero"]) == (2, 1, 1, 1)
    assert (row["city_distinct"], row["null_city"], row["postcode_distinct"]) == (1, 2, 2)


def test_temporal_profile(spark):
    df = spark.sql("SELECT * FROM VALUES (DATE'2020-05-01', 1899, -1), (NULL, 2101, 5), (DATE'2021-05-02', NULL, NULL) "
                   "AS t(listed_date, year, daysonmarket)")
    row = profile.temporal_profile(df).head()
    assert (row["invalid_year"], row["negative_days"], row["distinct_years"], row["distinct_months"]) == (2, 1, 2, 1)
    found = rows(profile.temporal_distribution(df).where("distribution = 'listed_year'"), "rank")
    assert [r[1] for r in found] == [2021, 2020]


# --- features, caps, imputation ---------------------------------------------------------

def test_high_end_flag(spark):
    values = [(float(p), "kia", "sedan", 100.0) for p in range(4001, 5001)]
    values += [(4950.0, " BMW ", "sedan", 100.0), (4950.0, "kia", "Coupe", None), (4000.0, "bmw", "coupe", 999.0), (None, "bmw", "coupe", 999.0)]
    df = spark.createDataFrame(values, "price double, make_name string, body_type string, horsepower double")
    limits = features.fit_price_thresholds(df, accuracy=1_000_000)
    assert limits.head()["q0"] == 4902.0
    found = features.add_high_end_flag(df, limits, ["bmw"], ["coupe"]).tail(4)
    assert [r["gama_alta"] for r in found] == [1, 1, 0, 0]


def test_usage_cleaning(spark):
    values = [(False, float(x)) for x in range(1, 101)] + [(False, 99_999_999.0), (True, 501.0), (True, 500.0), (None, 1e9)]
    df = spark.createDataFrame(values, "is_new boolean, mileage double")
    cap = caps.fit_usage_cap(df, "mileage", "is_new", accuracy=1_000_000)
    found = caps.clean_usage(df, "mileage", "is_new", cap).tail(4)
    assert [r["mileage"] for r in found] == [99.0, None, 500.0, 1e9]


def test_group_cap_drops_null_values_of_capped_groups_only(spark):
    df = spark.createDataFrame([("Ford", 1.0), ("Ford", None), ("Other", None), (None, 3.0)], "make string, price double")
    limits = caps.fit_group_caps(df, "price", "make", ["Ford"])
    kept = rows(caps.drop_above_group_cap(df, "price", "make", limits))
    assert sorted(kept, key=repr) == [("Ford", 1.0), ("Other", None), (None, 3.0)]


def test_option_features(spark):
    df = spark.createDataFrame([("['Sun Roof/Moon', \"ABS\"]", "abc"), ("[]", None), (None, "")], "o string, d string")
    found = features.add_option_features(df, ["sunroof/moon"], "o", "d")
    assert found.columns == ["description_length", "option_count", "has_sunroof_moon"]
    assert rows(found) == [(3, 2, 1), (0, 1, 0), (0, 0, 0)]


def test_truck_details(spark):
    df = spark.createDataFrame([("Pickup Truck", "Long"), ("Pickup Truck", " -- "), ("Sedan", "Long"), (None, "Long")],
                               "body_type string, bed string")
    assert [(r["is_pickup"], r["bed"]) for r in features.add_truck_flag(df).collect()] == [
        (1, "Long"), (1, None), (0, None), (0, None)]


def test_rule_order_decides_the_label(spark):
    df = spark.createDataFrame([("Compressed Natural Gas",), ("Flex Fuel",), ("Steam",), (None,)], "f string")
    found = features.normalise_label(df, "f", "out", [("gas", "gasoline"), ("flex", "flex_fuel")])
    assert [r["out"] for r in found.collect()] == ["gasoline", "flex_fuel", "other", "unknown"]


def test_condition_segment(spark):
    df = spark.createDataFrame(
        [(1995, True, 0.0), (None, None, 0.0), (2000, True, 0.0), (2000, None, 200_001.0), (2024, None, 49.0),
         (2024, False, None), (2023, None, 1.0)], "year int, salvage boolean, mileage double")
    found = features.add_condition_segment(df.withColumn("theft", F.lit(None).cast("boolean")), ["salvage", "theft"])
    assert [r["segmento_estado"] for r in found.collect()] == [
        "clasico_o_muy_viejo", "clasico_o_muy_viejo", "desguace_o_riesgo", "desguace_o_riesgo", "nuevo_o_seminuevo",
        "estandar", "estandar"]


def test_small_features(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, 0.0), (None, 2.0), (4.0, None)], "a double, b double")
    assert [r["r"] for r in features.add_ratio(df, "a", "b", "r").collect()] == [2.0, None, None, None]
    df = spark.createDataFrame([(1.0,), (0.0,), (-5.0,), (None,)], "price double")
    assert [r["log_price"] for r in features.log_target(df).collect()] == [0.0, None, None, None]
    assert features.binarize(df, "price", "p", "drop").columns == []
    assert features.binarize(df, "price", "p", "binary").columns == ["p"]
    assert features.binarize(df, "price", "p", "keep_both").columns == ["price", "p"]
    assert features.binarize(df, "price", "p", "as_is").columns == ["price"]
    df = spark.sql("SELECT * FROM VALUES (DATE'2020-01-01', 2021), (DATE'2020-01-01', 1990), (DATE'2020-01-01', 1989), (NULL, 2000) AS t(listed_date, year)")
    assert [r["vehicle_age_at_listing"] for r in features.add_temporal(df).collect()] == [None, 30.0, None, None]
    assert [r["vehicle_age_at_listing"] for r in features.add_listing_age(df).collect()] == [-1, 30, 31, None]


def test_back_transform_of_zero_price(spark):
    df = spark.createDataFrame([(0.0, 0.0), (-20.0, 1.0)], "log_price double, prediction double")
    assert [(r["actual"], r["error_pct"]) for r in features.back_transform(df).collect()] == [(1, 0.0), (0, None)]


def test_group_medians_fall_back_to_the_global_one(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 1), ("a", 3.0, None), ("a", None, None), ("b", None, None), (None, None, 9), (None, 50.0, None)],
        "g string, x double, n int")
    fitted = impute.fit_group_medians(df, ["x", "n", "absent"], ["g"])
    found = impute.flag_and_impute(df, fitted)
    assert found.where("x IS NULL OR n IS NULL").count() == 0
    by = {(r["g"], r["x_missing"], r["n_missing"]): (r["x"], r["n"]) for r in found.collect()}
    assert by["a", 1, 1] == (1.0, 1) and by["b", 1, 1] == (3.0, 1) and by[None, 1, 0] == (3.0, 9)
    train_only = impute.fit_group_medians(df.where("g = 'a'"), ["x"], ["g"])
    assert {r["x"] for r in impute.impute_group_medians(df.where("g = 'b'"), train_only).collect()} == {1.0}


def test_median_fallback(spark):
    empty = spark.createDataFrame([(None,)], "age double")
    assert impute.impute_median(empty, "age", 5.0).head()["age"] == 5.0


# --- sampling ---------------------------------------------------------------------------

def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(5000)
    train, test = sample.split(df, ["id"])
    assert train.count() + test.count() == 5000 and train.join(test, "id").count() == 0
    again, _ = sample.split(df.repartition(13), ["id"])
    assert rows(train, "id") == rows(again, "id")
    assert 0.78 < train.count() / 5000 < 0.82


def test_stratified_sample_keeps_small_strata_whole(spark):
    df = spark.range(10_000).withColumn("g", F.when(F.col("id") < 50, "rare").otherwise("common"))
    found = sample.stratified_sample(df, F.col("g"), ["id"], target=2000, min_rows=60)
    counts = {r["g"]: r["count"] for r in found.groupBy("g").count().collect()}
    assert 40 <= counts["rare"] <= 50 and 1800 < counts["common"] < 2100
    assert sample.stratified_sample(df, F.col("g"), ["id"], target=10_000).count() == 10_000
    with pytest.raises(ValueError):
        sample.stratified_sample(df, F.col("g"), ["id"], required=["absent"])
