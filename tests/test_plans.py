"""Physical plans: what is read, shuffled and broadcast."""

import pytest
from pyspark.sql import functions as F

from tabwright.operators import caps, impute, outliers, profile, quantile, rank, sample, shape, stats

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{FOLDER}/lineitem.parquet")


def test_statistics_read_only_their_columns(lineitem):
    found = plan(stats.segment_stats(lineitem, "l_extendedprice", ["l_returnflag"], True))
    assert "ReadSchema: struct<l_extendedprice:double,l_returnflag:string>" in found
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThan(l_extendedprice,0.0)]" in found
    assert found.count("Exchange hashpartitioning") == 1 and "partial_percentile_approx" in found


def test_profiles_read_once_and_send_a_row_per_column(lineitem):
    wide = lineitem.select("*", *[(F.col("l_tax") * i).alias(f"x{i}") for i in range(60)])
    numbers = [f"x{i}" for i in range(60)]
    for df, scans in ((profile.null_profile(wide), 1), (profile.numeric_profile(wide, numbers), 2), (profile.target_correlation(wide, "l_tax"), 1),
                      (profile.mistyped_profile(wide, numbers), 1), (shape.examples(wide, numbers, ["l_orderkey"]), 1)):
        found = plan(df)
        assert found.count("Scan parquet") == scans
        assert found.count("hashpartitioning(column") <= scans and "partial_" in found or "WindowGroupLimit" in found


def test_missing_values_are_counted_without_a_row_per_cell(lineitem):
    found = profile.null_profile(lineitem.select("*", *[(F.col("l_tax") * i).alias(f"x{i}") for i in range(60)]))
    assert "Expand" not in plan(found) and "partial_count" in plan(found)
    assert [r["n_total"] for r in profile.null_profile(lineitem.limit(0)).collect()] == [0] * len(lineitem.columns)


def test_outliers_are_summed_without_a_sort(lineitem):
    found = outliers.segment_outliers(lineitem, "l_extendedprice", ["l_returnflag"])
    assert "rangepartitioning" not in plan(outliers.summarize_outliers(found, "l_extendedprice", ["l_returnflag"])).split("HashAggregate")[-1]


def test_value_counts_shuffle_once_for_all_columns(lineitem):
    found = plan(shape.value_counts(lineitem, ["l_returnflag", "l_linestatus", "l_quantity"]))
    assert found.count("Exchange") == 1 and found.count("Scan parquet") == 1 and "partial_count" in found


def test_rankings_keep_k_rows_before_the_shuffle(lineitem):
    found = plan(shape.most_frequent(shape.value_counts(lineitem, ["l_partkey", "l_suppkey"]), 5))
    assert "WindowGroupLimit" in found and "Partial" in found
    assert "TakeOrderedAndProject" in plan(rank.top_extremes(lineitem, "l_tax", n=3))
    assert "WindowGroupLimit" in plan(shape.examples(lineitem, ["l_returnflag"], ["l_orderkey"]))


def test_fitted_tables_join_without_shuffling_the_rows(lineitem):
    keyed = lineitem.withColumn("flag", F.col("l_returnflag"))
    fitted = impute.fit_group_medians(keyed, ["l_tax", "l_discount"], ["flag", "l_linestatus"])
    for df in (impute.impute_group_medians(keyed, fitted),
               caps.drop_above_group_cap(keyed, "l_tax", "flag", caps.fit_group_caps(keyed, "l_tax", "flag")),
               caps.winsorize_upper(keyed, "l_tax"),
               sample.stratified_sample(keyed, F.col("flag"), ["l_orderkey", "l_linenumber"], 100, 5)):
        main = plan(df).split("Subquery")[0]
        assert "hashpartitioning" not in main and "SortMergeJoin" not in main


def test_all_blocks_of_medians_take_two_scans(spark, lineitem, monkeypatch):
    """A sketch and a count for four blocks, the whole and a cap; no join without keys, and no window over a whole bracket."""
    plans, staged = [], quantile.stage

    def seen(df, *given):
        plans.append(plan(df))
        return staged(df, *given)

    monkeypatch.setattr(quantile, "stage", seen)
    blocks = [(["l_tax", "l_discount"], ["l_returnflag"]), (["l_quantity"], ["l_returnflag", "l_linestatus"]), (["l_extendedprice"], ["l_linestatus"])]
    fitted, (caps_,) = impute.fit_with(lineitem, blocks, [(["l_linenumber"], {"cap": ("l_tax", (0.99,))})], quantile.EXACT)
    assert len(fitted) == 3 and caps_.count() == lineitem.select("l_linenumber").distinct().count()
    assert sum("lineitem.parquet" in p for p in plans) == 2
    assert not any("NestedLoop" in p or "Cartesian" in p for p in plans)
    ranked = [p for p in plans if "_part" in p]
    assert ranked and all("_g#" in p and "_i#" in p for p in ranked)


def test_one_subquery_serves_all_global_medians(lineitem):
    fitted = impute.fit_group_medians(lineitem, ["l_tax", "l_discount", "l_quantity"], ["l_returnflag"])
    found = plan(impute.impute_group_medians(lineitem, fitted))
    assert len({line for line in found.splitlines() if "Subquery subquery#" in line and "ReusedSubquery" not in line}) <= 2
