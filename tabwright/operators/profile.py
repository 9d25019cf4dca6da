"""Column profiles by role, each returned as rows with recommendation labels.

Profiles of moments and conditional counts take one pass without a shuffle. Profiles that
need distinct values share one shuffle of ``value_counts`` for all their columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions import labels
from tabwright.functions.numeric import (
    DEFAULT_ACCURACY,
    finite,
    pearson,
    percent,
    tally,
)
from tabwright.functions.predicates import (
    SIGNED_NUMBER,
    boolean_columns,
    has_number,
    is_blank,
    is_missing,
    is_placeholder,
    is_zero,
    numeric_columns,
    present,
    string_columns,
)
from tabwright.operators.quantile import aggregate
from tabwright.operators.shape import most_frequent, per_column, value_counts
from tabwright.operators.stats import segment_stats
from tabwright.sources.staging import stage


# --- any type --------------------------------------------------------------------------

def null_profile(df: DataFrame) -> DataFrame:
    """Missing count and share of every column, from one counter each, whose single row is turned at last."""
    if not df.columns:
        raise ValueError("no column to aggregate")
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[tally(is_missing(f)).alias(f"_{i}") for i, f in enumerate(df.schema)])
    rows = counts.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.col("_rows").alias("n_total"), F.col(f"_{i}").alias("n_missing")) for i, f in enumerate(df.schema)])))
    return rows.withColumn("missing_pct", percent(F.col("n_missing"), F.col("n_total")))


def target_correlation(df: DataFrame, target: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Correlation of every numeric column with the target, strongest first."""
    cols = numeric_columns(df, [target, *exclude])
    rows = per_column(df.where(F.col(target).isNotNull()),
                      {c: F.col(c).cast("double") for c in cols}, {"corr": pearson(F.col("x"), F.col("_y"))},
                      beside={"_y": F.col(target).cast("double")})
    rows = rows.withColumn("strength", labels.correlation_strength(F.col("corr")))
    return rows.drop("n_total").orderBy(F.abs("corr").desc_nulls_last(), "column")


# --- numeric ---------------------------------------------------------------------------

def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None, exclude: Sequence[str] = (),
                    accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """Moments, median and zeros of each numeric column, with five recommendations."""
    cols = numeric_columns(df, exclude) if cols is None else present(df, cols)
    x = F.col("x")
    rows = per_column(df, {c: F.col(c).cast("double") for c in cols}, {
        "n": F.count(x), "min": F.min(x), "max": F.max(x), "mean": F.avg(x), "stddev": F.stddev(x),
        "skew": F.skewness(x), "kurt": F.kurtosis(x), "zeros": tally(x == 0),
    }, {"median": x}, accuracy=accuracy)
    rows = rows.withColumns({s: finite(F.col(s)) for s in ("min", "max", "mean", "median", "stddev", "skew", "kurt")})
    return rows.withColumns({
        "null_pct": percent(F.col("n_total") - F.col("n"), F.col("n_total")),
        "zero_pct": percent(F.col("zeros"), F.col("n_total")),
    }).withColumns({
        "imputation": labels.numeric_imputation(F.col("null_pct")),
        "transform": labels.skew_transform(F.col("skew")),
        "outliers": labels.kurtosis_outliers(F.col("kurt")),
        "scaling": labels.scaling(F.col("min"), F.col("max"), F.col("stddev")),
        "zero_inflation": labels.zero_inflation(F.col("zero_pct")),
    })


# --- categories ------------------------------------------------------------------------

def string_content(df: DataFrame, cols: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """Nulls, blanks, placeholders, distinct values and values with a number, per column.

    Patterns are matched once per distinct value, weighted by its count. Pass ``counts``
    from ``value_counts`` to share it with other reports.
    """
    counts = value_counts(df, present(df, cols)) if counts is None else counts
    value, n = F.col("value"), F.col("n")

    def weighted(cond):
        return F.sum(F.when(cond, n).otherwise(0))

    return counts.groupBy("column").agg(
        F.sum("n").alias("n_total"),
        weighted(value.isNull()).alias("n_null"),
        weighted(F.trim(value) == "").alias("n_empty"),
        weighted(is_placeholder(value)).alias("n_placeholder"),
        F.count("value").alias("n_distinct"),
        weighted(has_number(value)).alias("n_with_number"),
    )


def string_top_values(df: DataFrame, cols: Sequence[str], n: int = 20, counts: DataFrame | None = None) -> DataFrame:
    """The commonest values of each column: all, those with a number and those without."""
    counts = value_counts(df, present(df, cols)) if counts is None else counts
    value = F.col("value")
    numbered = has_number(value)
    plain = ~is_blank(value) & ~is_placeholder(value) & ~numbered
    kinds = F.array_compact(F.array(
        F.lit("all"), F.when(numbered, F.lit("with_number")), F.when(plain, F.lit("without_number"))))
    return most_frequent(counts.withColumn("kind", F.explode(kinds)), n, ("column", "kind"))


def categorical_profile(df: DataFrame, cols: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """Nulls, distinct values and the commonest value of each column, with three labels.

    Null counts as a value when it is the commonest; equal counts prefer null, then the
    smallest value.
    """
    counts = value_counts(df, present(df, cols)) if counts is None else counts
    n = F.col("n")
    top = F.min(F.struct((-n).alias("minus_n"), F.col("value")))
    rows = counts.groupBy("column").agg(
        F.sum("n").alias("n_total"),
        F.sum(F.when(F.col("value").isNull(), n).otherwise(0)).alias("nulls"),
        F.count("value").alias("distinct"),
        top.alias("_top"),
    )
    rows = rows.withColumns({"top_value": F.col("_top")["value"], "top_count": -F.col("_top")["minus_n"]}).drop("_top")
    return rows.withColumns({
        "null_pct": percent(F.col("nulls"), F.col("n_total")),
        "top_pct": percent(F.col("top_count"), F.col("n_total")),
    }).withColumns({
        "imputation": labels.categorical_imputation(F.col("null_pct")),
        "encoding": labels.encoding(F.col("distinct")),
        "concentration": labels.concentration(F.col("top_pct"), F.col("distinct")),
    })


def category_frequency(df: DataFrame, cols: Sequence[str], n: int = 10, counts: DataFrame | None = None) -> DataFrame:
    counts = value_counts(df, present(df, cols)) if counts is None else counts
    return most_frequent(counts, n)


# --- booleans and flags ----------------------------------------------------------------

def boolean_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Nulls, trues and falses of each boolean column; other types are left out."""
    flags = boolean_columns(df)
    cols = flags if cols is None else [c for c in cols if c in flags]
    x = F.col("x")
    rows = per_column(df, {c: F.col(c) for c in cols}, {
        "nulls": F.count_if(F.col("_row") & x.isNull()), "trues": tally(x), "falses": tally(~x)})
    return rows.withColumns({
        f"{one}_pct": percent(F.col(many), F.col("n_total"))
        for one, many in (("null", "nulls"), ("true", "trues"), ("false", "falses"))
    }).withColumns({
        "imputation": labels.categorical_imputation(F.col("null_pct")),
        "balance": labels.boolean_balance(F.col("true_pct")),
        "usefulness": labels.boolean_usefulness(F.col("true_pct"), F.col("null_pct")),
    })


def flag_columns(df: DataFrame, prefix: str = "has_") -> list[str]:
    """Integer 0/1 flags by name."""
    return [f.name for f in df.schema
            if f.name.startswith(prefix) and isinstance(f.dataType, (T.IntegerType, T.LongType))]


def flag_frequency(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    rows = per_column(df, {c: F.col(c) == 1 for c in cols}, {"n_set": tally(F.col("x"))})
    return rows.withColumn("set_pct", percent(F.col("n_set"), F.col("n_total")))


def flag_impact(df: DataFrame, flags: Sequence[str], target: str, min_group_size: int = 30,
                positive_only: bool = True, accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """Segment statistics of the target for each level of each flag, in one pass."""
    levels = df.select(target, *[F.col(c).cast("int").alias(c) for c in flags])
    levels = levels.unpivot([target], list(flags), "flag", "level")
    return segment_stats(levels, target, ["flag", "level"], positive_only, min_group_size, target, accuracy=accuracy)


def group_health(df: DataFrame, groups: dict[str, Sequence[str]]) -> DataFrame:
    """Null and zero (or false) share of the columns of each group, and the group's health."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    flags, numbers = set(boolean_columns(df)), set(numeric_columns(df))
    member = {c: g for g, cols in groups.items() for c in present(df, cols)}
    def kind(c: str) -> Column:
        zero = ~F.col(c) if c in flags else F.col(c) == 0 if c in numbers else is_zero(F.col(c))
        return F.when(F.col(c).isNull(), F.when(F.coalesce(zero, F.lit(False)), 3).otherwise(1)).when(zero, 2).otherwise(0)

    x = F.col("x")
    rows = per_column(df, {c: kind(c) for c in member}, {"nulls": tally(x % 2 == 1), "zeros": tally(x >= 2)})
    names = F.create_map(*[F.lit(v) for c, g in member.items() for v in (c, g)])
    types = F.create_map(*[F.lit(v) for c in member for v in (c, kinds[c])])
    rows = rows.withColumns({
        "group": names[F.col("column")],
        "type": types[F.col("column")],
        "null_pct": percent(F.col("nulls"), F.col("n_total")),
        "zero_pct": percent(F.col("zeros"), F.col("n_total")),
    })
    mean = F.avg("null_pct").over(Window.partitionBy("group"))
    return rows.withColumn("group_null_pct", mean).withColumn("health", labels.group_health(mean))


# --- text ------------------------------------------------------------------------------

def text_profile(df: DataFrame, cols: Sequence[str], accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """Blank and null counts and the length of the trimmed text of each column."""
    cols = present(df, cols)
    # Only lengths go on, so that the text itself is trimmed once and then forgotten.
    real, size = F.col("_row"), F.when(F.col("x") > 0, F.col("x"))
    rows = per_column(df, {c: F.length(F.trim(F.col(c).cast("string"))) for c in cols}, {
        "blanks": F.count_if(real & size.isNull()),
        "nulls": F.count_if(real & F.col("x").isNull()),
        "min_length": F.coalesce(F.min(size), F.lit(0)),
        "mean_length": F.coalesce(F.avg(size), F.lit(0.0)),
        "max_length": F.coalesce(F.max(size), F.lit(0)),
    }, {"median_length": size}, accuracy=accuracy)
    rows = rows.withColumn("median_length", F.coalesce("median_length", F.lit(0)))
    low, high, mean = F.col("min_length"), F.col("max_length"), F.col("mean_length")
    return rows.withColumn("blank_pct", percent(F.col("blanks"), F.col("n_total"))).withColumns({
        "imputation": labels.text_imputation(F.col("blank_pct")),
        "feature": labels.text_feature(mean),
        "quality": labels.text_quality(low, high, mean),
    })


def mistyped_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text columns that may hold numbers: blank, with a number and without one."""
    cells = {}
    for c in present(df, cols):
        text = F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
        cells[c] = F.when(text == "", 0).when(F.regexp_extract(text, SIGNED_NUMBER, 1) != "", 1).otherwise(2)
    x = F.col("x")
    rows = per_column(df, cells, {"blanks": tally(x == 0), "with_number": tally(x == 1), "without_number": tally(x == 2)})
    rows = rows.withColumns({
        f"{s}_pct": percent(F.col(s), F.col("n_total")) for s in ("blanks", "with_number", "without_number")
    })
    problem = percent(F.col("blanks") + F.col("without_number"), F.col("n_total"))
    return rows.withColumns({
        "extractability": labels.extractability(F.col("with_number_pct")),
        "imputation": labels.extraction_imputation(problem),
        "usefulness": labels.extraction_usefulness(F.col("with_number_pct")),
    })


def extraction_examples(shown: DataFrame) -> DataFrame:
    """Add the extracted number to rows of ``examples``; null where there is none."""
    found = F.regexp_extract("value", SIGNED_NUMBER, 1)
    return shown.withColumn("extracted", F.when(found != "", found))


# --- identifiers and redundancy --------------------------------------------------------

def identifier_profile(df: DataFrame, cols: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """Blanks, distinct values (null is one) and values that occur more than once."""
    counts = value_counts(df, present(df, cols)) if counts is None else counts
    blank = is_blank(F.col("value"))
    rows = counts.groupBy("column").agg(
        F.sum("n").alias("n_total"),
        F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("blanks"),
        F.count(F.lit(1)).alias("distinct"),
        tally((F.col("n") > 1) & ~blank).alias("duplicated_values"),
    )
    return rows.withColumns({
        "null_pct": percent(F.col("blanks"), F.col("n_total")),
        "unique_pct": percent(F.col("distinct"), F.col("n_total")),
    }).withColumn("action", labels.identifier_action(F.col("unique_pct")))


def column_status(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """(column, status) of the columns a profile was asked for: ``profiled``, ``absent``, or ``not_<kind>``.

    ``kind`` is boolean, numeric or string. Profiles leave the last two out; this tells which they were.
    """
    fitting = {"boolean": boolean_columns, "numeric": numeric_columns, "string": string_columns}[kind](df)
    rows = [(c, "profiled" if c in fitting else f"not_{kind}" if c in df.columns else "absent") for c in dict.fromkeys(cols)]
    return df.sparkSession.createDataFrame(rows, "column string, status string")


def redundant_pairs_by_name(cols: Sequence[str]) -> list[tuple[str, str]]:
    """Pairs of names that share a word between underscores, ignoring case."""
    words = {c: {w.strip() for w in c.lower().split("_")} - {""} for c in cols}
    return [(a, b) for a, b in combinations(sorted(words), 2) if words[a] & words[b]]


def redundant_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """How often two columns agree, and how alike their numbers of distinct values are.

    Agreement of all pairs takes one pass. Distinct values of all columns take one shuffle.
    """
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    clean = df.select(*[F.trim(F.lower(F.coalesce(F.col(c).cast("string"), F.lit("")))).alias(c) for c in cols])
    both = {p: (F.col(p[0]) != "") & (F.col(p[1]) != "") for p in pairs}
    wide = clean.agg(*[
        agg for i, p in enumerate(pairs)
        for agg in (tally(both[p]).alias(f"comparable{i}"),
                    tally(both[p] & (F.col(p[0]) == F.col(p[1]))).alias(f"equal{i}"))
    ])
    agreement = wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("column_1"), F.lit(b).alias("column_2"),
                 F.col(f"comparable{i}").alias("comparable"), F.col(f"equal{i}").alias("equal"))
        for i, (a, b) in enumerate(pairs)
    ])))
    sizes = value_counts(clean, cols).where(F.col("value") != "").groupBy("column").agg(
        F.count(F.lit(1)).alias("distinct"))
    rows = agreement
    for i in (1, 2):
        side = sizes.select(F.col("column").alias(f"column_{i}"), F.col("distinct").alias(f"distinct_{i}"))
        rows = rows.join(F.broadcast(side), f"column_{i}", "left")  # one row per profiled column
    rows = rows.fillna(0, ["distinct_1", "distinct_2"])
    ratio = F.try_divide(F.least("distinct_1", "distinct_2"), F.greatest("distinct_1", "distinct_2"))
    return rows.withColumns({
        "match_pct": F.coalesce(percent(F.col("equal"), F.col("comparable")), F.lit(0.0)),
        "distinct_ratio": F.coalesce(ratio, F.lit(0.0)),
    }).withColumn("relation", labels.redundancy(F.col("match_pct"), F.col("distinct_ratio"))).withColumn(
        "action", labels.redundancy_action(F.col("relation")))


# --- geography and time ----------------------------------------------------------------

def geo_quality(df: DataFrame, lat: str = "latitude", lon: str = "longitude", city: str = "city",
                postcode: str = "dealer_zip") -> DataFrame:
    """One row on the quality of coordinates and place names, with a strategy and features that suit it."""
    y, x = F.col(lat), F.col(lon)
    wide = df.agg(
        F.count(F.lit(1)).alias("n_total"),
        tally(y.isNull()).alias("null_lat"), tally(x.isNull()).alias("null_lon"),
        tally(is_blank(F.col(city))).alias("null_city"), tally(is_blank(F.col(postcode))).alias("null_postcode"),
        tally(y.between(-90, 90) & x.between(-180, 180)).alias("valid"),
        tally((y == 0) & (x == 0)).alias("null_island"),
        tally((y == 0) & (x != 0)).alias("lat_zero"), tally((y != 0) & (x == 0)).alias("lon_zero"),
    )
    names = value_counts(df, [city, postcode]).where(~is_blank(F.col("value")))
    sizes = names.agg(tally(F.col("column") == city).alias("city"), tally(F.col("column") == postcode).alias("postcode"))
    wide = wide.withColumn("_sizes", sizes.select(F.struct("city", "postcode")).scalar())
    total = F.col("n_total")
    rows = wide.withColumns({
        "city_distinct": F.col("_sizes")["city"], "postcode_distinct": F.col("_sizes")["postcode"],
        **{f"{c}_pct": percent(F.col(c), total)
           for c in ("null_lat", "null_lon", "null_city", "null_postcode", "valid", "null_island")},
    }).drop("_sizes")
    rows = rows.withColumn("coordinate_quality",
                           labels.coordinate_quality(F.col("valid_pct"), F.col("null_island_pct")))
    return rows.withColumns({
        "coordinate_action": labels.coordinate_action(F.col("coordinate_quality")),
        "strategy": labels.geo_strategy(F.col("valid_pct"), F.col("null_city_pct")),
        **{f"{p}_quality": labels.place_quality(F.col(f"null_{p}_pct"), F.col(f"{p}_distinct"))
           for p in ("city", "postcode")},
        **{f"{p}_action": labels.place_action(F.col(f"null_{p}_pct"), F.col(f"{p}_distinct"))
           for p in ("city", "postcode")},
        "coordinate_features": labels.coordinate_features(F.col("coordinate_quality")),
    }).withColumns({f"{p}_features": labels.place_features(F.col(f"{p}_action"), p) for p in ("city", "postcode")})


def temporal_profile(df: DataFrame, date: str = "listed_date", year: str = "year",
                     days: str = "daysonmarket") -> DataFrame:
    """One row: nulls, ranges, impossible values, distinct years and months, actions and features to derive."""
    when, model_year, elapsed = F.col(date), F.col(year), F.col(days)
    # The distinct years and months of a date column are few, so sets of them stay small.
    wide = df.agg(
        F.count(F.lit(1)).alias("n_total"),
        tally(when.isNull()).alias("null_date"), tally(model_year.isNull()).alias("null_year"),
        tally(elapsed.isNull()).alias("null_days"),
        F.min(when).cast("date").cast("string").alias("min_date"),
        F.max(when).cast("date").cast("string").alias("max_date"),
        F.min(model_year).cast("long").alias("min_year"), F.max(model_year).cast("long").alias("max_year"),
        F.avg(model_year).alias("mean_year"),
        F.min(elapsed).cast("long").alias("min_days"), F.max(elapsed).cast("long").alias("max_days"),
        F.avg(elapsed).alias("mean_days"),
        tally((model_year < 1900) | (model_year > 2100)).alias("invalid_year"),
        tally(elapsed < 0).alias("negative_days"),
        F.size(F.collect_set(F.year(when))).cast("long").alias("distinct_years"),
        F.size(F.collect_set(F.month(when))).cast("long").alias("distinct_months"),
    )
    rows = wide.withColumns({f"{c}_pct": percent(F.col(c), F.col("n_total"))
                             for c in ("null_date", "null_year", "null_days")})
    return rows.withColumns({
        "date_action": labels.date_action(F.col("null_date_pct")),
        "year_action": labels.counted_action(F.col("null_year_pct"), F.col("invalid_year"), "review_or_drop"),
        "days_action": labels.counted_action(F.col("null_days_pct"), F.col("negative_days"), "limited_use"),
        "strategy": labels.temporal_strategy(F.col("null_date_pct"), F.col("null_year_pct")),
        **{f"{part}_features": F.lit(names) for part, names in labels.TEMPORAL_FEATURES.items()},
    })


def temporal_distribution(df: DataFrame, date: str = "listed_date", year: str = "year", n: int = 10) -> DataFrame:
    """Rows by model year (commonest ``n``), listing year (latest ``n``) and listing month."""
    buckets = df.select(F.col(year).cast("int").alias("model_year"), F.year(date).alias("listed_year"),
                        F.month(date).alias("listed_month"))
    cells = buckets.unpivot([], buckets.columns, "distribution", "bucket").where(F.col("bucket").isNotNull())
    counts = cells.groupBy("distribution", "bucket").agg(F.count(F.lit(1)).alias("n"))
    kind, bucket = F.col("distribution"), F.col("bucket")
    sort_key = F.when(kind == "model_year", -F.col("n")).when(kind == "listed_year", -bucket).otherwise(bucket)
    place = F.row_number().over(Window.partitionBy("distribution").orderBy(sort_key, "bucket"))
    limit = F.when(kind == "listed_month", 12).otherwise(n)
    ranked = counts.withColumn("rank", place).where(F.col("rank") <= max(n, 12))
    return ranked.where(F.col("rank") <= limit)


def temporal_examples(df: DataFrame, key: Sequence[str], date: str = "listed_date", year: str = "year",
                      days: str = "daysonmarket", n: int = 5) -> DataFrame:
    """The first ``n`` rows in key order where all three values are present."""
    return df.dropna(subset=[date, year, days]).orderBy(*key).limit(n).select(date, year, days)


# --- whole table -----------------------------------------------------------------------

def dataset_summary(df: DataFrame, target: str, accuracy: int | None = DEFAULT_ACCURACY) -> DataFrame:
    """(section, item, value) rows: size, types, missing columns, target shape, roles."""
    missing = null_profile(df)
    missing = missing.where(F.col("n_missing") > 0).select(
        F.lit("missing").alias("section"), F.col("column").alias("item"), F.col("n_missing").cast("double").alias("value"))
    x = F.col(target).cast("double")
    shape = {"rows": F.count(F.lit(1)).cast("double"), "min": F.min(x), "max": F.max(x), "mean": F.avg(x),
             "skew": F.skewness(x)}
    wide = aggregate(df, [], [agg.alias(name) for name, agg in shape.items()], {"median": (x, (0.5,))}, accuracy)
    wide = wide.withColumn("median", F.col("median")[0])
    measured = wide.select(F.inline(F.array(*[
        F.struct(F.lit("size" if name == "rows" else "target").alias("section"), F.lit(name).alias("item"),
                 F.col(name).alias("value")) for name in (*shape, "median")
    ])))
    kinds: dict[str, int] = {}
    for f in df.schema:
        kinds[f.dataType.simpleString()] = kinds.get(f.dataType.simpleString(), 0) + 1
    facts = [("size", "columns", float(len(df.columns)))]
    facts += [("type", kind, float(n)) for kind, n in kinds.items()]
    for i, f in enumerate(df.schema):
        if isinstance(f.dataType, T.StringType):
            facts.append(("categorical", f.name, float(i)))
        elif isinstance(f.dataType, T.NumericType) and f.name != target:
            facts.append(("missing_flag" if f.name.endswith("_missing") else "feature", f.name, float(i)))
    schema = "section string, item string, value double"
    return df.sparkSession.createDataFrame(facts, schema).unionByName(measured).unionByName(missing)


def staged_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Value counts written once, each column by itself, for several reports that read some of them."""
    return stage(value_counts(df, present(df, cols)), by=["column"])
