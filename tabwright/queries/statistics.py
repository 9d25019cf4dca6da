"""Queries: numeric statistics, outliers and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import features, outliers, rank, stats
from tabwright.plans import vehicles as v
from tabwright.queries.registry import query, rnd, skew
from tabwright.queries.tables import ACCURACY, Tables


def segment_sql(source: str, col: str, keys: str, prefix: str, where: str, having: int = 1) -> str:
    """Checking SQL of ``segment_stats``; ``source`` may be a table or a parenthesised query."""
    s = f"_{prefix}" if prefix else ""
    q = [f"quantile_disc({col}, {p})" for p in (0.25, 0.5, 0.75, 0.95, 0.99)]
    iqr = f"({q[2]} - {q[0]})"
    return f"""
    SELECT {keys}, count(*) AS group_n, {rnd(f'min({col})', 2)} AS min{s}, {rnd(q[0], 2)} AS q1{s},
           {rnd(q[1], 2)} AS median{s}, {rnd(q[2], 2)} AS q3{s}, {rnd(q[3], 2)} AS p95{s}, {rnd(q[4], 2)} AS p99{s},
           {rnd(f'avg({col})', 2)} AS mean{s}, {rnd(f'max({col})', 2)} AS max{s}, {rnd(f'stddev({col})', 2)} AS std{s},
           {rnd(skew(col), 2)} AS skew{s},
           CASE WHEN avg({col}) = 0 THEN NULL ELSE {rnd(f'stddev({col}) / avg({col}) * 100', 2)} END AS cv_pct{s},
           {rnd(iqr, 2)} AS iqr,
           {rnd(f'greatest({q[0]} - 15e-1 * {iqr}, 0e0)', 2)} AS lower_bound_iqr_1_5,
           {rnd(f'{q[2]} + 15e-1 * {iqr}', 2)} AS upper_bound_iqr_1_5,
           {rnd(f'{q[0]} - 3e0 * {iqr}', 2)} AS lower_bound_iqr_3_0,
           {rnd(f'{q[2]} + 3e0 * {iqr}', 2)} AS upper_bound_iqr_3_0
    FROM {source} AS s WHERE {where} GROUP BY {keys} HAVING count(*) >= {having}"""


@query(segment_sql("lineitem", "l_extendedprice", "l_returnflag", "price", "l_extendedprice > 0", 30))
def segment_stats(t: Tables):
    return stats.segment_stats(t.lineitem, "l_extendedprice", ["l_returnflag"], True, 30, "price", accuracy=ACCURACY)


@query(segment_sql("listings", "price", "make_name", "price", "price > 0", 30))
def segment_stats_by_make(t: Tables):
    return stats.segment_stats(t.listings, "price", ["make_name"], True, 30, "price", accuracy=ACCURACY)


@query(segment_sql("listings", "mileage", "is_new", "mileage", "mileage IS NOT NULL"))
def segment_stats_usage(t: Tables):
    return stats.segment_stats(t.listings, "mileage", ["is_new"], False, 1, "mileage", accuracy=ACCURACY)


@query(segment_sql(
    "(SELECT * FROM listings WHERE make_name IN (SELECT make_name FROM listings GROUP BY make_name "
    "ORDER BY count(*) DESC, make_name NULLS FIRST LIMIT 10))", "price", "make_name", "price", "price IS NOT NULL"))
def top_category_stats(t: Tables):
    return rank.top_category_stats(t.listings, "make_name", "price", 10, ACCURACY)


@query(segment_sql(
    "(SELECT * FROM part WHERE p_brand IN (SELECT p_brand FROM part GROUP BY p_brand "
    "ORDER BY count(*) DESC, p_brand LIMIT 20))", "p_retailprice", "p_brand", "p_retailprice", "TRUE"))
def top_brand_stats(t: Tables):
    return rank.top_category_stats(t.part, "p_brand", "p_retailprice", 20, ACCURACY)


@query(f"""
SELECT count(*) AS n_price, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price,
       round(avg(o_totalprice), 4) AS mean_price, quantile_disc(o_totalprice, 0.5) AS median_price,
       round(stddev(o_totalprice), 4) AS std_price, round({skew('o_totalprice')}, 6) AS skew_price,
       round(kurtosis_pop(o_totalprice), 6) AS kurt_price
FROM orders WHERE o_totalprice > 0""")
def global_stats(t: Tables):
    found = stats.global_stats(t.orders, "o_totalprice", True, "price", ACCURACY)
    exact = {c: F.round(c, 4) for c in ("mean_price", "std_price")}
    return found.withColumns(exact | {c: F.round(c, 6) for c in ("skew_price", "kurt_price")})


@query("""
SELECT CAST(p AS DOUBLE) AS percentile, q AS value_price FROM (
  SELECT unnest([0.01, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99]) AS p,
         unnest(quantile_disc(o_totalprice, [0.01, 0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99])) AS q
  FROM orders WHERE o_totalprice > 0) AS x""")
def percentile_table(t: Tables):
    return stats.percentile_table(t.orders, "o_totalprice", True, "price", accuracy=ACCURACY)


@query(f"""
SELECT round({skew('price')}, 6) AS skew_price, round(kurtosis_pop(price), 6) AS kurt_price,
       round({skew('ln(1 + price)')}, 6) AS skew_log_price, round(kurtosis_pop(ln(1 + price)), 6) AS kurt_log_price
FROM listings WHERE price > 0""")
def log_shape(t: Tables):
    return stats.round_doubles(stats.log_shape(t.listings, "price", prefix="price"), 6)


@query(f"""
, q AS (SELECT quantile_disc(price, 0.25) AS q1, quantile_disc(price, 0.5) AS median, quantile_disc(price, 0.75) AS q3
        FROM listings WHERE price > 0)
SELECT q1, median, q3, {rnd('q3 - q1')} AS iqr, {rnd('q1 - 15e-1 * (q3 - q1)')} AS lower_bound_iqr_1_5,
       {rnd('q3 + 15e-1 * (q3 - q1)')} AS upper_bound_iqr_1_5, {rnd('q1 - 3e0 * (q3 - q1)')} AS lower_bound_iqr_3_0,
       {rnd('q3 + 3e0 * (q3 - q1)')} AS upper_bound_iqr_3_0 FROM q""")
def iqr_bounds(t: Tables):
    return stats.round_doubles(stats.global_iqr(t.listings, "price", True, ACCURACY), 4)


def _two_variable_sql(source: str, x: str, y: str, a: str, b: str, where: str) -> str:
    cols = ", ".join(
        f"{rnd(f'avg({c})', 2)} AS mean_{n}, {rnd(f'quantile_disc({c}, 0.5)', 2)} AS median_{n}, "
        f"{rnd(f'min({c})', 2)} AS min_{n}, {rnd(f'max({c})', 2)} AS max_{n}" for c, n in ((y, b), (x, a)))
    return f"""
    , p AS (SELECT {x}, CAST({y} AS DOUBLE) AS {y}, CASE WHEN {x} <> 0 THEN {rnd(f'({y} / {x}) * 100', 2)} END AS r
            FROM {source} AS s WHERE {where})
    SELECT count(*) AS n, round(corr({x}, {y}), 4) AS corr_{a}_{b}, {rnd('avg(r)', 2)} AS ratio_pct_mean,
           quantile_disc(r, 0.5) AS ratio_pct_median, min(r) AS ratio_pct_min, max(r) AS ratio_pct_max, {cols} FROM p"""


@query(_two_variable_sql("listings", "price", "mileage", "price", "mileage", "price > 0 AND mileage > 0"))
def two_variable_stats(t: Tables):
    return stats.two_variable_stats(t.listings, "price", "mileage", accuracy=ACCURACY)


@query(_two_variable_sql(
    "(SELECT price, CAST(year(listed_date) - year AS DOUBLE) AS age FROM listings)", "price", "age", "price", "age",
    "price IS NOT NULL AND age IS NOT NULL"))
def two_variable_stats_age(t: Tables):
    aged = features.add_listing_age(t.listings).withColumn("age", F.col("vehicle_age_at_listing").cast("double"))
    return stats.two_variable_stats(aged, "price", "age", False, accuracy=ACCURACY)


@query("""
SELECT 'horsepower' AS column_1, 'engine_displacement' AS column_2,
       round(corr(horsepower, engine_displacement), 4) AS corr FROM listings
UNION ALL
SELECT 'city_fuel_economy', 'highway_fuel_economy', round(corr(city_fuel_economy, highway_fuel_economy), 4) FROM listings
""")
def pair_correlations(t: Tables):
    pairs = [("horsepower", "engine_displacement"), ("city_fuel_economy", "highway_fuel_economy")]
    return stats.pair_correlations(t.listings, pairs)


# --- outliers ---------------------------------------------------------------------------

def outlier_ctes(source: str, col: str, keys: str, where: str, having: int, k: str, floor: str) -> str:
    using = ", ".join(k_.strip() for k_ in keys.split(","))
    return f"""
    base AS (SELECT * FROM {source} AS s WHERE {where}),
    quart AS (SELECT {keys}, count(*) AS group_n, quantile_disc({col}, 0.25) AS q1, quantile_disc({col}, 0.5) AS med,
                     quantile_disc({col}, 0.75) AS q3, quantile_disc({col}, 0.95) AS p95, quantile_disc({col}, 0.99) AS p99
              FROM base GROUP BY {keys} HAVING count(*) >= {having}),
    found AS (SELECT *, q3 - q1 AS iqr, q1 - {k} * (q3 - q1) AS lo, q3 + {k} * (q3 - q1) AS hi
              FROM base JOIN quart USING ({using})
              WHERE {floor} AND ({col} > q3 + {k} * (q3 - q1) OR {col} < q1 - {k} * (q3 - q1)))"""


def outlier_select(col: str, keys: str, extra: str, median: str = "segment_median") -> str:
    ratios = ", ".join(f"CASE WHEN {q} <> 0 THEN {rnd(f'{col} / {q}', 6)} END AS {col}_to_{n}_ratio"
                       for q, n in (("med", "median"), ("p95", "p95"), ("p99", "p99")))
    return f"""
    SELECT {keys}, {col}, {extra}, group_n, q1, med AS {median}, q3, p95 AS segment_p95, p99 AS segment_p99,
           {rnd('iqr', 6)} AS iqr, {rnd('lo', 6)} AS segment_lower_bound, {rnd('hi', 6)} AS segment_upper_bound, {ratios}
    FROM found"""


@query("WITH " + outlier_ctes("events", '"value"', "event_type", '"value" IS NOT NULL', 30, "15e-1", "TRUE")
       + outlier_select("value", "event_type", "event_id"))
def segment_outliers(t: Tables):
    found = outliers.segment_outliers(t.events, "value", ["event_type"], k=1.5, extra=["event_id"], accuracy=ACCURACY)
    return stats.round_doubles(found, 6)


@query("WITH " + outlier_ctes("events", '"value"', "event_type", '"value" IS NOT NULL', 30, "15e-1", "TRUE") + """
SELECT event_type, count(*) AS n_suspicious, min("value") AS min_suspicious_value,
       quantile_disc("value", 0.5) AS median_suspicious_value, max("value") AS max_suspicious_value
FROM found GROUP BY event_type""")
def outlier_summary(t: Tables):
    found = outliers.segment_outliers(t.events, "value", ["event_type"], k=1.5, accuracy=ACCURACY)
    return outliers.summarize_outliers(found, "value", ["event_type"], accuracy=ACCURACY)


@query(", " + outlier_ctes("listings", "price", "make_name", "price > 0", 100, "3e0", "price >= 4000")
       + outlier_select("price", "make_name", "vin, year, body_type"))
def price_outliers_by_make(t: Tables):
    found = outliers.segment_outliers(t.listings, "price", ["make_name"], True, 100, 3.0, 4000.0,
                                      ("vin", "year", "body_type"), ACCURACY)
    return stats.round_doubles(found, 6)


@query(", " + outlier_ctes("listings", "price", "make_name, body_type, is_new", "price > 0", 30, "3e0", "price >= 100000")
       + outlier_select("price", "make_name, body_type, is_new", "vin, mileage", "segment_median_price"))
def price_outliers_hierarchical(t: Tables):
    found = outliers.price_outliers(t.listings, v.OUTLIER_SEGMENTS, extra=("vin", "mileage"), accuracy=ACCURACY)
    return stats.round_doubles(found, 6)


@query(", " + outlier_ctes("listings", "price", "make_name", "price > 0", 30, "3e0", "price >= 100000") + """
SELECT make_name, count(*) AS n_suspicious, min(price) AS min_suspicious_price,
       quantile_disc(price, 0.5) AS median_suspicious_price, max(price) AS max_suspicious_price
FROM found GROUP BY make_name""")
def price_outlier_summary(t: Tables):
    found = outliers.price_outliers(t.listings, ["make_name"], accuracy=ACCURACY)
    return outliers.summarize_outliers(found, "price", ["make_name"], "price", ACCURACY)


@query(", " + outlier_ctes("listings", "price", "make_name", "price > 0", 30, "3e0", "price >= 100000") + """
SELECT vin, make_name, price FROM found ORDER BY price DESC, vin LIMIT 100""")
def top_outliers(t: Tables):
    found = outliers.price_outliers(t.listings, ["make_name"], extra=["vin"], accuracy=ACCURACY)
    return outliers.top_outliers(found, "price", 100, ["vin"]).select("vin", "make_name", "price")


# --- rankings ---------------------------------------------------------------------------

@query("SELECT o_totalprice, o_orderkey, o_orderpriority FROM orders WHERE o_totalprice > 0 "
       "ORDER BY o_totalprice DESC, o_orderkey LIMIT 30")
def top_extremes(t: Tables):
    return rank.top_extremes(t.orders, "o_totalprice", True, 30, ["o_orderkey", "o_orderpriority"], ["o_orderkey"])


@query(f"SELECT price, {', '.join(v.EXPENSIVE_CONTEXT)} FROM listings WHERE price > 0 ORDER BY price DESC, vin LIMIT 30")
def most_expensive(t: Tables):
    return rank.top_extremes(t.listings, "price", True, 30, v.EXPENSIVE_CONTEXT, ["vin"])


@query(f"""
, kept AS (SELECT * FROM listings WHERE price > 0),
top AS (SELECT make_name FROM kept GROUP BY make_name ORDER BY count(*) DESC, make_name NULLS FIRST LIMIT 15),
ranked AS (SELECT *, row_number() OVER (PARTITION BY make_name ORDER BY price DESC, vin) AS rn
           FROM kept WHERE make_name IN (SELECT make_name FROM top WHERE make_name IS NOT NULL))
SELECT make_name, vin, {', '.join(v.TOP_ROW_CONTEXT)}, price, CAST(rn AS INTEGER) AS rn FROM ranked WHERE rn <= 5""")
def top_rows_per_category(t: Tables):
    return rank.top_rows_per_category(t.listings, "make_name", "price", 15, 5, ("vin", *v.TOP_ROW_CONTEXT), ["vin"])


@query("""
WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY o_totalprice DESC, o_orderkey) AS rn
                FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT c_mktsegment, o_orderkey, o_totalprice, CAST(rn AS INTEGER) AS rn FROM ranked WHERE rn <= 3""")
def top_orders_per_segment(t: Tables):
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return rank.top_rows_per_category(rows, "c_mktsegment", "o_totalprice", 10, 3, ["o_orderkey"], ["o_orderkey"])


@query("SELECT make_name, count(*) AS n FROM listings GROUP BY make_name "
       "ORDER BY count(*) DESC, make_name NULLS FIRST LIMIT 10")
def top_categories(t: Tables):
    return rank.top_categories(t.listings, "make_name", 10)


@query("""
, item AS (SELECT unnest(string_split(regexp_replace(lower(major_options), '[\\[\\]''"\\s]', '', 'g'), ',')) AS option
           FROM listings WHERE major_options IS NOT NULL),
total AS (SELECT count(*) AS total FROM listings WHERE major_options IS NOT NULL)
SELECT option, count(*) AS n, round(CAST(count(*) AS DOUBLE) / any_value(total) * 100, 2) AS pct
FROM item, total WHERE length(option) > 3 AND option <> 'quickorderpackage' AND option <> 'towpackage'
GROUP BY option HAVING round(CAST(count(*) AS DOUBLE) / any_value(total) * 100, 2) >= 1
ORDER BY n DESC, option LIMIT 30""")
def top_options(t: Tables):
    return rank.top_options(t.listings, "major_options", 30, 1.0, exclude=v.EXCLUDED_OPTIONS)


@query("""
WITH item AS (SELECT unnest(string_split(lower(p_name), ' ')) AS option FROM part),
total AS (SELECT count(*) AS total FROM part)
SELECT option, count(*) AS n, round(CAST(count(*) AS DOUBLE) / any_value(total) * 100, 2) AS pct
FROM item, total WHERE length(option) > 3 GROUP BY option ORDER BY n DESC, option LIMIT 10""")
def top_name_words(t: Tables):
    return rank.top_options(t.part, "p_name", 10, 0.0, separator=" ", normalise=F.lower)


DRAW = "CAST(CAST('0x' || substr(md5({key} || '|{purpose}{seed}'), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296e0"


def draw_sql(key: str, seed: int, purpose: str = "") -> str:
    return DRAW.format(key=f"CAST({key} AS VARCHAR)", seed=seed, purpose=f"{purpose}:" if purpose else "")


@query(f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {draw_sql('o_orderkey', 42)}, o_orderkey LIMIT 15")
def random_rows(t: Tables):
    return rank.random_rows(t.orders, ["o_orderkey"], 15).select("o_orderkey", "o_totalprice")
