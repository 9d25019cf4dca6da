"""Queries: feature derivation, capping, imputation, sampling and the whole preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.functions.draw import unit_draw
from tabwright.functions.geo import haversine_miles
from tabwright.operators import caps, features, impute, rank, sample, stats
from tabwright.operators.nearest import nearest
from tabwright.plans import vehicles as v
from tabwright.plans.prepare import load_or_prepare, prepare, prepare_split
from tabwright.queries.registry import query, rnd, union
from tabwright.queries.statistics import draw_sql, segment_sql
from tabwright.queries.tables import ACCURACY, LISTING_COLUMNS, Tables

# --- geography --------------------------------------------------------------------------

REGION = """CASE WHEN latitude IS NULL OR longitude IS NULL THEN 'unknown' ELSE
  (CASE WHEN longitude < -100 THEN 'west' WHEN longitude < -85 THEN 'central' ELSE 'east' END) ||
  (CASE WHEN latitude >= 37 THEN '_north' ELSE '_south' END) END"""


def _miles(lat: float, lon: float) -> str:
    chord = (f"pow(sin(radians({lat}e0 - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians({lat}e0)) "
             f"* pow(sin(radians({lon}e0 - longitude) / 2), 2)")
    return f"asin(least(1e0, sqrt({chord}))) * {2 * 3958.8}e0"


# Null coordinates give a null distance, which least() would skip over.
MILES = (f"CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN "
         f"least({', '.join(_miles(*c) for c in v.CITY_CENTRES)}) END")
LEVEL = "CASE WHEN miles <= 25 THEN 'urban' WHEN miles <= 100 THEN 'suburban' ELSE 'rural' END"
PLACED = f"placed AS (SELECT *, {REGION} AS geo_region, {MILES} AS miles FROM listings)"


@query(f"SELECT geo_region, count(*) AS n FROM (SELECT {REGION} AS geo_region FROM listings) AS r GROUP BY geo_region")
def geo_region(t: Tables):
    return features.add_region(t.listings).groupBy("geo_region").agg(F.count(F.lit(1)).alias("n"))


@query(f", {PLACED} SELECT vin, geo_region, round(miles, 4) AS dist_to_major_city_miles, {LEVEL} AS urban_level FROM placed")
def urban_proximity(t: Tables):
    found = features.add_geography(t.listings, v.CITY_CENTRES)
    return stats.round_doubles(found.select("vin", "geo_region", "dist_to_major_city_miles", "urban_level"), 4)


@query(f"SELECT vin, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL "
       f"THEN round({_miles(40.7128, -74.006)}, 4) END AS miles FROM listings")
def haversine(t: Tables):
    miles = haversine_miles(F.col("latitude"), F.col("longitude"), 40.7128, -74.006)
    return t.listings.select("vin", F.round(miles, 4).alias("miles"))


@query(f", {PLACED}, levelled AS (SELECT price, {LEVEL} AS urban_level FROM placed)"
       + segment_sql("levelled", "price", "urban_level", "price", "price > 0", 30))
def price_by_proximity(t: Tables):
    placed = features.add_geography(t.listings, v.CITY_CENTRES)
    found = stats.segment_stats(placed, "price", ["urban_level"], True, 30, "price", accuracy=ACCURACY)
    return rank.in_order(found, "urban_level", ["urban", "suburban"])


@query(f", {PLACED} SELECT 'miles' AS column_1, 'price' AS column_2, round(corr(miles, price), 4) AS corr FROM placed")
def distance_correlation(t: Tables):
    placed = features.add_geography(t.listings, v.CITY_CENTRES).withColumnRenamed("dist_to_major_city_miles", "miles")
    return stats.pair_correlations(placed, [("miles", "price")])


# --- value features ---------------------------------------------------------------------

THRESHOLDS = ("limits AS (SELECT quantile_disc(price, 0.9) AS p90, quantile_disc(price, 0.95) AS p95 "
              "FROM listings WHERE price > 4000)")
_LISTED = "trim(lower({0})) IN ({1})"
PREMIUM = " OR ".join([
    "horsepower > 300",
    _LISTED.format("make_name", ", ".join(f"'{m}'" for m in v.PREMIUM_MAKES)),
    _LISTED.format("body_type", ", ".join(f"'{b}'" for b in v.PREMIUM_BODIES)),
])
HIGH_END = f"CASE WHEN price <= 4000 THEN 0 WHEN price >= p95 THEN 1 WHEN price >= p90 AND ({PREMIUM}) THEN 1 ELSE 0 END"


@query(f", {THRESHOLDS} SELECT p90 AS q0, p95 AS q1 FROM limits")
def price_thresholds(t: Tables):
    return features.fit_price_thresholds(t.listings, accuracy=ACCURACY)


@query(f", {THRESHOLDS} SELECT vin, CAST({HIGH_END} AS INTEGER) AS gama_alta FROM listings, limits")
def high_end_flag(t: Tables):
    limits = features.fit_price_thresholds(t.listings, accuracy=ACCURACY)
    found = features.add_high_end_flag(t.listings, limits, v.PREMIUM_MAKES, v.PREMIUM_BODIES)
    return found.select("vin", "gama_alta")


USAGE_CAP = ("usage_cap AS (SELECT quantile_disc(mileage, 0.99) AS cap FROM listings "
             "WHERE NOT is_new AND mileage < 99000000)")
USAGE = ("CASE WHEN is_new AND mileage > 500 THEN NULL WHEN NOT is_new AND mileage > (SELECT cap FROM usage_cap) "
         "THEN (SELECT cap FROM usage_cap) ELSE mileage END")
DAYS_CAP = "days_cap AS (SELECT quantile_disc(daysonmarket, 0.99) AS cap FROM listings)"
DAYS = "CASE WHEN daysonmarket > (SELECT cap FROM days_cap) THEN (SELECT cap FROM days_cap) ELSE daysonmarket END"


@query(f", {USAGE_CAP} SELECT vin, {USAGE} AS mileage FROM listings")
def usage_cleaning(t: Tables):
    cap = caps.fit_usage_cap(t.listings, "mileage", "is_new", accuracy=ACCURACY)
    return caps.clean_usage(t.listings, "mileage", "is_new", cap).select("vin", "mileage")


@query(f", {DAYS_CAP} SELECT vin, {DAYS} AS daysonmarket FROM listings")
def winsorize(t: Tables):
    return caps.winsorize_upper(t.listings, "daysonmarket", accuracy=ACCURACY).select("vin", "daysonmarket")


@query("""
WITH cap AS (SELECT quantile_disc(l_extendedprice, 0.95) AS c FROM lineitem)
SELECT l_returnflag, max(capped) AS top, count(*) FILTER (WHERE capped < l_extendedprice) AS n_capped FROM (
  SELECT *, CASE WHEN l_extendedprice > (SELECT c FROM cap) THEN (SELECT c FROM cap) ELSE l_extendedprice END AS capped
  FROM lineitem) AS x GROUP BY l_returnflag""")
def winsorize_lineitem(t: Tables):
    rows = t.lineitem.withColumn("capped", F.col("l_extendedprice"))
    found = caps.winsorize_upper(rows, "capped", 0.95, ACCURACY)
    lowered = F.count_if(F.col("capped") < F.col("l_extendedprice"))
    return found.groupBy("l_returnflag").agg(F.max("capped").alias("top"), lowered.alias("n_capped"))


_MAKES = ", ".join(f"'{m}'" for m in v.MASS_MARKET_MAKES)
MAKE_CAPS = (f"make_caps AS (SELECT make_name, quantile_disc(price, 0.99) AS cap FROM listings "
             f"WHERE make_name IN ({_MAKES}) GROUP BY make_name)")


@query(f", {MAKE_CAPS} SELECT vin, make_name, price FROM listings LEFT JOIN make_caps USING (make_name) "
       "WHERE cap IS NULL OR price <= cap")
def group_price_filter(t: Tables):
    limits = caps.fit_group_caps(t.listings, "price", "make_name", v.MASS_MARKET_MAKES, accuracy=ACCURACY)
    return caps.drop_above_group_cap(t.listings, "price", "make_name", limits).select("vin", "make_name", "price")


@query("""
SELECT vin, savings_amount, CAST(CASE WHEN savings_amount > 0 THEN 1 ELSE 0 END AS INTEGER) AS has_savings FROM listings""")
def binarize(t: Tables):
    kept = features.binarize(t.listings, "savings_amount", "has_savings", "keep_both")
    return kept.select("vin", "savings_amount", "has_savings")


SEGMENT = """CASE WHEN year < 1996 OR year IS NULL THEN 'clasico_o_muy_viejo'
  WHEN coalesce(salvage, FALSE) OR coalesce(frame_damaged, FALSE) OR coalesce(theft_title, FALSE)
       OR coalesce(has_accidents, FALSE) OR coalesce(mileage, 0) > 200000 THEN 'desguace_o_riesgo'
  WHEN year >= 2024 AND coalesce(mileage, 999999) < 50 THEN 'nuevo_o_seminuevo' ELSE 'estandar' END"""


@query(f"SELECT vin, {SEGMENT} AS segmento_estado, CAST(CASE WHEN year < 1980 THEN 1 ELSE 0 END AS INTEGER) AS is_classic FROM listings")
def condition_segment(t: Tables):
    found = features.add_classic_flag(features.add_condition_segment(t.listings, v.DAMAGE))
    return found.select("vin", "segmento_estado", "is_classic")


# --- text features ----------------------------------------------------------------------

def _number(c: str) -> str:
    pattern = "(\\d+)" if c in v.CYLINDERS else "([0-9]+\\.?[0-9]*)"
    return f"TRY_CAST(regexp_extract({c}, '{pattern}', 1) AS DOUBLE) AS {c}_num"


@query(f"SELECT vin, {', '.join(_number(c) for c in (*v.MEASURES, *v.CYLINDERS))} FROM listings")
def number_extract(t: Tables):
    found = features.extract_numbers(t.listings, v.MEASURES, v.CYLINDERS)
    return found.select("vin", *[f"{c}_num" for c in (*v.MEASURES, *v.CYLINDERS)])


@query("SELECT p_partkey, TRY_CAST(regexp_extract(p_brand, '([0-9]+\\.?[0-9]*)', 1) AS DOUBLE) AS p_brand_num, "
       "TRY_CAST(regexp_extract(p_name, '([0-9]+\\.?[0-9]*)', 1) AS DOUBLE) AS p_name_num FROM part")
def number_extract_part(t: Tables):
    return features.extract_numbers(t.part, ["p_brand", "p_name"]).select("p_partkey", "p_brand_num", "p_name_num")


def _truck(c: str) -> str:
    return (f"CASE WHEN body_type = 'Pickup Truck' AND trim({c}) NOT IN ('', '--', 'NULL', 'None', 'null') "
            f"THEN {c} END AS {c}")


@query("SELECT vin, CAST(CASE WHEN body_type = 'Pickup Truck' THEN 1 ELSE 0 END AS INTEGER) AS is_pickup, "
       f"{', '.join(_truck(c) for c in v.TRUCK_DETAILS)} FROM listings")
def truck_details(t: Tables):
    return features.add_truck_flag(t.listings).select("vin", "is_pickup", *v.TRUCK_DETAILS)


FUEL = ("CASE " + " ".join(f"WHEN contains(lower(fuel_type), '{text}') THEN '{name}'" for text, name in v.FUEL_RULES)
        + " WHEN fuel_type IS NULL THEN 'unknown' ELSE 'other' END")


@query(f"SELECT vin, {FUEL} AS fuel_type_clean FROM listings")
def normalise_labels(t: Tables):
    found = features.normalise_label(t.listings, "fuel_type", "fuel_type_clean", v.FUEL_RULES)
    return found.select("vin", "fuel_type_clean")


@query("SELECT vin, coalesce(CAST(fleet AS VARCHAR), 'unknown') AS fleet, "
       "coalesce(CAST(has_accidents AS VARCHAR), 'unknown') AS has_accidents, "
       "CAST(owner_count IS NULL AS INTEGER) AS owner_count_missing, coalesce(owner_count, 0) AS owner_count, "
       "coalesce(trim_name, 'unknown') AS trim_name, coalesce(body_type, 'unknown') AS body_type, "
       "CAST(is_new AS DOUBLE) AS is_new FROM listings")
def fills(t: Tables):
    found = features.boolean_as_category(t.listings, v.BOOLEAN_CATEGORIES)
    found = features.fill_unknown(features.flag_and_zero(found, "owner_count"), ["trim_name", "body_type", "absent"])
    found = features.boolean_as_double(found, ["is_new"])
    return found.select("vin", "fleet", "has_accidents", "owner_count_missing", "owner_count", "trim_name", "body_type",
                        "is_new")


# --- time and arithmetic ----------------------------------------------------------------

AGE = "CASE WHEN year(listed_date) - year BETWEEN 0 AND 30 THEN CAST(year(listed_date) - year AS DOUBLE) END"


@query(f"SELECT vin, CAST(year(listed_date) AS INTEGER) AS listed_year, CAST(month(listed_date) AS INTEGER) AS listed_month, "
       f"{AGE} AS vehicle_age_at_listing FROM listings")
def temporal_features(t: Tables):
    found = features.add_temporal(t.listings)
    return found.select("vin", "listed_year", "listed_month", "vehicle_age_at_listing")


@query("SELECT o_orderkey, CAST(year(o_orderdate) - 1990 AS INTEGER) AS age FROM orders")
def listing_age(t: Tables):
    dated = t.orders.withColumn("since", F.lit(1990))
    return features.add_listing_age(dated, "o_orderdate", "since", "age").select("o_orderkey", "age")


@query("SELECT vin, CASE WHEN engine_displacement > 0 THEN horsepower / engine_displacement END AS power_density FROM listings")
def ratio_feature(t: Tables):
    found = features.add_ratio(t.listings, "horsepower", "engine_displacement", "power_density")
    return found.select("vin", "power_density")


@query("SELECT vin, CASE WHEN price > 0 THEN round(ln(price), 6) END AS log_price FROM listings")
def log_target(t: Tables):
    return stats.round_doubles(features.log_target(t.listings).select("vin", "log_price"), 6)


# --- imputation -------------------------------------------------------------------------

@query("SELECT vin, CAST(horsepower IS NULL AS INTEGER) AS horsepower_missing, "
       "CAST(mileage IS NULL AS INTEGER) AS mileage_missing, CAST(height IS NULL AND length IS NULL AND width IS NULL "
       "AND wheelbase IS NULL AS INTEGER) AS missing_dimensions FROM listings")
def missing_flags(t: Tables):
    found = impute.add_missing_flags(t.listings, ["horsepower", "mileage", "absent"])
    found = impute.add_all_missing_flag(found, ["height", "length", "width", "wheelbase"], "missing_dimensions")
    return found.select("vin", "horsepower_missing", "mileage_missing", "missing_dimensions")


def _medians(cols, alias: str) -> str:
    return ", ".join(f"quantile_disc({c}, 0.5) AS {alias}_{c}" for c in cols)


_FILLED = ("horsepower", "mileage", "seller_rating", "daysonmarket")


@query(f"""
, g AS (SELECT body_type, is_new, {_medians(_FILLED, 'g')} FROM listings GROUP BY body_type, is_new),
o AS (SELECT {_medians(_FILLED, 'o')} FROM listings)
SELECT vin, {', '.join(f'coalesce({c}, g_{c}, o_{c}) AS {c}' for c in _FILLED)},
       {', '.join(f'CAST({c} IS NULL AS INTEGER) AS {c}_missing' for c in _FILLED)}
FROM listings LEFT JOIN g USING (body_type, is_new), o""")
def group_median_impute(t: Tables):
    fitted = impute.fit_group_medians(t.listings, _FILLED, ["body_type", "is_new", "absent"], ACCURACY)
    found = impute.flag_and_impute(t.listings, fitted)
    return found.select("vin", *_FILLED, *[f"{c}_missing" for c in _FILLED])


@query(f", a AS (SELECT vin, {AGE} AS age FROM listings) SELECT vin, coalesce(age, (SELECT quantile_disc(age, 0.5) FROM a), "
       "5e0) AS vehicle_age_at_listing FROM a")
def global_median_impute(t: Tables):
    found = impute.impute_median(features.add_temporal(t.listings), "vehicle_age_at_listing", 5.0, accuracy=ACCURACY)
    return found.select("vin", "vehicle_age_at_listing")


# --- many centres -----------------------------------------------------------------------

# Places that both engines derive from keys; every order stands for a centre, every customer for a vehicle.
_CENTRES = ("o_orderkey AS id", "25e0 + CAST(o_orderkey * 7919 % 240007 AS DOUBLE) / 1e4 AS latitude",
            "-124e0 + CAST(o_orderkey * 104729 % 580003 AS DOUBLE) / 1e4 AS longitude")
_VEHICLES = ("c_custkey", "CASE WHEN c_custkey % 53 > 0 THEN 25e0 + CAST(c_custkey * 37 % 2400 AS DOUBLE) / 1e2 END AS latitude",
             "-124e0 + CAST(c_custkey * 101 % 5800 AS DOUBLE) / 1e2 AS longitude")
_APART = "pow(sin(radians(c.latitude - v.latitude) / 2), 2) + cos(radians(v.latitude)) * cos(radians(c.latitude)) * pow(sin(radians(c.longitude - v.longitude) / 2), 2)"


@query(f"""
WITH centres AS (SELECT {', '.join(_CENTRES)} FROM orders), vehicles AS (SELECT {', '.join(_VEHICLES)} FROM customer),
best AS (SELECT c_custkey, min(struct_pack(miles := asin(least(1e0, sqrt({_APART}))) * {2 * 3958.8}e0, id := c.id)) AS found
         FROM vehicles AS v, centres AS c WHERE v.latitude IS NOT NULL GROUP BY c_custkey)
SELECT c_custkey, found.id AS nearest, round(found.miles, 6) AS miles FROM vehicles LEFT JOIN best USING (c_custkey)""")
def nearest_centre(t: Tables):
    """The nearest of as many centres as there are orders, for every customer."""
    found = nearest(t.customer.selectExpr(*_VEHICLES), t.orders.selectExpr(*_CENTRES), "c_custkey", "id")
    return found.withColumn("miles", F.round("miles", 6))


# --- sampling ---------------------------------------------------------------------------

def _kept_sql(source: str, key: str, stratum: str, target: int, minimum: int, shown: str = "") -> str:
    return f"""
    base AS (SELECT *, {stratum} AS stratum FROM {source}),
    counts AS (SELECT stratum, count(*) AS n FROM base GROUP BY stratum),
    shares AS (SELECT stratum, least(1e0, greatest({target}e0 / (SELECT sum(n) FROM counts), {minimum}e0 / n)) AS share FROM counts),
    drawn AS (SELECT * FROM base JOIN shares USING (stratum) WHERE {draw_sql(key, 42, 'sample')} < share)
    SELECT {shown or key} FROM drawn WHERE {draw_sql(key, 42, 'thin')} < {target}e0 / (SELECT count(*) FROM drawn)"""


@query("WITH " + _kept_sql("orders", "o_orderkey", "CAST(year(o_orderdate) AS VARCHAR) || '_' || o_orderstatus", 5000, 300))
def stratified_sample(t: Tables):
    stratum = F.concat_ws("_", F.year("o_orderdate").cast("string"), F.col("o_orderstatus"))
    return sample.stratified_sample(t.orders, stratum, ["o_orderkey"], 5000, 300).select("o_orderkey")


_STRATUM = ("CASE WHEN year >= 2019 THEN 'recent' WHEN year >= 2014 THEN 'mid' ELSE 'old' END || '_' || "
            "coalesce(trim(body_type), 'unknown')")


@query(", valid AS (SELECT * FROM listings WHERE year IS NOT NULL AND price IS NOT NULL), " + _kept_sql("valid", "vin", _STRATUM, 20000, 250))
def stratified_listings(t: Tables):
    found = sample.stratified_sample(t.listings, v.age_body_stratum(), ["vin"], 20_000, 250, required=["year", "price"])
    return found.select("vin")


@query(", valid AS (SELECT * FROM listings WHERE year IS NOT NULL AND price IS NOT NULL), subset AS (WITH "
       + _kept_sql("valid", "vin", _STRATUM, 4000, 100, "vin, stratum") + f"""), sides AS (
    SELECT stratum, CASE WHEN {draw_sql('vin', 42, 'split')} < 8e-1 THEN 'train' ELSE 'test' END AS side,
           {draw_sql('vin', 42, 'validation')} < 2e-1 AS is_validation FROM subset)
    SELECT stratum, side, is_validation, count(*) AS n FROM sides GROUP BY ALL""")
def subset_sides(t: Tables):
    """A stratified subset of a larger table, split and written, with the flags for validation: rows of each stratum and side."""
    subset = sample.stratified_sample(t.listings, v.age_body_stratum(), ["vin"], 4_000, 100, required=["year", "price"])
    sides = zip(("train", "test"), sample.split_or_load(t.spark, subset, t.new_path(), t.new_path(), ["vin"]))
    both = [sample.add_validation_flag(side, ["vin"]).select(v.age_body_stratum().alias("stratum"), F.lit(name).alias("side"), "is_validation")
            for name, side in sides]
    return both[0].unionByName(both[1]).groupBy("stratum", "side", "is_validation").agg(F.count(F.lit(1)).alias("n"))


_SIDES = f"SELECT o_orderkey, CASE WHEN {draw_sql('o_orderkey', 42, 'split')} < 8e-1 THEN 'train' ELSE 'test' END AS side FROM orders"


@query(_SIDES)
def written_split(t: Tables):
    """Both sides written once and then read; the second call has no input to split."""
    paths = t.new_path(), t.new_path()
    sample.split_or_load(t.spark, t.orders.select("o_orderkey"), *paths, ["o_orderkey"])
    train, test = sample.split_or_load(t.spark, t.orders.select("o_orderkey").limit(0), *paths, ["o_orderkey"])
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


@query(_SIDES)
def hash_split(t: Tables):
    train, test = sample.split(t.orders, ["o_orderkey"])
    sides = [df.select("o_orderkey", F.lit(name).alias("side")) for df, name in ((train, "train"), (test, "test"))]
    return sides[0].unionByName(sides[1])


@query(f"SELECT vin, {draw_sql('vin', 42, 'validation')} < 2e-1 AS is_validation FROM listings")
def validation_flag(t: Tables):
    return sample.add_validation_flag(t.listings, ["vin"]).select("vin", "is_validation")


@query(f"SELECT vin, {draw_sql('vin', 7)} AS draw FROM listings")
def unit_draws(t: Tables):
    return t.listings.select("vin", unit_draw(["vin"], 7).alias("draw"))


# --- the whole preparation --------------------------------------------------------------

_BLOCKS = [(cols, keys) for cols, keys in v.IMPUTATION_BLOCKS]
_IMPUTED = [c for cols, _ in _BLOCKS for c in cols]
_TERMS = {"has_" + term.replace("/", "_"): term for term in v.OPTION_TERMS}
_CLEAN = "regexp_replace(lower(major_options), '[\\[\\]''\"\\s]', '', 'g')"
_NULL_SAFE = [c for c in ("interior_color", "body_type", "engine_type", "transmission", "trim_name", "wheel_system")]
_PLAIN = ("year", "seller_rating", "engine_displacement", "city_fuel_economy", "highway_fuel_economy", "horsepower",
          "price", "latitude", "longitude", "make_name", "model_name", "city", "exterior_color", "is_new",
          "franchise_dealer", *_NULL_SAFE)


def _group(i: int, cols, keys) -> str:
    return f"g{i} AS (SELECT {', '.join(keys)}, {_medians(cols, 'g')} FROM cleaned GROUP BY {', '.join(keys)})"


_CLEANED = f"""
cleaned AS (SELECT vin, {', '.join(_PLAIN)}, {SEGMENT} AS segmento_estado,
  CAST({HIGH_END} AS INTEGER) AS gama_alta, CAST(CASE WHEN body_type = 'Pickup Truck' THEN 1 ELSE 0 END AS INTEGER) AS is_pickup,
  {FUEL} AS fuel_type_clean, {', '.join(_number(c) for c in (*v.MEASURES, *v.CYLINDERS))}, {AGE} AS vehicle_age_at_listing,
  coalesce(CAST(fleet AS VARCHAR), 'unknown') AS fleet, coalesce(CAST(has_accidents AS VARCHAR), 'unknown') AS has_accidents,
  CAST(owner_count IS NULL AS INTEGER) AS owner_count_missing, coalesce(owner_count, 0) AS owner_count,
  {USAGE} AS mileage, {DAYS} AS daysonmarket, CAST(coalesce(length(description), 0) AS INTEGER) AS description_length,
  CAST(CASE WHEN major_options IS NULL THEN 0 ELSE len(string_split({_CLEAN}, ',')) END AS INTEGER) AS option_count,
  {', '.join(f"CAST(coalesce(contains({_CLEAN}, '{term}'), FALSE) AS INTEGER) AS {name}" for name, term in _TERMS.items())}
  FROM listings, limits),
{', '.join(_group(i, cols, keys) for i, (cols, keys) in enumerate(_BLOCKS))},
o AS (SELECT {_medians(_IMPUTED, 'o')} FROM cleaned),
caps AS (SELECT make_name, quantile_disc(price, 0.99) AS cap FROM cleaned WHERE make_name IN ({_MAKES}) GROUP BY make_name),
kept AS (SELECT * FROM cleaned LEFT JOIN caps USING (make_name) WHERE cap IS NULL OR price <= cap),
age AS (SELECT quantile_disc(vehicle_age_at_listing, 0.5) AS median_age FROM kept)"""

_OUT_OF_MODEL = ("engine_displacement", "city_fuel_economy")
_PASSED = ("vin", "year", "latitude", "longitude", "make_name", "model_name", "city", "exterior_color", "is_new",
           "franchise_dealer", "segmento_estado", "gama_alta", "is_pickup", "fuel_type_clean", "fleet", "has_accidents",
           "owner_count_missing", "owner_count", "daysonmarket", "description_length", "option_count", *_TERMS)
_FILL = {c: f"coalesce({c}, g_{c}, o_{c})" for c in _IMPUTED}

_PREPARED = f"""
SELECT {', '.join(_PASSED)},
  {', '.join(f"coalesce(k.{c}, 'unknown') AS {c}" for c in _NULL_SAFE)},
  {', '.join(f'{e} AS {c}' for c, e in _FILL.items() if c not in _OUT_OF_MODEL)},
  {', '.join(f'CAST({c} IS NULL AS INTEGER) AS {c}_missing' for c in _IMPUTED)},
  CAST(height_num IS NULL AND length_num IS NULL AND width_num IS NULL AND wheelbase_num IS NULL AS INTEGER) AS missing_dimensions,
  CASE WHEN {_FILL['engine_displacement']} > 0 THEN round({_FILL['horsepower']} / {_FILL['engine_displacement']}, 6) END AS power_density,
  coalesce(vehicle_age_at_listing, median_age, 5e0) AS vehicle_age_at_listing,
  CASE WHEN price > 0 THEN round(ln(price), 6) END AS log_price
FROM kept AS k {' '.join(f'LEFT JOIN g{i} USING ({", ".join(keys)})' for i, (_, keys) in enumerate(_BLOCKS))}, o, age
WHERE NOT coalesce(year < 1980, FALSE)"""


@query(f", {THRESHOLDS}, {USAGE_CAP}, {DAYS_CAP}, {_CLEANED} {_PREPARED}")
def prepare_listings(t: Tables):
    found = prepare(t.listings, accuracy=ACCURACY, keep=["vin"])
    return found.withColumns({c: F.round(c, 6) for c in ("power_density", "log_price")})


@query(f", {THRESHOLDS}, {USAGE_CAP}, {DAYS_CAP}, {_CLEANED}, prepared AS ({_PREPARED}) "
       "SELECT trim(coalesce(make_name, '')) AS make, count(*) AS n FROM prepared GROUP BY make")
def cached_listings(t: Tables):
    """Listings from CSV, prepared on the first call and read on the second, which has no input left."""
    raw, copy, final = t.new_path(), t.new_path(), t.new_path()
    listings = t.listings
    listings.write.options(header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                           compression="gzip").csv(raw)
    load_or_prepare(t.spark, raw, copy, final, schema=listings.schema, accuracy=ACCURACY)
    again = load_or_prepare(t.spark, f"{raw}-absent", f"{copy}-absent", final, accuracy=ACCURACY)
    make = F.trim(F.coalesce("make_name", F.lit(""))).alias("make")  # CSV does not tell blanks from nulls
    return again.groupBy(make).agg(F.count(F.lit(1)).alias("n"))


# The same preparation with every limit, median and cap taken from the train side alone.
_TRAIN = f"{draw_sql('vin', 42, 'split')} < 8e-1"
_TRAINED_LIMITS = f"{THRESHOLDS}, {USAGE_CAP}, {DAYS_CAP}".replace("FROM listings", "FROM trained")
_TRAINED = (_CLEANED.replace("FROM cleaned", "FROM learnt").replace("FROM learnt LEFT JOIN caps", "FROM cleaned LEFT JOIN caps")
            .replace("FROM listings, limits),", f"FROM listings, limits),\nlearnt AS (SELECT * FROM cleaned WHERE {_TRAIN}),")
            .replace("FROM kept)", f"FROM kept WHERE {_TRAIN})"))


@query(f", trained AS (SELECT * FROM listings WHERE {_TRAIN}), {_TRAINED_LIMITS}, {_TRAINED}, prepared AS ({_PREPARED}) "
       f"SELECT *, CASE WHEN {_TRAIN} THEN 'train' ELSE 'test' END AS side FROM prepared")
def prepare_without_leakage(t: Tables):
    train, test = sample.split(t.listings, ["vin"])
    sides = prepare_split(train, test, accuracy=ACCURACY, keep=["vin"])
    train, test = (df.withColumn("side", F.lit(name)) for df, name in zip(sides, ("train", "test")))
    return train.unionByName(test).withColumns({c: F.round(c, 6) for c in ("power_density", "log_price")})
