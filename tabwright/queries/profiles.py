"""Queries: column profiles and their recommendation labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwright.operators import features, profile, rank, stats
from tabwright.operators.shape import examples
from tabwright.plans import vehicles as v
from tabwright.queries.registry import blank, case, pct, query, rnd, share_case, skew, union
from tabwright.queries.statistics import segment_sql
from tabwright.queries.tables import ACCURACY, LISTING_COLUMNS, Tables

KINDS = {name: kind for name, (kind, _) in LISTING_COLUMNS.items()}
PLACEHOLDERS = "('null', 'none', '--', 'n/a', 'na')"
NUMBER = "'([0-9]+\\.?[0-9]*)'"
SIGNED = "'(-?\\d+(?:[.,]\\d+)?)'"


def _missing(c: str) -> str:
    if KINDS[c] == "double":
        return f"({c} IS NULL OR isnan({c}))"
    return blank(c) if KINDS[c] == "string" else f"({c} IS NULL)"


@query(union([
    f"SELECT '{c}' AS \"column\", count(*) AS n_total, count(*) FILTER (WHERE {_missing(c)}) AS n_missing, "
    f"round({pct(f'count(*) FILTER (WHERE {_missing(c)})', 'count(*)')}, 6) AS missing_pct FROM listings"
    for c in KINDS]))
def null_profile(t: Tables):
    return stats.round_doubles(profile.null_profile(t.listings), 6)


_NUMERIC = [c for c, kind in KINDS.items() if kind in ("double", "int", "bigint")]


@query(f"""
, r AS ({union([f'''SELECT '{c}' AS "column", round(corr(CAST({c} AS DOUBLE), price), 4) AS corr
                    FROM listings WHERE price IS NOT NULL''' for c in _NUMERIC if c not in ('price', 'sp_id')])})
SELECT *, {case(('corr IS NULL OR isnan(corr)', 'no_data'), ('abs(corr) >= 0.6', 'strong'),
                ('abs(corr) >= 0.3', 'moderate'), ('abs(corr) >= 0.1', 'weak'), otherwise='none')} AS strength FROM r""")
def target_correlation(t: Tables):
    return stats.round_doubles(profile.target_correlation(t.listings, "price", ["sp_id"]), 4)


def _numeric_profile_sql(source: str, cols: list[str]) -> str:
    rows = union([f"""
    SELECT '{c}' AS "column", count(*) AS n_total, count({c}) AS n, CAST(min({c}) AS DOUBLE) AS "min",
           CAST(max({c}) AS DOUBLE) AS "max", round(avg({c}), 3) AS mean, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS median,
           round(stddev({c}), 3) AS stddev, round({skew(f'CAST({c} AS DOUBLE)')}, 3) AS skew,
           round(kurtosis_pop({c}), 3) AS kurt, count(*) FILTER (WHERE {c} = 0) AS zeros FROM {source}""" for c in cols])
    span = '("max" - "min")'
    return f"""
    r AS ({rows}),
    p AS (SELECT *, round({pct('(n_total - n)', 'n_total')}, 3) AS null_pct, round({pct('zeros', 'n_total')}, 3) AS zero_pct
          FROM r)
    SELECT *,
      {share_case('null_pct', 'complete', 'median', 'median_or_model', 'impute_and_flag', 'consider_dropping')} AS imputation,
      {case(('skew IS NULL', 'not_computable'), ('abs(skew) < 0.5', 'symmetric'), ('abs(skew) < 1', 'mild_optional'),
            ('skew > 1', 'log_or_sqrt'), ('skew < -1', 'reflect_and_log'), otherwise='review')} AS transform,
      {case(('kurt IS NULL', 'not_computable'), ('kurt < 0', 'flat'), ('kurt < 3', 'moderate'),
            ('kurt < 7', 'heavy_tails'), otherwise='extreme')} AS outliers,
      {case((f'{span} IS NULL OR stddev IS NULL', 'not_computable'), (f'{span} = 0', 'constant_drop'),
            (f'{span} > 1000 OR stddev > 500', 'standard_or_minmax'), (f'{span} > 100', 'minmax'),
            otherwise='optional')} AS scaling,
      {share_case('zero_pct', 'no_zeros', 'marginal', 'flag_zero', 'flag_required', 'mostly_zero')} AS zero_inflation
    FROM p"""


@query(", " + _numeric_profile_sql("listings", [c for c in _NUMERIC if c not in v.IDENTIFIERS]))
def numeric_profile(t: Tables):
    found = profile.numeric_profile(t.listings, exclude=v.IDENTIFIERS, accuracy=ACCURACY)
    return stats.round_doubles(found, 3)


@query("WITH " + _numeric_profile_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def numeric_profile_lineitem(t: Tables):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return stats.round_doubles(profile.numeric_profile(t.lineitem, cols, accuracy=ACCURACY), 3)


# --- categories -------------------------------------------------------------------------

def _cells(cols, source: str = "listings") -> str:
    parts = [f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS \"value\" FROM {source}" for c in cols]
    return f"cells AS ({union(parts)})"


def _content_sql(cols, source: str = "listings") -> str:
    return f"""
    {_cells(cols, source)}
    SELECT "column", count(*) AS n_total, count(*) FILTER (WHERE "value" IS NULL) AS n_null,
           count(*) FILTER (WHERE trim("value") = '') AS n_empty,
           count(*) FILTER (WHERE trim(lower("value")) IN {PLACEHOLDERS}) AS n_placeholder,
           count(DISTINCT "value") AS n_distinct,
           count(*) FILTER (WHERE regexp_extract("value", {NUMBER}, 1) <> '') AS n_with_number
    FROM cells GROUP BY "column" """


_MISTYPED = ("engine_cylinders", *v.MEASURES)


@query(", " + _content_sql((*_MISTYPED, "interior_color")))
def string_content(t: Tables):
    return profile.string_content(t.listings, (*_MISTYPED, "interior_color"))


@query("WITH " + _content_sql(("props", "event_type"), "events"))
def string_content_events(t: Tables):
    return profile.string_content(t.events, ("props", "event_type"))


@query(f"""
, {_cells(_MISTYPED)},
counts AS (SELECT "column", "value", count(*) AS n, coalesce(regexp_extract("value", {NUMBER}, 1) <> '', FALSE) AS numbered,
                  coalesce(trim("value") <> '' AND trim(lower("value")) NOT IN {PLACEHOLDERS}
                           AND regexp_extract("value", {NUMBER}, 1) = '', FALSE) AS plain
           FROM cells GROUP BY "column", "value"),
kinds AS (SELECT "column", "value", n, 'all' AS kind FROM counts
          UNION ALL SELECT "column", "value", n, 'with_number' FROM counts WHERE numbered
          UNION ALL SELECT "column", "value", n, 'without_number' FROM counts WHERE plain),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "column", kind ORDER BY n DESC, "value" NULLS FIRST) AS r FROM kinds)
SELECT "column", "value", n, kind, CAST(r AS INTEGER) AS rank FROM ranked WHERE r <= 20""")
def string_top_values(t: Tables):
    return profile.string_top_values(t.listings, _MISTYPED, 20)


def _categorical_sql(cols, source: str = "listings") -> str:
    return f"""
    {_cells(cols, source)},
    counts AS (SELECT "column", "value", count(*) AS n FROM cells GROUP BY "column", "value"),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, "value" NULLS FIRST) AS r FROM counts),
    g AS (SELECT "column", CAST(sum(n) AS BIGINT) AS n_total, CAST(coalesce(sum(n) FILTER (WHERE "value" IS NULL), 0) AS BIGINT) AS nulls,
                 count("value") AS "distinct", max("value") FILTER (WHERE r = 1) AS top_value,
                 max(n) FILTER (WHERE r = 1) AS top_count FROM ranked GROUP BY "column"),
    p AS (SELECT *, round({pct('nulls', 'n_total')}, 6) AS null_pct, round({pct('top_count', 'n_total')}, 6) AS top_pct FROM g)
    SELECT *, {share_case('null_pct', 'complete', 'mode', 'mode_and_flag', 'impute_and_flag', 'consider_dropping')} AS imputation,
      {case(('"distinct" <= 2', 'binary'), ('"distinct" <= 10', 'one_hot'), ('"distinct" <= 50', 'one_hot_or_target'),
            ('"distinct" <= 500', 'target_or_frequency'), ('"distinct" <= 5000', 'frequency_group_rare'),
            otherwise='hashing')} AS encoding,
      {case(('top_pct > 95', 'near_constant_drop'), ('top_pct > 80', 'highly_concentrated'), ('top_pct > 50', 'dominant_value'),
            ('"distinct" > 1000', 'group_rare'), otherwise='acceptable')} AS concentration
    FROM p"""


@query(", " + _categorical_sql((*v.CATEGORIES, "sp_name", "main_picture_url")))
def categorical_profile(t: Tables):
    found = profile.categorical_profile(t.listings, (*v.CATEGORIES, "sp_name", "main_picture_url"))
    return stats.round_doubles(found, 6)


@query("WITH " + _categorical_sql(("o_orderstatus", "o_orderpriority", "o_custkey"), "orders"))
def categorical_profile_orders(t: Tables):
    return stats.round_doubles(profile.categorical_profile(t.orders, ("o_orderstatus", "o_orderpriority", "o_custkey")), 6)


@query(f"""
, {_cells(v.FREQUENCY_CATEGORIES)},
counts AS (SELECT "column", "value", count(*) AS n FROM cells GROUP BY "column", "value"),
ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, "value" NULLS FIRST) AS r FROM counts)
SELECT "column", "value", n, CAST(r AS INTEGER) AS rank FROM ranked WHERE r <= 10""")
def category_frequency(t: Tables):
    return profile.category_frequency(t.listings, v.FREQUENCY_CATEGORIES)


# --- booleans and flags -----------------------------------------------------------------

@query(f"""
, r AS ({union([f'''SELECT '{c}' AS "column", count(*) AS n_total, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
                    count(*) FILTER (WHERE {c}) AS trues, count(*) FILTER (WHERE NOT {c}) AS falses FROM listings'''
                for c in v.BOOLEANS])}),
p AS (SELECT *, round({pct('nulls', 'n_total')}, 6) AS null_pct, round({pct('trues', 'n_total')}, 6) AS true_pct,
             round({pct('falses', 'n_total')}, 6) AS false_pct FROM r)
SELECT *, {share_case('null_pct', 'complete', 'mode', 'mode_and_flag', 'impute_and_flag', 'consider_dropping')} AS imputation,
  {case(('least(true_pct, 100 - true_pct) < 1', 'near_constant'), ('least(true_pct, 100 - true_pct) < 5', 'severe'),
        ('least(true_pct, 100 - true_pct) < 20', 'moderate'), otherwise='balanced')} AS balance,
  {case(('null_pct > 50', 'too_many_nulls'), ('true_pct > 98 OR true_pct < 2', 'no_variance'),
        ('true_pct > 80 OR true_pct < 20', 'low_variance'), otherwise='useful')} AS usefulness
FROM p""")
def boolean_profile(t: Tables):
    return stats.round_doubles(profile.boolean_profile(t.listings, (*v.BOOLEANS, "make_name")), 6)


_CLEAN = "regexp_replace(lower(major_options), '[\\[\\]''\"\\s]', '', 'g')"
_FLAGS = {"has_" + term.replace("/", "_"): term for term in v.OPTION_TERMS}
OPTION_SQL = f"""
options AS (SELECT vin, price, coalesce(length(description), 0) AS description_length,
            CASE WHEN major_options IS NULL THEN 0 ELSE len(string_split({_CLEAN}, ',')) END AS option_count,
            {', '.join(f"CAST(coalesce(contains({_CLEAN}, '{term}'), FALSE) AS INTEGER) AS {name}" for name, term in _FLAGS.items())}
     FROM listings)"""


@query(f""", {OPTION_SQL}
SELECT vin, CAST(description_length AS INTEGER) AS description_length, CAST(option_count AS INTEGER) AS option_count,
       {', '.join(_FLAGS)} FROM options""")
def option_features(t: Tables):
    found = features.add_option_features(t.listings, v.OPTION_TERMS)
    return found.select("vin", "description_length", "option_count", *_FLAGS)


@query(f""", {OPTION_SQL}
{union([f'''SELECT '{c}' AS "column", count(*) AS n_total, count(*) FILTER (WHERE {c} = 1) AS n_set,
        round({pct(f'count(*) FILTER (WHERE {c} = 1)', 'count(*)')}, 6) AS set_pct FROM options''' for c in _FLAGS])}""")
def flag_frequency(t: Tables):
    found = features.add_option_features(t.listings, v.OPTION_TERMS)
    return stats.round_doubles(profile.flag_frequency(found, profile.flag_columns(found)), 6)


@query(f""", {OPTION_SQL}, levels AS ({union([f"SELECT price, '{c}' AS flag, {c} AS level FROM options" for c in _FLAGS])})
{segment_sql('levels', 'price', 'flag, level', 'price', 'price > 0', 30)}""")
def flag_impact(t: Tables):
    found = features.add_option_features(t.listings, v.OPTION_TERMS)
    return profile.flag_impact(found, profile.flag_columns(found), "price", accuracy=ACCURACY)


@query(f""", {OPTION_SQL}, counted AS (SELECT price, CAST(option_count AS INTEGER) AS option_count FROM options)
{segment_sql('counted', 'price', 'option_count', 'price', 'price > 0', 30)}""")
def option_count_impact(t: Tables):
    found = features.add_option_features(t.listings, v.OPTION_TERMS)
    return stats.segment_stats(found, "price", ["option_count"], True, 30, "price", accuracy=ACCURACY)


_TYPE = {"string": "string", "double": "double", "int": "int", "boolean": "boolean"}


def _group_row(group: str, c: str) -> str:
    kind = KINDS[c]
    zero = f"NOT {c}" if kind == "boolean" else f"TRY_CAST({c} AS DOUBLE) = 0"
    return (f"SELECT '{c}' AS \"column\", '{group}' AS \"group\", '{_TYPE[kind]}' AS \"type\", count(*) AS n_total, "
            f"count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) FILTER (WHERE {zero}) AS zeros FROM listings")


@query(f"""
, r AS ({union([_group_row(g, c) for g, cols in v.FUNCTIONAL_GROUPS.items() for c in cols if c in KINDS])}),
p AS (SELECT *, {pct('nulls', 'n_total')} AS np, {pct('zeros', 'n_total')} AS zp FROM r),
g AS (SELECT *, avg(np) OVER (PARTITION BY "group") AS gp FROM p)
SELECT "column", "group", "type", n_total, nulls, zeros, round(np, 6) AS null_pct, round(zp, 6) AS zero_pct,
       round(gp, 6) AS group_null_pct, {case(('gp < 5', 'solid'), ('gp < 20', 'acceptable'), otherwise='critical')} AS health
FROM g""")
def functional_groups(t: Tables):
    return stats.round_doubles(profile.group_health(t.listings, v.FUNCTIONAL_GROUPS), 6)


# --- text -------------------------------------------------------------------------------

def _text_sql(cells: str) -> str:
    return f"""
    {cells},
    sized AS (SELECT *, CASE WHEN {blank('"value"')} THEN NULL ELSE length(trim("value")) END AS size FROM cells),
    r AS (SELECT "column", count(*) AS n_total, count(*) FILTER (WHERE {blank('"value"')}) AS blanks,
                 count(*) FILTER (WHERE "value" IS NULL) AS nulls, CAST(coalesce(min(size), 0) AS INTEGER) AS min_length,
                 round(coalesce(avg(size), 0), 6) AS mean_length,
                 CAST(coalesce(quantile_disc(size, 0.5), 0) AS INTEGER) AS median_length,
                 CAST(coalesce(max(size), 0) AS INTEGER) AS max_length FROM sized GROUP BY "column"),
    p AS (SELECT *, round({pct('blanks', 'n_total')}, 6) AS blank_pct FROM r)
    SELECT *, {share_case('blank_pct', 'complete', 'placeholder', 'impute_and_flag', 'flag_required', 'consider_dropping')} AS imputation,
      {case(('mean_length = 0', 'drop'), ('mean_length < 10', 'categorical'), ('mean_length < 50', 'keywords'),
            ('mean_length < 200', 'tf_idf'), otherwise='embeddings')} AS feature,
      {case(('mean_length = 0', 'no_content'), ('max_length = min_length', 'constant_length'),
            ('max_length - min_length > mean_length * 10', 'wide_spread'), otherwise='consistent')} AS quality
    FROM p"""


@query(", " + _text_sql(_cells(v.TEXTS)))
def text_profile(t: Tables):
    return stats.round_doubles(profile.text_profile(t.listings, v.TEXTS, ACCURACY), 6)


@query("WITH " + _text_sql(_cells(("text", "lang", "source"), "documents")))
def text_profile_documents(t: Tables):
    return stats.round_doubles(profile.text_profile(t.documents, ("text", "lang", "source"), ACCURACY), 6)


@query("WITH " + _text_sql(_cells(("text", "role"), "conversations")))
def text_profile_conversations(t: Tables):
    return stats.round_doubles(profile.text_profile(t.conversations, ("text", "role"), ACCURACY), 6)


@query(union([f"""SELECT '{c}' AS "column", "value" FROM (SELECT trim({c}) AS "value" FROM documents
                  WHERE NOT {blank(c)} ORDER BY doc_id LIMIT 3) AS x""" for c in ("text", "lang")]))
def text_examples(t: Tables):
    return examples(t.documents, ["text", "lang"], ["doc_id"])


def _mistyped_sql(cells: str) -> str:
    return f"""
    {cells},
    m AS (SELECT "column", trim(coalesce("value", '')) AS x, regexp_extract(trim(coalesce("value", '')), {SIGNED}, 1) <> '' AS num
          FROM cells),
    r AS (SELECT "column", count(*) AS n_total, count(*) FILTER (WHERE x = '') AS blanks,
                 count(*) FILTER (WHERE num) AS with_number, count(*) FILTER (WHERE x <> '' AND NOT num) AS without_number
          FROM m GROUP BY "column"),
    p AS (SELECT *, round({pct('blanks', 'n_total')}, 6) AS blanks_pct, round({pct('with_number', 'n_total')}, 6) AS with_number_pct,
                 round({pct('without_number', 'n_total')}, 6) AS without_number_pct,
                 {pct('(blanks + without_number)', 'n_total')} AS problem FROM r)
    SELECT * EXCLUDE (problem),
      {case(('with_number_pct >= 95', 'extract'), ('with_number_pct >= 80', 'extract_and_flag'),
            ('with_number_pct >= 50', 'partial'), otherwise='not_extractable')} AS extractability,
      {share_case('problem', 'complete', 'median', 'median_and_flag', 'median_flag_required', 'consider_dropping')} AS imputation,
      {case(('with_number_pct >= 80', 'use_as_number'), ('with_number_pct >= 50', 'use_with_flag'), otherwise='low_value')} AS usefulness
    FROM p"""


@query(", " + _mistyped_sql(_cells(_MISTYPED)))
def mistyped_profile(t: Tables):
    return stats.round_doubles(profile.mistyped_profile(t.listings, _MISTYPED), 6)


@query("WITH " + _mistyped_sql(_cells(("p_brand", "p_name", "p_type"), "part")))
def mistyped_profile_part(t: Tables):
    return stats.round_doubles(profile.mistyped_profile(t.part, ("p_brand", "p_name", "p_type")), 6)


@query(", x AS (" + union([f"""SELECT '{c}' AS "column", "value" FROM (SELECT trim({c}) AS "value" FROM listings
        WHERE NOT {blank(c)} ORDER BY vin LIMIT 3) AS x""" for c in ("power", "height", "torque")]) + f""")
SELECT "column", "value", nullif(regexp_extract("value", {SIGNED}, 1), '') AS extracted FROM x""")
def extraction_examples(t: Tables):
    return profile.extraction_examples(examples(t.listings, ["power", "height", "torque"], ["vin"]))


# --- identifiers and redundancy ---------------------------------------------------------

def _identifier_sql(cells: str) -> str:
    return f"""
    {cells},
    counts AS (SELECT "column", "value", count(*) AS n FROM cells GROUP BY "column", "value"),
    r AS (SELECT "column", CAST(sum(n) AS BIGINT) AS n_total,
                 CAST(coalesce(sum(n) FILTER (WHERE {blank('"value"')}), 0) AS BIGINT) AS blanks, count(*) AS "distinct",
                 count(*) FILTER (WHERE n > 1 AND NOT {blank('"value"')}) AS duplicated_values FROM counts GROUP BY "column"),
    p AS (SELECT *, round({pct('blanks', 'n_total')}, 6) AS null_pct, round({pct('"distinct"', 'n_total')}, 6) AS unique_pct FROM r)
    SELECT *, {case(('unique_pct >= 99', 'drop'), ('unique_pct >= 20', 'review'), otherwise='group_or_review')} AS action FROM p"""


@query(", " + _identifier_sql(_cells(v.IDENTIFIERS)))
def identifier_profile(t: Tables):
    return stats.round_doubles(profile.identifier_profile(t.listings, v.IDENTIFIERS), 6)


@query("WITH " + _identifier_sql(_cells(("o_orderkey", "o_custkey", "o_orderstatus"), "orders")))
def identifier_profile_orders(t: Tables):
    return stats.round_doubles(profile.identifier_profile(t.orders, ("o_orderkey", "o_custkey", "o_orderstatus")), 6)


@query("""SELECT unnest(['is_new', 'price', 'nowhere']) AS "column", unnest(['profiled', 'not_boolean', 'absent']) AS status""")
def column_status(t: Tables):
    """What a profile leaves out, and why."""
    return profile.column_status(t.listings, ["is_new", "price", "nowhere"], "boolean")


# Text columns of the listings that share a word, written out: the query finds them by itself.
_PAIRS = (
    ("back_legroom", "front_legroom"), ("bed", "bed_height"), ("bed", "bed_length"), ("bed_height", "bed_length"), ("bed_height", "height"),
    ("bed_length", "length"), ("body_type", "engine_type"), ("body_type", "fuel_type"), ("engine_cylinders", "engine_type"), ("engine_type", "fuel_type"),
    ("exterior_color", "interior_color"), ("exterior_color", "listing_color"), ("franchise_make", "make_name"), ("fuel_tank_volume", "fuel_type"),
    ("interior_color", "listing_color"), ("make_name", "model_name"), ("make_name", "sp_name"), ("make_name", "trim_name"), ("model_name", "sp_name"),
    ("model_name", "trim_name"), ("sp_name", "trim_name"), ("transmission", "transmission_display"), ("transmission_display", "wheel_system_display"),
    ("wheel_system", "wheel_system_display"),
)


def _pair_row(a: str, b: str) -> str:
    x, y = (f"trim(lower(coalesce({c}, '')))" for c in (a, b))
    both = f"{x} <> '' AND {y} <> ''"
    return (f"SELECT '{a}' AS column_1, '{b}' AS column_2, count(*) FILTER (WHERE {both}) AS comparable, "
            f"count(*) FILTER (WHERE {both} AND {x} = {y}) AS equal, "
            f"count(DISTINCT nullif({x}, '')) AS distinct_1, count(DISTINCT nullif({y}, '')) AS distinct_2 FROM listings")


@query(f"""
, r AS ({union([_pair_row(a, b) for a, b in _PAIRS])}),
p AS (SELECT *, CASE WHEN comparable > 0 THEN {pct('equal', 'comparable')} ELSE 0e0 END AS mp,
             CASE WHEN greatest(distinct_1, distinct_2) > 0
                  THEN CAST(least(distinct_1, distinct_2) AS DOUBLE) / greatest(distinct_1, distinct_2) ELSE 0e0 END AS dr FROM r),
l AS (SELECT *, {case(('mp >= 95 AND dr >= 0.90', 'high'), ('mp >= 70', 'possible'), ('mp >= 20', 'partial'), otherwise='none')} AS relation
      FROM p)
SELECT column_1, column_2, comparable, equal, distinct_1, distinct_2, round(mp, 6) AS match_pct,
       round(dr, 6) AS distinct_ratio, relation,
       {case(("relation = 'high'", 'drop_one'), ("relation = 'possible'", 'review'), ("relation = 'partial'", 'analyse'),
             otherwise='keep')} AS action FROM l""")
def redundant_pairs(t: Tables):
    texts = [c for c, kind in t.listings.dtypes if kind == "string"]
    return stats.round_doubles(profile.redundant_pairs(t.listings, profile.redundant_pairs_by_name(texts)), 6)


# --- geography and time -----------------------------------------------------------------



def _place(p: str) -> str:
    fill = case((f"null_{p}_pct < 10", "complete"), (f"null_{p}_pct < 30", "good"), otherwise="incomplete")
    size = case((f"{p}_distinct <= 100", "low"), (f"{p}_distinct <= 5000", "high"), otherwise="very_high")
    action = case((f"null_{p}_pct < 30 AND {p}_distinct <= 100", "one_hot"),
                  (f"null_{p}_pct < 30 AND {p}_distinct <= 5000", "target_or_frequency"),
                  (f"null_{p}_pct < 60", "group_and_frequency"), otherwise="presence_flag")
    features = case((f"null_{p}_pct < 30 AND {p}_distinct <= 100", f"{p}_one_hot, region"),
                    (f"null_{p}_pct < 30 AND {p}_distinct <= 5000", f"{p}_frequency, urban_level"),
                    (f"null_{p}_pct < 60", f"{p}_hash, region"), otherwise=f"has_{p}")
    return f"({fill}) || '_' || ({size}) AS {p}_quality, {action} AS {p}_action, {features} AS {p}_features"


@query(f"""
, r AS (SELECT count(*) AS n_total, count(*) FILTER (WHERE latitude IS NULL) AS null_lat,
               count(*) FILTER (WHERE longitude IS NULL) AS null_lon, count(*) FILTER (WHERE {blank('city')}) AS null_city,
               count(*) FILTER (WHERE {blank('dealer_zip')}) AS null_postcode,
               count(*) FILTER (WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) AS valid,
               count(*) FILTER (WHERE latitude = 0 AND longitude = 0) AS null_island,
               count(*) FILTER (WHERE latitude = 0 AND longitude <> 0) AS lat_zero,
               count(*) FILTER (WHERE latitude <> 0 AND longitude = 0) AS lon_zero,
               count(DISTINCT city) FILTER (WHERE NOT {blank('city')}) AS city_distinct,
               count(DISTINCT dealer_zip) FILTER (WHERE NOT {blank('dealer_zip')}) AS postcode_distinct FROM listings),
p AS (SELECT *, {', '.join(f"round({pct(c, 'n_total')}, 6) AS {c}_pct" for c in
                           ('null_lat', 'null_lon', 'null_city', 'null_postcode', 'valid', 'null_island'))} FROM r),
q AS (SELECT *, {case(('valid_pct >= 95 AND null_island_pct < 0.5', 'excellent'), ('valid_pct >= 80', 'good'),
                      ('valid_pct >= 50', 'acceptable'), otherwise='poor')} AS coordinate_quality FROM p)
SELECT *, {case(("coordinate_quality = 'excellent'", 'use_directly'), ("coordinate_quality = 'good'", 'clean_anomalies'),
                ("coordinate_quality = 'acceptable'", 'impute_nulls'), otherwise='do_not_use')} AS coordinate_action,
       {case(("coordinate_quality = 'excellent'", 'geohash_6_8, urban_distance, clusters'), ("coordinate_quality = 'good'", 'geohash_5_6, region, clusters'),
             ("coordinate_quality = 'acceptable'", 'region, has_coordinates'), otherwise='from_city_or_postcode')} AS coordinate_features,
       {case(('valid_pct >= 80', 'coordinates_first'), ('null_city_pct < 30', 'places_first'),
             otherwise='enrichment_needed')} AS strategy, {_place('city')}, {_place('postcode')} FROM q""")
def geo_quality(t: Tables):
    return stats.round_doubles(profile.geo_quality(t.listings), 6)


@query(f"""
, r AS (SELECT count(*) AS n_total, count(*) FILTER (WHERE listed_date IS NULL) AS null_date,
    count(*) FILTER (WHERE year IS NULL) AS null_year, count(*) FILTER (WHERE daysonmarket IS NULL) AS null_days,
    CAST(min(listed_date) AS VARCHAR) AS min_date, CAST(max(listed_date) AS VARCHAR) AS max_date,
    CAST(min(year) AS BIGINT) AS min_year, CAST(max(year) AS BIGINT) AS max_year, round(avg(year), 6) AS mean_year,
    CAST(min(daysonmarket) AS BIGINT) AS min_days, CAST(max(daysonmarket) AS BIGINT) AS max_days,
    round(avg(daysonmarket), 6) AS mean_days, count(*) FILTER (WHERE year < 1900 OR year > 2100) AS invalid_year,
    count(*) FILTER (WHERE daysonmarket < 0) AS negative_days,
    count(DISTINCT year(listed_date)) AS distinct_years, count(DISTINCT month(listed_date)) AS distinct_months FROM listings),
p AS (SELECT *, {', '.join(f"round({pct(c, 'n_total')}, 6) AS {c}_pct" for c in ('null_date', 'null_year', 'null_days'))} FROM r)
SELECT *, {case(('null_date_pct < 20', 'keep_and_derive'), ('null_date_pct < 50', 'keep_with_caution'), otherwise='limited_use')} AS date_action,
  {case(('null_year_pct < 20 AND invalid_year = 0', 'keep'), ('null_year_pct < 40', 'keep_with_review'), otherwise='review_or_drop')} AS year_action,
  {case(('null_days_pct < 20 AND negative_days = 0', 'keep'), ('null_days_pct < 40', 'keep_with_review'), otherwise='limited_use')} AS days_action,
  {case(('null_date_pct < 20 AND null_year_pct < 20', 'keep_all'), ('null_date_pct < 40 OR null_year_pct < 40', 'keep_partly'),
        otherwise='review')} AS strategy, 'listed_year, listed_month, listed_quarter, listed_weekday' AS date_features,
  'vehicle_age_at_listing' AS year_features, 'fast_turnover, slow_turnover' AS days_features FROM p""")
def temporal_profile(t: Tables):
    return stats.round_doubles(profile.temporal_profile(t.listings), 6)


@query("""
, cells AS (SELECT 'model_year' AS distribution, year AS bucket FROM listings
            UNION ALL SELECT 'listed_year', year(listed_date) FROM listings
            UNION ALL SELECT 'listed_month', month(listed_date) FROM listings),
counts AS (SELECT distribution, bucket, count(*) AS n FROM cells WHERE bucket IS NOT NULL GROUP BY distribution, bucket),
ranked AS (SELECT *, row_number() OVER (PARTITION BY distribution ORDER BY
             CASE distribution WHEN 'model_year' THEN -n WHEN 'listed_year' THEN -bucket ELSE bucket END, bucket) AS r FROM counts)
SELECT distribution, CAST(bucket AS INTEGER) AS bucket, n, CAST(r AS INTEGER) AS rank FROM ranked
WHERE r <= CASE WHEN distribution = 'listed_month' THEN 12 ELSE 10 END""")
def temporal_distribution(t: Tables):
    return profile.temporal_distribution(t.listings)


@query("""
SELECT CAST(listed_date AS VARCHAR) AS listed_date, year, daysonmarket FROM listings
WHERE listed_date IS NOT NULL AND year IS NOT NULL AND daysonmarket IS NOT NULL ORDER BY vin LIMIT 10""")
def temporal_examples(t: Tables):
    found = profile.temporal_examples(t.listings, ["vin"], n=10)
    return found.withColumn("listed_date", F.col("listed_date").cast("string"))


def _summary_sql() -> str:
    facts = [f"SELECT 'size' AS section, 'columns' AS item, {len(KINDS)}e0 AS \"value\"",
             "SELECT 'size', 'rows', CAST(count(*) AS DOUBLE) FROM listings"]
    names = {"int": "int", "bigint": "bigint", "double": "double", "string": "string", "boolean": "boolean", "date": "date"}
    for kind in dict.fromkeys(KINDS.values()):
        facts.append(f"SELECT 'type', '{names[kind]}', {sum(k == kind for k in KINDS.values())}e0")
    for i, (c, kind) in enumerate(KINDS.items()):
        facts.append(f"SELECT 'missing', '{c}', x FROM (SELECT CAST(count(*) FILTER (WHERE {_missing(c)}) AS DOUBLE) AS x "
                     f"FROM listings) AS m WHERE x > 0")
        if kind == "string":
            facts.append(f"SELECT 'categorical', '{c}', {i}e0")
        elif c in _NUMERIC and c != "price":
            facts.append(f"SELECT 'feature', '{c}', {i}e0")
    for item, agg in (("min", "min(price)"), ("max", "max(price)"), ("mean", "round(avg(price), 4)"),
                      ("median", "quantile_disc(price, 0.5)"), ("skew", f"round({skew('price')}, 4)")):
        facts.append(f"SELECT 'target', '{item}', {agg} FROM listings")
    return union(facts)


@query(_summary_sql())
def dataset_summary(t: Tables):
    return stats.round_doubles(profile.dataset_summary(t.listings, "price", ACCURACY), 4)


@query(f"SELECT {', '.join(c for c in v.PREVIEW)} FROM listings ORDER BY vin LIMIT 20")
def preview(t: Tables):
    return rank.preview(t.listings.orderBy("vin"), v.PREVIEW, 20)


@query("""
SELECT stratum, count(*) AS n FROM (
  SELECT CASE WHEN year >= 2019 THEN 'recent' WHEN year >= 2014 THEN 'mid' ELSE 'old' END || '_' ||
         coalesce(trim(body_type), 'unknown') AS stratum FROM listings) AS s GROUP BY stratum""")
def stratum_counts(t: Tables):
    from tabwright.operators.sample import stratum_counts as count_strata

    return count_strata(t.listings, v.age_body_stratum())
