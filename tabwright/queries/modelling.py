"""Queries: model pipelines, search, scoring and error reports.

Fits are checked where they have a closed form: a line through one number, means of groups.
Everything computed from predictions is checked on a prediction column that both engines can
derive. The whole selection has no SQL equivalent and is registered without one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions import labels
from tabwright.functions.predicates import present
from tabwright.models import coefficients, evaluate, pipelines, search
from tabwright.operators import features, stats
from tabwright.plans import modelling
from tabwright.plans import vehicles as v
from tabwright.plans.prepare import prepare
from tabwright.queries.preparation import _CLEANED, _PREPARED, DAYS_CAP, THRESHOLDS, USAGE_CAP
from tabwright.queries.registry import query, rnd, union
from tabwright.queries.statistics import draw_sql
from tabwright.queries.tables import ACCURACY, Tables
from tabwright.sources.staging import stage

KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
KEY_SQL = " || '|' || ".join(KEY)
LABEL = "log_price"
_TRUE_PRICE = "ln(floor(l_extendedprice))"


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.withColumn(LABEL, F.log("l_extendedprice"))


def _small(validation: str | None = None, **options) -> dict[str, pipelines.Candidate]:
    """Candidates without penalty or ensemble, whose fits have a closed form."""
    plain = {"linear": {"regParam": 0.0, "elasticNetParam": 0.0}, "boosted": {"maxIter": 1, "maxDepth": 1},
             "forest": {"numTrees": 1, "maxDepth": 1, "bootstrap": False}}
    return pipelines.candidates(options.pop("categories", []), options.pop("numbers", ["l_quantity"]), options.pop("label", LABEL),
                                validation=validation, **plain | options)


# --- fits -------------------------------------------------------------------------------
# Checked where a fit has a closed form: a line through one number, means of groups.

_SLOPE = "regr_slope(ln(l_extendedprice), l_quantity)"


@query("""
SELECT round(regr_slope(l_extendedprice, l_quantity) * stddev_samp(l_quantity), 3) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""")
def least_squares(t: Tables):
    """The linear candidate without penalty; the slope is that of the standardised number."""
    lines = t.lineitem.select("l_quantity", "l_extendedprice")
    model = _small(label="l_extendedprice", with_mean=False)["linear"].pipeline.fit(lines)
    fitted = model.stages[-1]
    r2 = evaluate.regression_metrics(model.transform(lines), "l_extendedprice").select(F.round("r2", 6).alias("r2"))
    return r2.select(F.round(F.lit(float(fitted.coefficients[0])), 3).alias("slope"),
                     F.round(F.lit(float(fitted.intercept)), 3).alias("intercept"), "r2")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(avg(ln(l_extendedprice)) OVER (PARTITION BY l_returnflag), 4) "
       "AS prediction FROM lineitem")
def elastic_net(t: Tables):
    """The linear candidate without penalty on one-hot columns alone predicts group means."""
    lines = _lines(t)
    model = _small(categories=["l_returnflag"], numbers=[])["linear"].pipeline.fit(lines)
    return model.transform(lines).select(*KEY, F.round("prediction", 4).alias("prediction"))


_HALVES = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    round(avg(ln(l_extendedprice)) OVER (PARTITION BY l_quantity > 25), 6) AS prediction FROM lineitem"""


def _halves(t: Tables, name: str) -> DataFrame:
    lines = _lines(t).withColumn("many", (F.col("l_quantity") > 25).cast("double"))
    model = _small(numbers=["many"])[name].pipeline.fit(lines)
    return model.transform(lines).select(*KEY, F.round("prediction", 6).alias("prediction"))


@query(_HALVES)
def boosted_trees(t: Tables):
    """One round of depth one on a 0/1 column predicts the mean of each half."""
    return _halves(t, "boosted")


@query(_HALVES)
def reloaded_model(t: Tables):
    """A fitted pipeline, saved, loaded and applied."""
    lines, path = _lines(t).withColumn("many", (F.col("l_quantity") > 25).cast("double")), t.new_path()
    _small(numbers=["many"])["boosted"].pipeline.fit(lines).write().overwrite().save(path)
    return PipelineModel.load(path).transform(lines).select(*KEY, F.round("prediction", 6).alias("prediction"))


@query(_HALVES)
def random_forest(t: Tables):
    """One tree of depth one, without bootstrap, on a 0/1 column predicts the mean of each half."""
    return _halves(t, "forest")


@query("""
SELECT l_shipdate_month AS label, row_number() OVER (ORDER BY count(*) DESC, l_shipdate_month) - 1 AS place
FROM (SELECT CAST(month(l_shipdate) AS VARCHAR) AS l_shipdate_month FROM lineitem) AS m GROUP BY l_shipdate_month""")
def index_order(t: Tables):
    """Categories are numbered by how frequent they are, and then by name."""
    months = t.lineitem.select(F.month("l_shipdate").cast("string").alias("month"))
    model = Pipeline(stages=pipelines.encoding_stages(["month"], [])[:1]).fit(months)
    labels = model.stages[0].labelsArray[0]
    return t.spark.createDataFrame([(label, i) for i, label in enumerate(labels)], "label string, place long")


# Prices hardly depend on quantities, so that penalties score alike; without an intercept a line is far off at any size.
_SETTINGS = {"regParam": [0.0], "elasticNetParam": [0.0], "fitIntercept": [False, True]}


def _winner(model, scores: DataFrame) -> DataFrame:
    """The score of the setting with which the model that a search returns was fitted, and its penalty."""
    best = search.best_params(model, sorted(_SETTINGS))
    whole, penalty = (", ".join(f"{name}={best[name]}" for name in names) for names in (best, ["elasticNetParam", "regParam"]))
    return stats.round_doubles(scores.where(F.col("params") == whole).withColumn("params", F.lit(penalty)), 6)


def _drawn(purpose: str) -> str:
    return f"(SELECT ln(l_extendedprice) AS y, l_quantity AS x, {draw_sql(KEY_SQL, 42, purpose)} AS draw FROM lineitem)"


@query(f"""
WITH sides AS {_drawn('search')}, line AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM sides WHERE draw < 8e-1)
SELECT 'elasticNetParam=0.0, regParam=0.0' AS params, round(sqrt(avg(pow(y - a * x - b, 2))), 6) AS rmse_val
FROM sides, line WHERE draw >= 8e-1""")
def split_search(t: Tables):
    """The winner of a search over several settings, by the model it leaves, and its score."""
    candidate = _small()["linear"]
    grid = search.param_grid(candidate, _SETTINGS)
    model = search.search_split(candidate.pipeline, grid, _lines(t), LABEL, KEY)
    return _winner(model, search.results(t.spark, grid, model.validationMetrics))


@query("""
SELECT 'elasticNetParam=' || net || ', regParam=' || reg AS params
FROM (SELECT unnest(['0.7', '0.9', '1.0']) AS net) AS n, (SELECT unnest(['0.0002', '0.0005', '0.001', '0.002', '0.005']) AS reg) AS r""")
def refined_search(t: Tables):
    """The second round's settings around the first round's winner, as scored; the weak penalty wins by far, as without an intercept."""
    linear = {"regParam": 0.0, "elasticNetParam": 0.0, "fitIntercept": False}
    candidate, lines = _small(with_mean=False, linear=linear)["linear"], _lines(t)
    first = search.search_split(
        candidate.pipeline, search.param_grid(candidate, {"regParam": [0.001, 100.0], "elasticNetParam": [1.0]}), lines, LABEL, KEY)
    grid = search.param_grid(candidate, search.refined_grid("linear", first))
    second = search.search_split(candidate.pipeline, grid, lines, LABEL, KEY, parallelism=4)
    return search.results(t.spark, grid, second.validationMetrics).select("params")


@query(f"""
WITH sides AS (SELECT *, CAST(floor(draw * 3) AS INTEGER) AS fold FROM {_drawn('fold')} AS d), folds AS (SELECT unnest([0, 1, 2]) AS f),
lines AS (SELECT f, regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM sides, folds WHERE fold <> f GROUP BY f),
scores AS (SELECT f, sqrt(avg(pow(y - a * x - b, 2))) AS rmse FROM sides, lines WHERE fold = f GROUP BY f)
SELECT 'elasticNetParam=0.0, regParam=0.0' AS params, round(avg(rmse), 6) AS rmse_cv FROM scores""")
def fold_search(t: Tables):
    """As ``split_search``, over three folds."""
    candidate = _small()["linear"]
    grid = search.param_grid(candidate, _SETTINGS)
    model = search.search_folds(candidate.pipeline, grid, _lines(t), LABEL, KEY, folds=3)
    return _winner(model, search.results(t.spark, grid, model.avgMetrics, "rmse_cv"))


@query(f"""SELECT 'l_quantity' AS feature, round({_SLOPE} * stddev_samp(l_quantity), 6) AS coef,
           round(abs({_SLOPE} * stddev_samp(l_quantity)), 6) AS abs_coef FROM lineitem""")
def coefficient_table(t: Tables):
    lines = _lines(t)
    return stats.round_doubles(coefficients.coefficients(_small()["linear"].pipeline.fit(lines), lines), 6)


@query("""
SELECT r_name AS "group", count(*) AS n_coef, count(*) FILTER (WHERE coef = 0) AS n_zero, count(*) FILTER (WHERE coef <> 0) AS n_nonzero,
       max(abs(coef)) AS max_abs_coef, count(*) FILTER (WHERE coef = 0) * 100e0 / count(*) AS pct_zero
FROM (SELECT r_name, CAST(n_nationkey % 4 AS DOUBLE) - 1e0 AS coef FROM nation JOIN region ON n_regionkey = r_regionkey) AS c GROUP BY r_name
UNION ALL SELECT n_name, 1, 0, 1, 2e0, 0e0 FROM nation""")
def coefficient_groups(t: Tables):
    """Groups of a table of coefficients that both engines can derive."""
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    encoded = nation.select(F.concat_ws("_ohe_", "r_name", "n_name").alias("feature"), ((F.col("n_nationkey") % 4).cast("double") - 1).alias("coef"))
    plain = t.nation.select(F.col("n_name").alias("feature"), F.lit(-2.0).alias("coef"))
    table = encoded.unionByName(plain).withColumn("abs_coef", F.abs("coef"))
    return coefficients.coefficient_groups(table)


@query(f"""
WITH s AS (SELECT l_returnflag, {_TRUE_PRICE} AS y, l_quantity AS x FROM lineitem), m AS (
  SELECT l_returnflag, 1 - avg(pow(2e-3 * (x - 25e0), 2)) / var_pop(y) AS near, 1 - avg(pow(3e-2 * (x - 25e0), 2)) / var_pop(y) AS far FROM s GROUP BY l_returnflag)
SELECT l_returnflag, CASE WHEN abs(near - far) > 0.05 THEN 'possible_overfit' ELSE 'ok' END AS label,
       CASE WHEN abs(near - near) > 0.05 THEN 'possible_overfit' ELSE 'ok' END AS same FROM m""")
def overfit_labels(t: Tables):
    """Labels from the R2 of two fixed prediction columns, per group."""
    y = F.log(F.floor("l_extendedprice").cast("double"))

    def r2(slope: float) -> Column:
        return 1 - F.avg(F.pow(F.lit(slope) * (F.col("l_quantity") - 25), F.lit(2))) / F.var_pop(y)

    scores = t.lineitem.groupBy("l_returnflag").agg(r2(0.002).alias("near"), r2(0.03).alias("far"))
    return scores.select("l_returnflag", labels.overfit(F.col("near"), F.col("far")).alias("label"),
                         labels.overfit(F.col("near"), F.col("near")).alias("same"))


@query(f", {THRESHOLDS}, {USAGE_CAP}, {DAYS_CAP}, {_CLEANED}, prepared AS ({_PREPARED}) "
       "SELECT make_name, count(*) AS n, count(*) AS n_scored FROM prepared WHERE log_price IS NOT NULL GROUP BY make_name")
def scored_rows(t: Tables):
    """Every labelled row gets a prediction, whatever inputs it lacks."""
    prepared = features.boolean_as_double(modelling.usable_rows(prepare(t.listings, accuracy=ACCURACY, keep=["vin"])), v.MODEL_BOOLEANS)
    read = present(prepared, ["make_name", v.LABEL, *v.MODEL_CATEGORIES, *v.MODEL_NUMERICS, *v.MODEL_BOOLEANS])
    # Every stage of the pipeline is a pass over these rows: they are imputed once, not once a pass.
    prepared = stage(prepared.select(*read))
    categories, others = modelling.model_columns(prepared)
    made = pipelines.candidates(categories, others, v.LABEL, validation=None, with_mean=False, linear={"maxIter": 5}, filled=others,
                                flagged=pipelines.open_columns(prepared, others))
    scored = made["linear"].pipeline.fit(prepared).transform(prepared)
    known = F.col("prediction").isNotNull() & ~F.isnan("prediction")
    return scored.groupBy("make_name").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(known, 1)).alias("n_scored"))


@query()
def model_selection(t: Tables):
    """Prepare listings, draw a stratified subset, split it, tune three candidates in two rounds, and report the winner's errors.

    Target, least rows per stratum, grids and ensembles are the library's defaults, which are the reference's.
    """
    prepared = modelling.usable_rows(prepare(t.listings, keep=["vin"]))
    train, test = modelling.modelling_split(t.spark, prepared, t.new_path(), t.new_path(), ["vin"])
    models = modelling.train_candidates(train, ["vin"])
    selection = modelling.select(models, test, train)
    winner = selection.metrics.where(F.col("model") == selection.best)
    return modelling.error_report(selection, test, ["vin"])["summary"].withColumns(
        {"model": F.lit(selection.best), "n_models": F.lit(len(models))} | {c: winner.select(c).scalar() for c in ("r2", "r2_train", "overfit")})


# --- columns ----------------------------------------------------------------------------

@query(union([f"SELECT '{c}' AS \"column\" FROM lineitem HAVING stddev({c}) > 0"
              for c in ("l_quantity", "l_discount", "l_tax")]))
def varying_columns(t: Tables):
    lines = t.lineitem.withColumn("constant", F.lit(1.0))
    kept = pipelines.varying_columns(lines, ["l_quantity", "l_discount", "l_tax", "constant", "l_returnflag", "absent"])
    return t.spark.createDataFrame([(c,) for c in kept], "`column` string")


# --- predictions ------------------------------------------------------------------------

_SHIFT = "({slope}e0 * (l_quantity - 25e0) + l_discount - 5e-2)"
_TRUE = "ln(floor(l_extendedprice))"


def _scored(t: Tables, slope: float = 0.002) -> DataFrame:
    """A log price and a stand-in prediction that is off by a known amount."""
    label = F.log(F.floor("l_extendedprice").cast("double"))
    shift = F.lit(slope) * (F.col("l_quantity") - 25) + F.col("l_discount") - 0.05
    return t.lineitem.select(*KEY, "l_returnflag", label.alias(LABEL), (label + shift).alias("prediction"))


def _scored_sql(slope: float = 0.002) -> str:
    return (f"SELECT {', '.join(KEY)}, l_returnflag, {_TRUE} AS log_price, "
            f"{_TRUE} + {_SHIFT.format(slope=slope)} AS prediction FROM lineitem")


def _metrics_sql(slope: float, extra: str = "") -> str:
    return f"""
    SELECT {extra} count(*) AS n, round(sqrt(avg(pow(log_price - prediction, 2))), 8) AS rmse,
           round(avg(abs(log_price - prediction)), 8) AS mae,
           round(1 - avg(pow(log_price - prediction, 2)) / var_pop(log_price), 8) AS r2,
           round(avg(pow(log_price - prediction, 2)), 8) AS mse,
           round((exp(sqrt(avg(pow(log_price - prediction, 2)))) - 1) * 100, 8) AS typical_error_pct
    FROM ({_scored_sql(slope)}) AS s"""


@query(_metrics_sql(0.002))
def score_metrics(t: Tables):
    return stats.round_doubles(evaluate.regression_metrics(_scored(t), LABEL), 8)


_SLOPES = {"linear": 0.004, "boosted": 0.002, "forest": 0.003}


@query(f"SELECT * FROM ({union([_metrics_sql(s, f'{chr(39)}{name}{chr(39)} AS model,') for name, s in _SLOPES.items()])}) AS m "
       "ORDER BY r2 DESC LIMIT 1")
def select_best(t: Tables):
    rows = [evaluate.regression_metrics(_scored(t, slope), LABEL).withColumn("model", F.lit(name))
            for name, slope in _SLOPES.items()]
    return stats.round_doubles(evaluate.select_best(reduce(DataFrame.unionByName, rows)), 8)


_PRICED = f"""
WITH scored AS ({_scored_sql()}),
whole AS (SELECT *, CAST(round(exp(log_price)) AS INTEGER) AS actual, CAST(round(exp(prediction)) AS INTEGER) AS predicted FROM scored),
priced AS (SELECT *, abs(actual - predicted) AS error_abs,
                  {rnd('CAST(abs(actual - predicted) AS DOUBLE) / actual * 100e0', 2)} AS error_pct FROM whole)"""
_SHOWN = f"{', '.join(KEY)}, actual, predicted, error_abs, error_pct"


def _priced(t: Tables) -> DataFrame:
    return features.back_transform(_scored(t), LABEL).select(*KEY, "actual", "predicted", "error_abs", "error_pct")


@query(f"{_PRICED} SELECT {_SHOWN} FROM priced")
def back_transform(t: Tables):
    return _priced(t)


@query(f"""{_PRICED}
SELECT count(*) AS n, round(avg(error_pct), 2) AS mean, quantile_disc(error_pct, 0.5) AS median, min(error_pct) AS min,
       max(error_pct) AS max, count(*) FILTER (WHERE error_pct < 5) AS n_below_5,
       count(*) FILTER (WHERE error_pct < 10) AS n_below_10, count(*) FILTER (WHERE error_pct < 20) AS n_below_20 FROM priced""")
def error_summary(t: Tables):
    return evaluate.error_summary(_priced(t), accuracy=ACCURACY)


@query(f"{_PRICED} SELECT {_SHOWN} FROM priced WHERE error_pct < 5 ORDER BY error_pct, {', '.join(KEY)} LIMIT 10")
def best_predictions(t: Tables):
    return evaluate.best_predictions(_priced(t), 5.0, 10, KEY)


@query(f"{_PRICED} SELECT {_SHOWN} FROM priced WHERE error_pct > 8 ORDER BY error_pct DESC, {', '.join(KEY)} LIMIT 10")
def worst_predictions(t: Tables):
    return evaluate.worst_predictions(_priced(t), 8.0, 10, KEY)
