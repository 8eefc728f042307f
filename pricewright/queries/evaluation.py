"""Metrics, weights and blends of predictions that SQL can state."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright import fixed
from pricewright.functions import metrics as M
from pricewright.functions import numeric as N
from pricewright.operators import evaluate as E
from pricewright.operators.brands import BrandStats
from pricewright.operators.folds import add_fold
from pricewright.queries import sql as Q
from pricewright.queries.numbers import LINE_KEY, rounded
from pricewright.queries.registry import query
from pricewright.sources.tables import catalog_line

_KEY = ", ".join(LINE_KEY)
MODELS = {"mean": "p_mean", "median": "p_median", "value": "p_value"}

# Three predictions of a line's price, with its fold.
PRIOR = f"""{Q.LINE}, s AS (SELECT brand, avg(price) AS p_mean, median(price) AS p_median FROM line GROUP BY brand),
pred AS (SELECT line.*, p_mean, p_median, 100 * value AS p_value, {Q.fold('l_orderkey', 3)} AS fold FROM line JOIN s USING (brand)),
long AS (SELECT {_KEY}, price, fold, unnest(['mean', 'median', 'value']) AS model, unnest([p_mean, p_median, p_value]) AS p FROM pred)"""


def round_metrics(df):
    return df.withColumns({m: F.round(m, 8 if m == "max_error" else 4) for m in M.METRICS})


def predictions(spark, sf):
    rows = add_fold(catalog_line(spark, sf), 3, "l_orderkey")
    priced = BrandStats.fit(rows).transform(rows, default_price=fixed.UNSEEN_BRAND_PRICE)
    return priced.select(*LINE_KEY, "price", "fold", F.col("brand_mean").alias("p_mean"), F.col("brand_median").alias("p_median"),
                         (F.col("value") * 100).alias("p_value"))


def long(spark, sf, rows=None):
    return E.to_long(predictions(spark, sf) if rows is None else rows, MODELS, ["price", "fold"])


@query("metric_smape", f"WITH {PRIOR} SELECT round(avg(abs(price - p_median) / ((abs(price) + abs(p_median)) / 2)) * 100, 4) AS smape FROM pred")
def metric_smape(spark, sf):
    return predictions(spark, sf).agg(F.round(M.smape(F.col("price"), F.col("p_median")), 4).alias("smape"))


@query("regression_metrics", f"WITH {PRIOR} SELECT count(*) AS n, {Q.metrics('price', 'p_median')} FROM pred")
def regression_metrics(spark, sf):
    return round_metrics(E.metrics(predictions(spark, sf), "price", "p_median"))


@query("metrics_by_model", f"WITH {PRIOR} SELECT model, count(*) AS n, {Q.metrics('price', 'p')} FROM long GROUP BY model")
def metrics_by_model(spark, sf):
    return round_metrics(E.metrics(long(spark, sf), "price", "prediction", ["model"]))


@query("metrics_by_fold", f"WITH {PRIOR} SELECT model, fold, count(*) AS n, {Q.metrics('price', 'p')} FROM long GROUP BY model, fold")
def metrics_by_fold(spark, sf):
    return round_metrics(E.metrics(long(spark, sf), "price", "prediction", ["model", "fold"]))


_FOLDS = f"per AS (SELECT model, fold, {Q.metrics('price', 'p', 12)} FROM long GROUP BY model, fold)"
_SUMMARY = [f"{m}_{s}" for m in M.METRICS for s in ("mean", "std")]


@query("cv_summary", f"WITH {PRIOR}, {_FOLDS} SELECT model, " + ", ".join(
    f"round(avg({m}), 4) AS {m}_mean, round(stddev_pop({m}), 4) AS {m}_std" for m in M.METRICS) + " FROM per GROUP BY model")
def cv_summary(spark, sf):
    return rounded(E.cv_summary(E.metrics(long(spark, sf), "price", "prediction", ["model", "fold"])), ["model"], _SUMMARY, 4)


@query("prediction_stats", f"""
WITH {PRIOR} SELECT count(p_mean) AS count, round(avg(p_mean), 4) AS mean, round(stddev_pop(p_mean), 4) AS std, round(min(p_mean), 4) AS min,
  round(max(p_mean), 4) AS max, round(median(p_mean), 4) AS median FROM pred""")
def prediction_stats(spark, sf):
    return rounded(E.prediction_stats(predictions(spark, sf), "p_mean"), ["count"], ["mean", "std", "min", "max", "median"], 4)


_WEIGHTS = f"""score AS (SELECT model, avg(abs(price - p) / ((abs(price) + abs(p)) / 2)) * 100 AS smape FROM long GROUP BY model),
weight AS (SELECT model, (1 / (smape + 1e-6)) / sum(1 / (smape + 1e-6)) OVER () AS weight FROM score)"""


def _weights(spark, sf, rows=None):
    scores = E.metrics(long(spark, sf, rows), "price", "prediction", ["model"])
    return E.inverse_error_weights(scores, "smape", fixed.WEIGHT_EPSILON)


@query("blend_weights", f"WITH {PRIOR}, {_WEIGHTS} SELECT model, round(weight, 6) AS weight FROM weight")
def blend_weights(spark, sf):
    return rounded(_weights(spark, sf), ["model"], ["weight"])


_W = """w AS (SELECT max(weight) FILTER (model = 'mean') AS a, max(weight) FILTER (model = 'median') AS b,
  max(weight) FILTER (model = 'value') AS c FROM weight)"""
_BLENDED = "exp(a * ln(1 + p_mean) + b * ln(1 + p_median) + c * ln(1 + p_value)) - 1"
_BLEND = f"{_WEIGHTS}, {_W}, blend AS (SELECT {_KEY}, price, {_BLENDED} AS prediction FROM pred, w)"


def blended(spark, sf, rows=None):
    rows = predictions(spark, sf) if rows is None else rows
    weights = {r["model"]: r["weight"] for r in _weights(spark, sf, rows).collect()}  # one row per model
    logged = {m: F.log1p(c) for m, c in MODELS.items()}
    return rows.withColumn("prediction", N.unlog_target(E.weighted_sum(logged, weights)))


@query("weighted_blend", f"WITH {PRIOR}, {_BLEND} SELECT {_KEY}, round(prediction, 4) AS prediction FROM blend")
def weighted_blend(spark, sf):
    return rounded(blended(spark, sf), LINE_KEY, ["prediction"], 4)


@query("ensemble_metrics", f"WITH {PRIOR}, {_BLEND} SELECT count(*) AS n, {Q.metrics('price', 'prediction')} FROM blend")
def ensemble_metrics(spark, sf):
    return round_metrics(E.metrics(blended(spark, sf), "price", "prediction"))


@query("results_table", f"""
WITH {PRIOR}, {_BLEND}
SELECT 'models' AS scope, model, count(*) AS n, {Q.metrics('price', 'p')} FROM long GROUP BY model
UNION ALL SELECT 'ensemble', NULL, count(*), {Q.metrics('price', 'prediction')} FROM blend""")
def results_table(spark, sf):
    rows = predictions(spark, sf)
    return E.results_table({
        "models": round_metrics(E.metrics(long(spark, sf, rows), "price", "prediction", ["model"])),
        "ensemble": round_metrics(E.metrics(blended(spark, sf, rows), "price", "prediction")),
    })
