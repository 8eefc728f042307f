"""Metrics of predictions, per model, per fold, and over folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.functions import metrics as M
from pricewright.operators.quantiles import exact_quantiles


def to_long(df: DataFrame, predictions: dict[str, str], keep: list[str], column: str = "prediction") -> DataFrame:
    """Wide predictions to (keep..., model, prediction) rows, without a shuffle."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias(column)) for m, c in predictions.items()])
    return df.select(*keep, F.inline_outer(pairs))


def metrics(df: DataFrame, y: str, p: str, by: list[str] = ()) -> DataFrame:
    """All metrics in one aggregation; only sums, counts and maxima move."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *M.all_metrics(F.col(y), F.col(p)))


def cv_summary(per_fold: DataFrame, by: list[str] = ("model",)) -> DataFrame:
    """Mean and population std over folds of every metric."""
    return per_fold.groupBy(*by).agg(*[
        agg(m).alias(f"{m}_{name}") for m in M.METRICS for name, agg in (("mean", F.avg), ("std", F.stddev_pop))
    ])


def prediction_stats(df: DataFrame, column: str) -> DataFrame:
    """count, mean, median, population std, min, max of raw predictions."""
    v = F.col(column).cast("double")
    median = exact_quantiles(df, column, [0.5]).select(F.col("quantiles")[0]).scalar()
    basics = df.agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")
    )
    return basics.withColumn("median", median)


def inverse_error_weights(scores: DataFrame, error: str = "smape", epsilon: float = 1e-6) -> DataFrame:
    """(model, weight) with weights proportional to 1 / error and summing to 1. One row per model."""
    inverse = scores.select("model", (1 / (F.col(error) + epsilon)).alias("_inverse"))
    total = inverse.agg(F.sum("_inverse")).scalar()
    return inverse.select("model", (F.col("_inverse") / total).alias("weight"))


def results_table(parts: dict[str, DataFrame]) -> DataFrame:
    """Metric frames under a ``scope`` column; columns a part lacks are NULL."""
    out = None
    for scope, part in parts.items():
        part = part.select(F.lit(scope).alias("scope"), "*")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def aggregate_importance(importances: DataFrame) -> DataFrame:
    """Mean and sample std over models of each feature's importance, largest mean first."""
    by_feature = importances.groupBy("feature").agg(
        F.avg("importance").alias("mean_importance"), F.stddev_samp("importance").alias("std_importance")
    )
    return by_feature.orderBy(F.desc("mean_importance"), "feature")


def weighted_sum(columns: dict[str, Column], weights: dict[str, float]) -> Column:
    """Sum of weight x prediction; a model without a weight counts 1 / number of models."""
    equal = 1.0 / len(columns)
    total = F.lit(0.0)
    for model, column in columns.items():
        total = total + F.lit(float(weights.get(model, equal))) * column
    return total
