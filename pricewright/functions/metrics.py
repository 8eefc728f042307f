"""Regression metrics as aggregate expressions, usable under any ``groupBy``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewright import fixed

METRICS = ["smape", "mae", "rmse", "r2", "mape", "max_error", "mean_prediction", "std_prediction"]


def smape(y: Column, p: Column) -> Column:
    half_sum = (F.abs(y) + F.abs(p)) / 2
    safe = F.when(half_sum == 0, F.lit(fixed.ZERO_DENOMINATOR)).otherwise(half_sum)
    return F.coalesce(F.avg(F.abs(y - p) / safe) * 100, F.lit(0.0))


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


def r2(y: Column, p: Column) -> Column:
    """1 - residual / total sum of squares; a constant target gives 1 when met exactly, else 0."""
    residual = F.sum((y - p) * (y - p))
    total = F.var_pop(y) * F.count(y)
    flat = F.when(residual == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(F.min(y) == F.max(y), flat).otherwise(1 - F.try_divide(residual, total))


def mape(y: Column, p: Column) -> Column:
    safe = F.when(y == 0, F.lit(fixed.ZERO_DENOMINATOR)).otherwise(y)
    return F.avg(F.abs((y - p) / safe)) * 100


def max_error(y: Column, p: Column) -> Column:
    return F.max(F.abs(y - p))


def all_metrics(y: Column, p: Column) -> list[Column]:
    columns = {
        "smape": smape(y, p), "mae": mae(y, p), "rmse": rmse(y, p), "r2": r2(y, p), "mape": mape(y, p),
        "max_error": max_error(y, p), "mean_prediction": F.avg(p), "std_prediction": F.stddev_pop(p),
    }
    return [c.alias(name) for name, c in columns.items()]
