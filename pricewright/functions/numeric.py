"""Scalar numeric features, the target transform and the last step of a prediction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_missing(value: Column) -> Column:
    return value.isNull().cast("int")


def log1p_floor0(value: Column) -> Column:
    """log(1 + value), negatives counted as 0; missing stays missing, which ``greatest`` would not keep."""
    number = value.cast("double")
    return F.log1p(F.when(number < 0, F.lit(0.0)).otherwise(number))


def finite_or_zero(value: Column) -> Column:
    """Parse to double; what does not parse, NaN, NULL and the infinities become 0."""
    number = value.try_cast("double")
    return F.when(number.isNull() | F.isnan(number) | (F.abs(number) == float("inf")), F.lit(0.0)).otherwise(number)


def value_x_pack(value: Column, pack: Column) -> Column:
    return value * pack


def value_per_pack(value: Column, pack: Column) -> Column:
    return value / (pack + 1)


def log_target(price: Column) -> Column:
    return F.log1p(price)


def unlog_target(prediction: Column) -> Column:
    return F.expm1(prediction)


def postprocess_price(prediction: Column, low: float, high: float) -> Column:
    """Clip to [low, high] and round half-even to cents; a missing prediction becomes ``low``.

    NaN goes first, because Spark orders it above every number.
    """
    known = F.coalesce(F.nanvl(prediction, F.lit(low)), F.lit(low))
    return F.rint(F.least(F.greatest(known, F.lit(low)), F.lit(high)) * 100) / 100
