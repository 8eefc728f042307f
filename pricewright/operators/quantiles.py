"""Exact quantiles, overall or per group, without ever gathering a group in one task.

Spark's ``percentile`` keeps a group's distinct values in one hash map, so a group with a third of all
rows would sit in one task.  Here a value gets two ordered digits: its position on a log scale (1,024
steps per octave) and its position inside that step (2**20 sub-steps).  Counting by digit combines on the
map side; cumulative counts say which digit holds the wanted rank; only rows under that digit go on.
The values themselves are never shuffled as a whole: the columns are read twice instead.

Bounds per group: 2,100 octaves x 1,024 first digits at most, 2**20 second digits, and 2**22 distinct
doubles left for the last step.  Nothing depends on the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.session import materialise

_STEPS = 1024  # first digit: steps per octave
_SUBSTEPS = 1 << 20  # second digit: parts of one step
_OFFSET = 1100 * _STEPS  # above the smallest exponent of a double
BROADCAST_STEPS = 200_000  # rows of three numbers, a group key and a short array: some 30 MB


def _first_digit(v: Column) -> Column:
    size = F.abs(v)
    step = F.when(size == float("inf"), F.lit(1100 * _STEPS)).otherwise(F.floor(F.log2(size) * _STEPS))
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("bigint") * (step + _OFFSET))


def _second_digit(v: Column, first: Column) -> Column:
    """Monotone in ``v`` within one first digit, which is all that is needed of it."""
    low = F.pow(F.lit(2.0), (F.abs(first) - _OFFSET) / _STEPS)
    part = F.floor((F.abs(v) / low - 1) * (_SUBSTEPS * _STEPS / math.log(2)))
    return F.when((v == 0) | (F.abs(v) == float("inf")), F.lit(0)).otherwise(F.signum(v).cast("bigint") * part)


def _within(hits: Column, before: Column, count: Column) -> Column:
    """Keep the wanted ranks that fall in [before, before + count), counted from ``before``."""
    kept = F.filter(hits, lambda h: (h["rank"] >= before) & (h["rank"] < before + count))
    return F.transform(kept, lambda h: F.struct(h["slot"].alias("slot"), (h["rank"] - before).alias("rank")))


def _before(keys: list[str], digit: str) -> Column:
    rows = Window.partitionBy(*keys).orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_count").over(rows), F.lit(0))


def _join_steps(rows: DataFrame, steps: DataFrame, grouped: bool) -> DataFrame:
    on = ["_group", "_first"]
    if not grouped:
        return rows.join(F.broadcast(steps), on)
    steps = materialise(steps, "quantile-steps")
    if steps.count() <= BROADCAST_STEPS:
        return rows.join(F.broadcast(steps), on)
    counted = rows.groupBy(*on, "_value").agg(F.sum("_weight").alias("_weight"))  # a value of a hot group is one row a task
    return counted.join(steps, on)


def exact_quantiles(df: DataFrame, value: str, probabilities: list[float], by: list[str] | None = None) -> DataFrame:
    """Linearly interpolated quantiles: one row per group with ``n`` and the array ``quantiles``.

    NULL and NaN are skipped, as pandas does.  Without ``by`` the result is a single row (none if the
    column holds no value).
    """
    by = by or []
    group = F.struct(*by) if by else F.lit(0)  # a struct equals another with NULL in the same place
    # Digits are declared non-null, so that no join below adds its own null filter to the scan.
    rows = (
        df.select(group.alias("_group"), F.col(value).cast("double").alias("_value"))
        .where(F.col("_value").isNotNull() & ~F.isnan("_value"))
        .withColumn("_value", F.coalesce("_value", F.lit(0.0)))
        .withColumns({"_first": F.coalesce(_first_digit(F.col("_value")), F.lit(0)), "_weight": F.lit(1).cast("bigint")})
    )

    # Two wanted ranks per probability, in slots 2i and 2i + 1; the value lies between the two.
    shares = F.lit([float(p) for p in probabilities])

    def slots(offset: int, rounding: Callable[[Column], Column]) -> Column:
        return F.transform(shares, lambda p, i: F.struct(
            (2 * i + offset).alias("slot"), rounding(p * (F.col("n") - 1)).alias("rank")
        ))

    wanted = F.concat(slots(0, F.floor), slots(1, F.ceil))
    steps = (
        rows.groupBy("_group", "_first")
        .agg(F.count(F.lit(1)).alias("_count"))
        .withColumn("n", F.sum("_count").over(Window.partitionBy("_group")))
        .withColumn("_at", _before(["_group"], "_first"))
        .select("_group", "_first", "n", _within(wanted, F.col("_at"), F.col("_count")).alias("_hits"))
        .where(F.size("_hits") > 0)
    )

    # At most two rows per group and probability survive.  Without groups that is a fixed number; with
    # groups their size is checked, and beyond the limit equal values are counted before they meet the steps.
    inside = _join_steps(rows, steps, grouped=bool(by)).withColumn(
        "_second", F.coalesce(_second_digit(F.col("_value"), F.col("_first")), F.lit(0))
    )
    keys = ["_group", "_first", "_second"]
    inside = inside.groupBy(*keys, "_value", "n", "_hits").agg(F.sum("_weight").alias("_count"))
    parts = (
        inside.groupBy(*keys, "_hits")
        .agg(F.sum("_count").alias("_count"))
        .withColumn("_at", _before(["_group", "_first"], "_second"))
        .select(*keys, _within(F.col("_hits"), F.col("_at"), F.col("_count")).alias("_found"))
        .where(F.size("_found") > 0)
    )
    last = inside.drop("_hits").join(parts if by else F.broadcast(parts), keys)
    picked = last.withColumn("_at", _before(keys, "_value")).select(
        "_group", "n", "_value", F.explode(_within(F.col("_found"), F.col("_at"), F.col("_count"))).alias("_hit")
    )

    # A group has exactly 2 x probabilities of these rows.
    found = picked.groupBy("_group", "n").agg(F.sort_array(F.collect_list(F.struct("_hit.slot", "_value"))).alias("_found"))

    def between(p: Column, i: Column) -> Column:
        low, high = F.get("_found", 2 * i)["_value"], F.get("_found", 2 * i + 1)["_value"]
        share = p * (F.col("n") - 1) - F.floor(p * (F.col("n") - 1))
        return F.when(low == high, low).otherwise(low * (1 - share) + high * share)

    out = found.withColumn("quantiles", F.transform(shares, between))
    return out.select(*[F.col(f"_group.{c}").alias(c) for c in by], "n", "quantiles")


def sketched_quantiles(
    df: DataFrame, value: str, probabilities: list[float], by: list[str] | None = None, accuracy: int = 10_000
) -> DataFrame:
    """Approximate quantiles from mergeable sketches, in one pass: one row per group with ``n`` and ``quantiles``.

    A quantile is a value of the column whose rank differs from the wanted one by at most n / ``accuracy``.  A sketch
    holds some multiple of ``accuracy`` numbers whatever the group's size, and tasks send sketches, not rows.  NULL and NaN are
    skipped; a group without a value gives no row.
    """
    x = F.col(value).cast("double")
    known = df.select(*(by or []), x.alias("_value")).where(F.col("_value").isNotNull() & ~F.isnan("_value"))
    shares = F.array(*[F.lit(float(p)) for p in probabilities])
    found = known.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("_value", shares, accuracy).alias("quantiles"))
    return found.where("n > 0")


def column_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """Exact median of each column, all columns in one pass; a column without values is left out."""
    pairs = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(F.inline_outer(pairs))
    medians = exact_quantiles(long, "value", [0.5], by=["name"])
    return {row["name"]: row["quantiles"][0] for row in medians.collect()}  # one row per column name
