"""Numeric features, feature frames, price bounds and post-processing."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright import fixed
from pricewright.functions import numeric as N
from pricewright.operators import features as X
from pricewright.operators.outliers import PriceBounds, describe, price_bounds
from pricewright.operators.parse import parse_detailed, parse_labelled
from pricewright.operators.validate import submission_stats, validate_path, validate_submission
from pricewright.queries import sql as Q
from pricewright.queries.registry import query
from pricewright.session import new_table_path
from pricewright.sources.submission import BLEND_LIMITS, STACK_LIMITS, submission, write_submission
from pricewright.sources.tables import catalog, catalog_line, table

LINE_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_KEY = ", ".join(LINE_KEY)


def rounded(df, keep, columns, digits=6):
    return df.select(*keep, *[F.round(F.col(c), digits).alias(c) for c in columns])


@query("numeric_features", f"""
WITH {Q.LINES}, m AS (SELECT """ + ", ".join(f"median({c}) AS m_{c}" for c in X.SPEC_COLUMNS) + " FROM lines) SELECT sample_id, " + ", ".join(
    f"CAST({c} IS NULL AS INT) AS {c}_is_missing, round(CAST(coalesce({c}, m_{c}) AS DOUBLE), 6) AS {c}, "
    f"round(ln(1 + greatest(CAST(coalesce({c}, m_{c}) AS DOUBLE), 0)), 6) AS {c}_log" for c in X.SPEC_COLUMNS) + " FROM lines, m")
def numeric_features(spark, sf):
    """Missing flag, median fill and log of value, weight and pack count."""
    rows = X.detailed_value_features(parse_detailed(catalog(spark, sf), "lines"))
    doubles = [f"{c}{s}" for c in X.SPEC_COLUMNS for s in ("", "_log")]
    return rounded(rows, ["sample_id", *[f"{c}_is_missing" for c in X.SPEC_COLUMNS]], doubles)


@query("interaction_features", f"""
WITH {Q.LABELLED}, m AS (SELECT median(value) AS m FROM parsed),
filled AS (SELECT sample_id, value, coalesce(value, m, 0) AS v, coalesce(pack_count, 1) AS p FROM parsed, m)
SELECT sample_id, CAST(value IS NULL AS INT) AS value_missing, p AS pack_count_filled, round(v, 6) AS value_filled,
  round(ln(1 + v), 6) AS value_log, round(ln(1 + p), 6) AS pack_log, round(v * p, 6) AS value_x_pack,
  round(v / (p + 1), 6) AS value_per_pack
FROM filled""")
def interaction_features(spark, sf):
    rows = X.labelled_value_features(parse_labelled(catalog(spark, sf)))
    return rounded(rows, ["sample_id", "value_missing", "pack_count_filled"],
                   ["value_filled", "value_log", "pack_log", "value_x_pack", "value_per_pack"])


def _mixed(spark, sf):
    """Events with a text column of numbers and non-numbers, a flag, and a number with the special values."""
    e = table(spark, sf, "events")
    at = F.col("event_id") % 7
    text = F.when(at == 0, "abc").when(at == 1, "NaN").when(at == 2, "Infinity").when(at != 3, F.col("user_id").cast("string"))
    special = F.when(at == 0, float("nan")).when(at == 1, float("inf")).when(at == 2, float("-inf")).when(at != 3, F.col("value"))
    return e.select("event_id", "event_type", text.alias("text"), special.alias("number"), (F.col("value") > 50).alias("flag"))


_NUMBER = "CASE WHEN event_id % 7 > 3 THEN coalesce(value, 0) ELSE 0 END AS number"
_FLAG = "CAST(coalesce(value > 50, false) AS DOUBLE) AS flag"


@query("sanitize_numeric", f"""
SELECT event_id, CAST(0 AS DOUBLE) AS event_type, CASE WHEN event_id % 7 > 3 THEN CAST(user_id AS DOUBLE) ELSE 0 END AS text,
  {_NUMBER}, {_FLAG} FROM events""")
def sanitize_numeric(spark, sf):
    return X.sanitize(_mixed(spark, sf), ["event_type", "text", "number", "flag"])


@query("numeric_only", f"SELECT event_id, {_NUMBER} FROM events")
def numeric_only(spark, sf):
    return X.sanitize_numeric_only(_mixed(spark, sf), ["event_type", "text", "number", "flag"])


_SCALARS = ("value", "spec_weight_value", "spec_pack_count", "image_link_valid", "image_url_length")


@query("feature_columns", f"""
WITH {Q.FLAT} SELECT sample_id, value, spec_weight_value, spec_pack_count, """ + ", ".join(
    f"category_{c}" for c in fixed.CATEGORY_KEYWORDS) + """,
  CAST(coalesce(starts_with(image_link, 'http'), false) AS INT) AS image_link_valid,
  CAST(length(coalesce(image_link, 'nan')) AS INT) AS image_url_length FROM flat""")
def feature_columns(spark, sf):
    """The numeric columns that survive the exclusion list."""
    rows = parse_detailed(catalog(spark, sf))
    chosen = X.feature_columns(rows, fixed.NON_FEATURES_STACK, numeric_only=True, also_in=rows.drop("price"))
    return rows.select("sample_id", *chosen)


@query("align_zero_fill", f"""
WITH {Q.LABELLED} SELECT sample_id, CAST(0 AS DOUBLE) AS brand_mean, value, pack_count, CAST(0 AS DOUBLE) AS sentiment FROM parsed""")
def align_zero_fill(spark, sf):
    return X.align_zero_fill(parse_labelled(catalog(spark, sf)), ["brand_mean", "value", "pack_count", "sentiment"], ["sample_id"])


@query("align_intersection", f"WITH {Q.LABELLED} SELECT sample_id, value, pack_count FROM parsed")
def align_intersection(spark, sf):
    return X.align_intersection(parse_labelled(catalog(spark, sf)), ["brand_mean", "value", "pack_count"], ["sample_id"])


@query("log_target", f"""
WITH {Q.LINE} SELECT {_KEY}, round(ln(1 + price), 6) AS log_price, round(exp(ln(1 + price)) - 1, 8) AS price FROM line""")
def log_target(spark, sf):
    logged = N.log_target(F.col("price"))
    return catalog_line(spark, sf).select(
        *LINE_KEY, F.round(logged, 6).alias("log_price"), F.round(N.unlog_target(logged), 8).alias("price")
    )


def _raw_predictions(spark, sf):
    at = (F.col("l_orderkey") + F.col("l_linenumber")) % 11
    raw = F.when(at == 0, float("nan")).when(at == 1, float("inf")).when(at == 2, float("-inf")).when(at != 3, F.col("price") / 8 - 10)
    return catalog_line(spark, sf).withColumn("prediction", raw)


def _postprocess_sql(low: float, high: float) -> str:
    at = "(l_orderkey + l_linenumber) % 11"
    return (f"CASE WHEN {at} IN (0, 2, 3) THEN {low}::DOUBLE WHEN {at} = 1 THEN {high}::DOUBLE "
            f"ELSE round_even(least(greatest(price / 8 - 10, {low}::DOUBLE), {high}::DOUBLE) * 100, 0) / 100 END")


@query("postprocess_prices", f"""
WITH {Q.LINE} SELECT {_KEY}, {_postprocess_sql(*BLEND_LIMITS)} AS blend_price, {_postprocess_sql(*STACK_LIMITS)} AS stack_price FROM line""")
def postprocess_prices(spark, sf):
    p = F.col("prediction")
    return _raw_predictions(spark, sf).select(
        *LINE_KEY, N.postprocess_price(p, *BLEND_LIMITS).alias("blend_price"), N.postprocess_price(p, *STACK_LIMITS).alias("stack_price")
    )


@query("submission", f"""
WITH {Q.CATALOG} SELECT sample_id, CASE WHEN price IS NULL THEN 1.0::DOUBLE
  ELSE round_even(least(greatest(price * 20 - 100, 1.0::DOUBLE), 5000.0::DOUBLE) * 100, 0) / 100 END AS price FROM catalog""")
def submission_rows(spark, sf):
    return submission(catalog(spark, sf).withColumn("prediction", F.col("price") * 20 - 100), BLEND_LIMITS)


_BOUNDS = "bounds AS (SELECT quantile_cont(price, 0.005) AS q_low, quantile_cont(price, 0.995) AS q_high FROM line)"


@query("price_bounds", f"WITH {Q.LINE}, {_BOUNDS} SELECT round(q_low, 8) AS q_low, round(q_high, 8) AS q_high FROM bounds")
def bounds(spark, sf):
    return rounded(price_bounds(catalog_line(spark, sf)), [], ["q_low", "q_high"], 8)


@query("outlier_filter", f"""
WITH {Q.LINE}, {_BOUNDS} SELECT {_KEY}, price FROM line, bounds WHERE price BETWEEN q_low AND q_high""")
def outlier_filter(spark, sf):
    rows = catalog_line(spark, sf)
    return PriceBounds.fit(rows).transform(rows).select(*LINE_KEY, "price")


@query("outlier_report", f"""
WITH {Q.LINE}, {_BOUNDS} SELECT count(*) AS before, count(*) FILTER (NOT price BETWEEN q_low AND q_high) AS removed,
  round(100.0 * count(*) FILTER (NOT price BETWEEN q_low AND q_high) / count(*), 6) AS removed_percent FROM line, bounds""")
def outlier_report(spark, sf):
    rows = catalog_line(spark, sf)
    return rounded(PriceBounds.fit(rows).report(rows), ["before", "removed"], ["removed_percent"])


@query("price_describe", f"""
WITH {Q.LINE} SELECT count(price) AS count, round(avg(price), 4) AS mean, round(stddev_samp(price), 4) AS std, round(min(price), 8) AS min,
  round(max(price), 8) AS max, round(quantile_cont(price, 0.25), 8) AS q25, round(median(price), 8) AS median,
  round(quantile_cont(price, 0.75), 8) AS q75 FROM line""")
def price_describe(spark, sf):
    exact = ["min", "max", "q25", "median", "q75"]
    d = describe(catalog_line(spark, sf)).withColumns({c: F.round(c, 8) for c in exact})
    return rounded(d, ["count", *exact], ["mean", "std"], 4)


_CHECKS = """
SELECT c AS check, v = 0 AS passed, CAST(v AS BIGINT) AS violations FROM (
  SELECT 'correct_columns' AS c, {columns} AS v FROM n UNION ALL SELECT 'price_numeric', not_numeric FROM n
  UNION ALL SELECT 'prices_positive', not_positive FROM n UNION ALL SELECT 'no_missing_values', missing FROM n
  UNION ALL SELECT 'no_duplicate_ids', duplicates FROM n)"""
_FAULTY = """sub AS (SELECT l_orderkey AS sample_id, CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 4 THEN 'nan'::DOUBLE
    ELSE price - 100 END AS price FROM line),
n AS (SELECT 0 AS not_numeric, count(*) FILTER (NOT coalesce(price > 0 AND NOT isnan(price), false)) AS not_positive,
    count(*) FILTER (price IS NULL OR isnan(price)) + count(*) FILTER (sample_id IS NULL) AS missing,
    count(sample_id) - count(DISTINCT sample_id) AS duplicates FROM sub)"""


@query("validate_submission", f"WITH {Q.LINE}, {_FAULTY} {_CHECKS.format(columns=0)}")
def validate(spark, sf):
    """A faulty submission: repeated ids, missing, NaN and negative prices."""
    price = F.when(F.col("l_linenumber") == 4, float("nan")).when(F.col("l_linenumber") != 3, F.col("price") - 100)
    return validate_submission(catalog_line(spark, sf).select(F.col("l_orderkey").alias("sample_id"), price.alias("price")))


@query("validate_good_submission", f"""
WITH {Q.CATALOG}, n AS (SELECT 0 AS not_numeric, 0 AS not_positive, 0 AS missing, count(sample_id) - count(DISTINCT sample_id) AS duplicates FROM catalog)
SELECT 'file_exists' AS check, true AS passed, CAST(0 AS BIGINT) AS violations UNION ALL {_CHECKS.format(columns=0)}""")
def validate_good(spark, sf):
    """A submission written to a file and checked there: all checks pass."""
    rows = submission(catalog(spark, sf).withColumn("prediction", F.coalesce("price", F.lit(1.0))), BLEND_LIMITS)
    return validate_path(spark, write_submission(rows, new_table_path(spark, "submission")))


@query("validate_swapped_submission", f"""
WITH {Q.CATALOG}, n AS (SELECT count(*) FILTER (sample_id % 3 = 0) AS not_numeric,
  count(*) FILTER (sample_id % 3 = 0 OR coalesce(price, 0) <= 0) AS not_positive, count(*) FILTER (sample_id % 3 <> 0 AND price IS NULL) AS missing, 0 AS duplicates FROM catalog)
SELECT 'file_exists' AS check, true AS passed, CAST(0 AS BIGINT) AS violations UNION ALL {_CHECKS.format(columns=1)}""")
def validate_swapped(spark, sf):
    """A file with the columns the wrong way round and some prices that are no numbers."""
    price = F.when(F.col("sample_id") % 3 == 0, "n/a").otherwise(F.col("price").cast("string"))
    path = new_table_path(spark, "submission")
    catalog(spark, sf).select(price.alias("price"), F.col("sample_id").cast("string").alias("sample_id")).write.option("header", True).csv(path)
    return validate_path(spark, path)


@query("submission_stats", f"""
WITH {Q.LINE} SELECT count(*) AS count, round(avg(price), 4) AS mean_price, round(min(price), 8) AS min_price, round(max(price), 8) AS max_price FROM line""")
def stats(spark, sf):
    s = submission_stats(catalog_line(spark, sf)).withColumns({c: F.round(c, 8) for c in ("min_price", "max_price")})
    return rounded(s, ["count", "min_price", "max_price"], ["mean_price"], 4)
