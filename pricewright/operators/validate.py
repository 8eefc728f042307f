"""Checks of a submission: one aggregate pass, one row per check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewright.sources.submission import exists, read_submission

COLUMNS = ["sample_id", "price"]


def validate_submission(df: DataFrame) -> DataFrame:
    """(check, passed, violations) for columns, type, positivity, missing values and repeated ids.

    A price given as text, as in a file, is numeric if every text that is there parses as a number.  NaN is missing
    like NULL, in any column of floating-point numbers or texts that hold one.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    if "price" in kinds:
        price = F.col("price").try_cast("double")
        unread = F.count_if(F.col("price").isNotNull() & price.isNull())
        not_numeric = unread if isinstance(kinds["price"], (T.NumericType, T.StringType)) else F.lit(1)
    else:
        price, not_numeric = F.lit(None).cast("double"), F.lit(1)
    positive = F.coalesce((price > 0) & ~F.isnan(price), F.lit(False))

    def absent(column: str):
        real = isinstance(kinds[column], (T.DoubleType, T.FloatType, T.StringType))
        nan = F.coalesce(F.isnan(F.col(column).try_cast("double")), F.lit(False)) if real else F.lit(False)
        return F.col(column).isNull() | nan

    missing = sum((F.count_if(absent(c)) for c in df.columns), F.lit(0))
    repeats = F.count("sample_id") - F.count_distinct("sample_id") if "sample_id" in kinds else F.lit(0)
    null_ids = F.greatest(F.count_if(F.col("sample_id").isNull()) - 1, F.lit(0)) if "sample_id" in kinds else F.lit(0)
    counted = df.agg(
        not_numeric.alias("not_numeric"), F.count_if(~positive).alias("not_positive"), missing.alias("missing"),
        (repeats + null_ids).alias("duplicates")
    )
    checks = [
        ("correct_columns", F.lit(0 if list(df.columns) == COLUMNS else 1)),
        ("price_numeric", F.col("not_numeric")),
        ("prices_positive", F.col("not_positive")),
        ("no_missing_values", F.col("missing")),
        ("no_duplicate_ids", F.col("duplicates")),
    ]
    rows = F.array(*[F.struct(F.lit(n).alias("check"), v.cast("bigint").alias("violations")) for n, v in checks])
    return counted.select(F.inline(rows)).select("check", (F.col("violations") == 0).alias("passed"), "violations")


def validate_path(spark: SparkSession, path: str) -> DataFrame:
    """The checks of a written submission, with ``file_exists`` first; without a file that is the only row."""
    there = exists(spark, path)
    first = spark.range(1).select(
        F.lit("file_exists").alias("check"), F.lit(there).alias("passed"), F.lit(0 if there else 1).cast("bigint").alias("violations"))
    return first.unionByName(validate_submission(read_submission(spark, path))) if there else first


def is_valid(df: DataFrame) -> bool:
    return not validate_submission(df).where("NOT passed").take(1)


def submission_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("count"), F.avg("price").alias("mean_price"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
    )
