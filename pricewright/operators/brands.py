"""Brand statistics, frequencies and codes, each as a fit that writes a table and a transform that joins it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright import fixed
from pricewright.operators.lookup import attach, table_bytes
from pricewright.operators.quantiles import exact_quantiles
from pricewright.operators.ranking import number_sorted
from pricewright.session import materialise

UNKNOWN = "unknown"


def brand_stats(df: DataFrame, brand: str = "brand", price: str = "price") -> DataFrame:
    """Mean, median, sample std (0 for a single row) and count of the price of each brand."""
    named = df.select(F.coalesce(F.col(brand), F.lit(UNKNOWN)).alias("brand"), F.nanvl(F.col(price), F.lit(None)).alias("price"))
    named = materialise(named, "brand-prices")  # two narrow columns, read once for the sums and twice for the medians
    sums = named.groupBy("brand").agg(
        F.avg("price").alias("brand_mean"),
        F.coalesce(F.stddev_samp("price"), F.lit(0.0)).alias("brand_std"),
        F.count("price").alias("brand_count"),
    )
    medians = exact_quantiles(named, "price", [0.5], by=["brand"])
    medians = medians.select("brand", F.col("quantiles")[0].alias("brand_median"))
    return sums.join(medians, "brand", "left").select("brand", "brand_mean", "brand_median", "brand_std", "brand_count")


@dataclass
class BrandStats:
    """Target statistics by brand, fitted on training rows."""

    table: DataFrame
    size_bytes: int

    @staticmethod
    def fit(df: DataFrame) -> "BrandStats":
        table = materialise(brand_stats(df), "brand-stats")
        return BrandStats(table, table_bytes(table, "brand"))

    def transform(self, df: DataFrame, default_price: float | None = None) -> DataFrame:
        """Join mean, median and count; a brand not seen in training gets the default price and count 0.

        The default is the mean price of ``df`` when it has prices, else a constant.
        """
        if default_price is None:
            default_price = fixed.UNSEEN_BRAND_PRICE
            if "price" in df.columns:
                default_price = df.agg(F.avg(F.nanvl("price", F.lit(None)))).first()[0]
        df = df.withColumn("brand", F.coalesce("brand", F.lit(UNKNOWN)))
        joined = attach(df, self.table.drop("brand_std"), "brand", dim_bytes=self.size_bytes)
        default = F.lit(default_price).cast("double")
        joined = joined.withColumns({
            "brand_mean": F.coalesce("brand_mean", default),
            "brand_median": F.coalesce("brand_median", default),
            "brand_count": F.coalesce("brand_count", F.lit(0)),
        })
        return joined.withColumn("brand_popularity", F.log1p("brand_count"))

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BrandStats":
        table = spark.read.parquet(path)
        return BrandStats(table, table_bytes(table, "brand"))


def brand_frequency(df: DataFrame, brand: str = "brand") -> DataFrame:
    return df.groupBy(brand).agg(F.count(F.lit(1)).alias("brand_frequency"))


def frequency_table(df: DataFrame) -> DataFrame:
    return materialise(brand_frequency(df).where("brand IS NOT NULL"), "brand-frequency")


def add_brand_frequency(df: DataFrame, fitted_on: DataFrame | None = None, table: DataFrame | None = None) -> DataFrame:
    """Rows of ``fitted_on`` (default: this frame) with the same brand, or those a ``table`` says; 0 for a missing brand."""
    if table is None:
        table = frequency_table(df if fitted_on is None else fitted_on)
    joined = attach(df, table, "brand")
    return joined.withColumn("brand_frequency", F.coalesce("brand_frequency", F.lit(0)))


@dataclass
class BrandCodes:
    """Rank of a brand among the sorted training brands plus 'unknown'."""

    table: DataFrame  # brand, brand_code
    unknown_code: int
    size_bytes: int

    @staticmethod
    def fit(df: DataFrame) -> "BrandCodes":
        brands = df.select(F.coalesce("brand", F.lit(UNKNOWN)).alias("brand"))
        extra = df.sparkSession.range(1).select(F.lit(UNKNOWN).alias("brand"))
        table = materialise(number_sorted(brands.distinct().union(extra).distinct(), "brand", "brand_code"), "brand-codes")
        unknown = table.where(F.col("brand") == UNKNOWN).first()["brand_code"]
        return BrandCodes(table, int(unknown), table_bytes(table, "brand"))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``brand_encoded``; an unseen brand gets the code of 'unknown'."""
        named = df.withColumn("brand_filled", F.coalesce("brand", F.lit(UNKNOWN)))
        codes = self.table.select(F.col("brand").alias("brand_filled"), "brand_code")
        joined = attach(named, codes, "brand_filled", dim_bytes=self.size_bytes)
        seen = F.col("brand_code").isNotNull()
        return joined.withColumns({
            "brand_filled": F.when(seen, F.col("brand_filled")).otherwise(F.lit(UNKNOWN)),
            "brand_encoded": F.coalesce("brand_code", F.lit(self.unknown_code).cast("bigint")),
        }).drop("brand_code")

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BrandCodes":
        table = spark.read.parquet(path)
        unknown = table.where(F.col("brand") == UNKNOWN).first()["brand_code"]
        return BrandCodes(table, int(unknown), table_bytes(table, "brand"))

    def unknown_brands(self, df: DataFrame) -> DataFrame:
        """Distinct brands of ``df`` that have no code, with their number of rows."""
        counts = df.groupBy(F.coalesce("brand", F.lit(UNKNOWN)).alias("brand")).agg(F.count(F.lit(1)).alias("n_rows"))
        return counts.join(self.table, "brand", "left_anti")


def out_of_fold_brand_mean(df: DataFrame, fold: str = "fold") -> DataFrame:
    """Brand mean that leaves out a row's own fold, and the mean of all other folds, without any fit per fold.

    Sums by brand and fold are enough: the other folds are the brand's total minus its own fold.  A brand
    with no price elsewhere gets the mean of the other folds.
    """
    price = F.nanvl(F.col("price"), F.lit(None))
    cells = materialise(
        df.groupBy(F.coalesce("brand", F.lit(UNKNOWN)).alias("brand"), fold).agg(F.count(price).alias("n"), F.sum(price).alias("s")),
        "brand-folds",
    )
    by_fold = {r[fold]: (r["n"], r["s"] or 0.0) for r in cells.groupBy(fold).agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()}
    n_all, s_all = sum(n for n, _ in by_fold.values()), sum(s for _, s in by_fold.values())
    level = F.create_map(*[
        x for i, (n, s) in by_fold.items()
        for x in (F.lit(i), F.lit((s_all - s) / (n_all - n) if n_all > n else None).cast("double"))
    ])
    totals = cells.groupBy("brand").agg(F.sum("n").alias("n_all"), F.sum("s").alias("s_all"))
    means = cells.join(totals, "brand").select(
        F.concat_ws("\u0001", F.col(fold).cast("string"), "brand").alias("_cell"),
        F.try_divide(F.col("s_all") - F.coalesce("s", F.lit(0.0)), F.col("n_all") - F.col("n")).alias("_mean"),
    )
    named = df.withColumn("brand", F.coalesce("brand", F.lit(UNKNOWN)))
    named = named.withColumn("_cell", F.concat_ws("\u0001", F.col(fold).cast("string"), "brand"))
    joined = attach(named, materialise(means, "brand-fold-means"), "_cell")
    out = joined.withColumn("oof_mean", level[F.col(fold)])
    return out.withColumn("oof_brand_mean", F.coalesce("_mean", "oof_mean")).drop("_mean", "_cell")
