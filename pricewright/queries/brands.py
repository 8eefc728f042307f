"""Brand statistics, frequencies, codes and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.operators import brands as B
from pricewright.operators.folds import add_fold
from pricewright.operators.outliers import PriceBounds
from pricewright.operators.parse import parse_labelled
from pricewright.queries import sql as Q
from pricewright.queries.evaluation import round_metrics
from pricewright.queries.numbers import LINE_KEY, rounded
from pricewright.queries.registry import query
from pricewright.functions import metrics as M
from pricewright.session import materialise
from pricewright.sources.tables import catalog, catalog_line

_KEY = ", ".join(LINE_KEY)
_STATS = """SELECT brand, avg(price) AS brand_mean, median(price) AS brand_median, coalesce(stddev_samp(price), 0) AS brand_std,
  count(price) AS brand_count FROM {rows} GROUP BY brand"""


@query("brand_stats", f"""
WITH {Q.LINE}, s AS ({_STATS.format(rows='line')})
SELECT brand, round(brand_mean, 4) AS brand_mean, round(brand_median, 8) AS brand_median, round(brand_std, 4) AS brand_std, brand_count FROM s""")
def brand_stats(spark, sf):
    stats = B.brand_stats(catalog_line(spark, sf)).withColumn("brand_median", F.round("brand_median", 8))
    return rounded(stats, ["brand", "brand_count", "brand_median"], ["brand_mean", "brand_std"], 4)


@query("brand_median_smape", f"""
WITH {Q.LABELLED}, b AS (SELECT quantile_cont(price, 0.005) AS lo, quantile_cont(price, 0.995) AS hi FROM parsed),
kept AS (SELECT p.* FROM parsed p, b WHERE price BETWEEN lo AND hi),
s AS ({_STATS.format(rows='kept')})
SELECT kept.brand, count(*) AS n, {Q.metrics('price', 'brand_median', 4)} FROM kept JOIN s USING (brand) GROUP BY kept.brand""")
def brand_median_smape(spark, sf):
    """From raw catalog text to the error of the brand median, by brand: scan, parse, filter, statistics, join, metric."""
    rows = catalog(spark, sf)
    kept = materialise(parse_labelled(PriceBounds.fit(rows).transform(rows)).select("sample_id", "brand", "price"), "kept")
    priced = B.BrandStats.fit(kept).transform(kept)
    y, p = F.col("price"), F.col("brand_median")
    return round_metrics(priced.groupBy("brand").agg(F.count(F.lit(1)).alias("n"), *M.all_metrics(y, p)))


def _split(spark, sf):
    """Catalog rows whose brand is the whole item name, so that some brands occur in the test part only."""
    rows = add_fold(parse_labelled(catalog(spark, sf)), 5).withColumn("brand", F.col("item_name"))
    rows = rows.select("sample_id", "brand", "price", "fold")
    return rows.where("fold <> 0"), rows.where("fold = 0").drop("price")


_SPLIT = f"""{Q.LABELLED}, named AS (SELECT sample_id, item_name AS brand, price, {Q.fold('sample_id', 5)} AS fold FROM parsed),
train AS (SELECT * FROM named WHERE fold <> 0), test AS (SELECT sample_id, brand, fold FROM named WHERE fold = 0)"""


@query("brand_features", f"""
WITH {_SPLIT}, s AS ({_STATS.format(rows='train')}), d AS (SELECT avg(price) AS d FROM train),
joined AS (
  SELECT 'train' AS part, sample_id, t.brand, coalesce(brand_mean, d) AS m, coalesce(brand_median, d) AS md, coalesce(brand_count, 0) AS c
  FROM train t LEFT JOIN s ON t.brand = s.brand, d
  UNION ALL SELECT 'test', sample_id, t.brand, coalesce(brand_mean, 50), coalesce(brand_median, 50), coalesce(brand_count, 0)
  FROM test t LEFT JOIN s ON t.brand = s.brand)
SELECT part, sample_id, brand, c AS brand_count, round(m, 8) AS brand_mean, round(md, 8) AS brand_median, round(ln(1 + c), 6) AS brand_popularity FROM joined""")
def brand_features(spark, sf):
    """Statistics of training brands on both parts; unseen brands get the default."""
    train, test = _split(spark, sf)
    model = B.BrandStats.fit(train)
    parts = [model.transform(df).withColumn("part", F.lit(name)) for name, df in (("train", train), ("test", test))]
    both = parts[0].drop("price", "fold").unionByName(parts[1].drop("fold"))
    return both.select("part", "sample_id", "brand", "brand_count", F.round("brand_mean", 8).alias("brand_mean"),
                       F.round("brand_median", 8).alias("brand_median"), F.round("brand_popularity", 6).alias("brand_popularity"))


@query("brand_frequency", f"WITH {Q.LINE} SELECT brand, count(*) AS brand_frequency FROM line GROUP BY brand")
def brand_frequency(spark, sf):
    return B.brand_frequency(catalog_line(spark, sf))


@query("brand_frequency_map", f"""
WITH {_SPLIT}, f AS (SELECT brand, count(*) AS c FROM train GROUP BY brand)
SELECT sample_id, t.brand, coalesce(c, 0) AS brand_frequency FROM test t LEFT JOIN f ON t.brand = f.brand""")
def brand_frequency_map(spark, sf):
    train, test = _split(spark, sf)
    return B.add_brand_frequency(test, train).select("sample_id", "brand", "brand_frequency")


_CODES = """codes AS (SELECT brand, row_number() OVER (ORDER BY brand) - 1 AS code FROM (
  SELECT brand FROM train UNION SELECT 'unknown' AS brand))"""


@query("label_encode", f"""
WITH {_SPLIT}, {_CODES}, rows AS (SELECT sample_id, brand FROM train UNION ALL SELECT sample_id, brand FROM test)
SELECT sample_id, r.brand, coalesce(c.brand, 'unknown') AS brand_filled,
  coalesce(c.code, (SELECT code FROM codes WHERE brand = 'unknown')) AS brand_encoded
FROM rows r LEFT JOIN codes c ON r.brand = c.brand""")
def label_encode(spark, sf):
    train, test = _split(spark, sf)
    rows = train.select("sample_id", "brand").unionByName(test.select("sample_id", "brand"))
    return B.BrandCodes.fit(train).transform(rows).select("sample_id", "brand", "brand_filled", "brand_encoded")


@query("unknown_brands", f"""
WITH {_SPLIT}, {_CODES}
SELECT brand, count(*) AS n_rows FROM test WHERE brand NOT IN (SELECT brand FROM codes) GROUP BY brand""")
def unknown_brands(spark, sf):
    train, test = _split(spark, sf)
    return B.BrandCodes.fit(train).unknown_brands(test)


@query("kfold_assign", f"WITH {Q.LINE} SELECT {_KEY}, {Q.fold('l_orderkey', 3)} AS fold_of_3, {Q.fold('l_orderkey', 5)} AS fold_of_5 FROM line")
def kfold_assign(spark, sf):
    rows = add_fold(catalog_line(spark, sf), 3, "l_orderkey", "fold_of_3")
    return add_fold(rows, 5, "l_orderkey", "fold_of_5").select(*LINE_KEY, "fold_of_3", "fold_of_5")


OOF_SQL = f"""{Q.LINE}, folded AS (SELECT *, {Q.fold('l_orderkey', 3)} AS fold FROM line),
cell AS (SELECT brand, fold, count(price) AS n, sum(price) AS s FROM folded GROUP BY brand, fold),
others AS (SELECT c.brand, c.fold, sum(o.s) / sum(o.n) AS oof_brand_mean FROM cell c JOIN cell o ON c.brand = o.brand AND c.fold <> o.fold GROUP BY c.brand, c.fold),
level AS (SELECT c.fold, sum(o.s) / sum(o.n) AS oof_mean FROM (SELECT DISTINCT fold FROM cell) c JOIN cell o ON c.fold <> o.fold GROUP BY c.fold),
oof AS (SELECT f.*, coalesce(oof_brand_mean, oof_mean) AS oof_brand_mean, oof_mean FROM folded f
  LEFT JOIN others o ON f.brand = o.brand AND f.fold = o.fold JOIN level l ON f.fold = l.fold)"""


def out_of_fold_means(spark, sf):
    """Each row with the mean price of its brand, and of all rows, over the other folds."""
    rows = add_fold(catalog_line(spark, sf), 3, "l_orderkey")
    return B.out_of_fold_brand_mean(rows)


@query("oof_matrix", f"WITH {OOF_SQL} SELECT {_KEY}, fold, round(oof_brand_mean, 4) AS oof_brand_mean, round(oof_mean, 4) AS oof_mean FROM oof")
def oof_matrix(spark, sf):
    return rounded(out_of_fold_means(spark, sf), [*LINE_KEY, "fold"], ["oof_brand_mean", "oof_mean"], 4)
