"""Joins, numbering, sources: the large-table way gives what the small-table way gives."""

import pytest
from pyspark.sql import functions as F

from pricewright.operators import quantiles
from pricewright.operators.brands import BrandCodes, BrandStats, add_brand_frequency
from pricewright.operators.lookup import attach, hot_keys
from pricewright.operators.ranking import number_sorted
from pricewright.operators.validate import validate_path
from pricewright.session import materialise
from pricewright.sources.catalog import read_catalog, read_split, split_paths, unpriced_schema, write_catalog
from pricewright.sources.submission import read_submission, write_submission
from pricewright.sources.tables import catalog


@pytest.fixture(scope="module")
def skewed(spark):
    """One brand holds more than a third of the rows, one is missing, one is unknown to the dimension."""
    brand = F.when(F.col("id") % 5 < 2, "hot").when(F.col("id") % 97 == 4, F.lit(None)).otherwise(F.concat(F.lit("b"), F.col("id") % 50))
    return spark.range(5000).select(F.col("id").alias("sample_id"), brand.alias("brand"), (F.col("id") * 1.5).alias("price"))


def test_large_dimension_joins_as_a_small_one(spark, skewed):
    dim = skewed.where("brand IS NOT NULL AND brand <> 'b13'").groupBy("brand").agg(F.count("*").alias("c"), F.max("price").alias("m"))
    small = attach(skewed, dim, "brand").select("sample_id", "brand", "c", "m")
    large = attach(skewed, dim, "brand", limit_bytes=0, share=0.05).select("sample_id", "brand", "c", "m")
    assert [r["brand"] for r in hot_keys(skewed, "brand", 0.05).collect()] == ["hot"]
    assert small.count() == large.count() == 5000
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_hot_key_missing_from_the_dimension(spark, skewed):
    dim = skewed.where("brand LIKE 'b%'").groupBy("brand").agg(F.count("*").alias("c"))
    large = attach(skewed, dim, "brand", limit_bytes=0, share=0.05)
    assert large.where("brand = 'hot' AND c IS NULL").count() == 2000
    assert large.where("brand = 'b7' AND c IS NULL").count() == 0


def test_numbering_over_partitions(spark):
    words = spark.range(3000).select(F.concat(F.lit("Wo"), F.col("id") * 7919 % 3001, F.lit("é")).alias("w"))
    one = number_sorted(words.coalesce(1), "w", "n")
    many = number_sorted(words.repartition(6), "w", "n")
    assert one.exceptAll(many).isEmpty() and many.count() == 3000
    assert [r["w"] for r in many.orderBy("n").collect()] == sorted(r["w"] for r in words.collect())


def test_codes_are_a_bijection_and_unseen_is_unknown(spark, skewed):
    codes = BrandCodes.fit(skewed)
    rows = codes.table.orderBy("brand_code").collect()
    assert [r["brand_code"] for r in rows] == list(range(len(rows)))
    assert [r["brand"] for r in rows] == sorted(r["brand"] for r in rows)
    fresh = spark.createDataFrame([(1, "never"), (2, None), (3, "hot")], "sample_id bigint, brand string")
    got = {r["sample_id"]: (r["brand_filled"], r["brand_encoded"]) for r in codes.transform(fresh).collect()}
    assert got[1] == got[2] == ("unknown", codes.unknown_code) and got[3][0] == "hot"


def test_brand_stats_default_and_reload(spark, skewed, tmp_path):
    stats = BrandStats.fit(skewed)
    fresh = spark.createDataFrame([(1, "never"), (2, "hot")], "sample_id bigint, brand string")
    stats.save(str(tmp_path / "stats"))
    for model in (stats, BrandStats.load(spark, str(tmp_path / "stats"))):
        got = {r["sample_id"]: r for r in model.transform(fresh).collect()}
        assert (got[1]["brand_mean"], got[1]["brand_count"], got[1]["brand_popularity"]) == (50.0, 0, 0.0)
        assert got[2]["brand_count"] == 2000
    counts = {r["brand"]: r["brand_frequency"] for r in add_brand_frequency(fresh, skewed).collect()}
    assert counts == {"never": 0, "hot": 2000}


def test_csv_keeps_line_ends_quotes_and_missing_values(spark, tmp_path):
    rows = [(1, 'Item Name: "A", b\nValue: 1\\', "http://x", 2.5), (2, "  spaced  ", None, None), (3, "c\r\nd", "y", 0.1)]
    df = spark.createDataFrame(rows, "sample_id bigint, catalog_content string, image_link string, price double")
    back = read_catalog(spark, write_catalog(df, str(tmp_path / "train")))
    got = {r["sample_id"]: r for r in back.collect()}
    assert len(got) == 3 and got[1]["catalog_content"] == rows[0][1] and got[2]["price"] is None
    assert got[2]["catalog_content"] == "  spaced  " and got[2]["image_link"] is None
    path = str(tmp_path / "test")
    assert read_catalog(spark, write_catalog(df.drop("price"), path), unpriced_schema()).count() == 3


def test_split_paths(spark, tmp_path):
    for name in ("Train_a.csv", "train_b.csv", "test.csv", "sample_test_out.csv", "train_test.csv.txt"):
        (tmp_path / name).write_text("sample_id\n1\n")
    found = split_paths(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in found["train"]] == ["Train_a.csv", "train_b.csv"]
    assert [p.rsplit("/", 1)[1] for p in found["test"]] == ["test.csv"]
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "train.csv").write_text("x\n")
    with pytest.raises(FileNotFoundError):
        split_paths(spark, str(tmp_path / "empty"))


def test_read_split(spark, tmp_path):
    (tmp_path / "train.csv").write_text('sample_id,catalog_content,image_link,price\n1,"a\nb",http://x,2.5\n2,"c ""d""",,NaN\n')
    (tmp_path / "train_2.csv").write_text("sample_id,catalog_content,image_link,price\n4,d,,1\n")
    (tmp_path / "train_3.csv").write_text("sample_id,catalog_content,image_link,price\n5,f,,2\n")
    (tmp_path / "test.csv").write_text("sample_id,catalog_content,image_link\n3,e,\n")
    train, test = read_split(spark, str(tmp_path))
    assert [tuple(r) for r in train.orderBy("sample_id").collect()] == [(1, "a\nb", "http://x", 2.5), (2, 'c "d"', None, None), (4, "d", None, 1.0), (5, "f", None, 2.0)]
    assert [tuple(r) for r in test.collect()] == [(3, "e", None)]


def test_submission_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (2, 3.0)], "sample_id bigint, price double")
    back = read_submission(spark, write_submission(df, str(tmp_path / "s"), single_file=True))
    assert back.columns == ["sample_id", "price"]
    assert back.selectExpr("cast(sample_id as bigint)", "cast(price as double)").exceptAll(df).isEmpty()


def checks(rows):
    return {r["check"]: r["violations"] for r in rows.collect()}


def test_submission_checks_by_path(spark, tmp_path):
    assert checks(validate_path(spark, str(tmp_path / "none"))) == {"file_exists": 1}
    (tmp_path / "swapped.csv").write_text("price,id\n2.5,1\nabc,2\n")
    assert checks(validate_path(spark, str(tmp_path / "swapped.csv"))) == {
        "file_exists": 0, "correct_columns": 1, "price_numeric": 1, "prices_positive": 1, "no_missing_values": 0, "no_duplicate_ids": 0}
    (tmp_path / "bad.csv").write_text("sample_id,price\n1,2.5\n1,NaN\n2,-1\n3,\n")
    assert checks(validate_path(spark, str(tmp_path / "bad.csv"))) == {
        "file_exists": 0, "correct_columns": 0, "price_numeric": 0, "prices_positive": 3, "no_missing_values": 2, "no_duplicate_ids": 1}


def test_hot_rows_are_not_shuffled(spark):
    """40 % of the rows share one brand and one price: no shuffle partition of the large way holds them."""
    hot = F.when(F.col("id") % 5 < 2, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 400))
    df = materialise(spark.range(20_000).select(hot.alias("brand"), F.when(F.col("id") % 5 < 2, 9.99).otherwise(F.col("id") * 0.01).alias("price")), "skewed")
    dim = df.groupBy("brand").agg(F.count("*").alias("c"))
    joined = attach(df, dim, "brand", limit_bytes=0, share=0.05)
    rest = df.join(F.broadcast(hot_keys(df, "brand", 0.05)), "brand", "left_anti")
    sizes = [r["n"] for r in rest.repartition(8, "brand").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
    assert joined.where("brand = 'hot' AND c = 8000").count() == 8000 and joined.count() == 20_000


def test_grouped_quantiles_with_a_hot_value(spark, monkeypatch):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 5 < 2, "hot").otherwise(F.concat(F.lit("b"), F.col("id") % 7)).alias("brand"),
        F.when(F.col("id") % 5 < 2, 9.99).otherwise(F.col("id") * 0.37 % 11).alias("price"))
    want = {r["brand"]: r["m"] for r in rows.groupBy("brand").agg(F.expr("percentile(price, 0.5)").alias("m")).collect()}
    for limit in (quantiles.BROADCAST_STEPS, 0):
        monkeypatch.setattr(quantiles, "BROADCAST_STEPS", limit)
        got = {r["brand"]: r["quantiles"][0] for r in quantiles.exact_quantiles(rows, "price", [0.5], by=["brand"]).collect()}
        assert got == pytest.approx(want)


def test_short_rows_are_dealt_over_tasks(spark, tmp_path):
    """A file of few bytes is one split; its rows are parsed in as many tasks as they are worth, a small file's in one."""
    assert spark.conf.get("spark.pricewright.scanTasks", None)
    spark.conf.unset("spark.pricewright.scanTasks")
    try:
        for n, least in ((40_000, 5), (100, 1)):
            folder = tmp_path / str(n)
            folder.mkdir()
            key = F.col("id").cast("long")
            rows = spark.range(n).select(
                key.alias("p_partkey"), F.lit("red box").alias("p_name"), F.lit("Brand#11").alias("p_brand"), F.lit("SMALL BOX").alias("p_type"),
                (key % 50).cast("int").alias("p_size"), F.lit(10.0).alias("p_retailprice"))
            rows.coalesce(1).write.parquet(str(folder / "part.parquet"))
            found = catalog(spark, str(folder))
            counts = [r["n"] for r in found.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
            assert sum(counts) == n and len(counts) >= least and max(counts) <= 8192 * 2
            assert found.select("sample_id").distinct().count() == n
    finally:
        spark.conf.set("spark.pricewright.scanTasks", "8")
