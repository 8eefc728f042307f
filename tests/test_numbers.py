import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricewright.functions import metrics as M
from pricewright.functions import numeric as N
from pricewright.operators import features as X
from pricewright.operators import quantiles
from pricewright.operators.evaluate import inverse_error_weights
from pricewright.operators.folds import add_fold
from pricewright.operators.quantiles import column_medians, exact_quantiles
from pricewright.operators.selection import f_regression
from pricewright.operators.validate import is_valid, validate_submission

PROBABILITIES = [0, 0.005, 0.25, 0.5, 0.75, 0.995, 1]
few = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(3)
    v = np.concatenate([
        rng.lognormal(3, 2, 2000), -rng.lognormal(0, 3, 1000), [0.0, -0.0, 1e300, -1e300, 5e-324, 1e-310],
        rng.integers(0, 40, 2000).astype(float), np.full(3000, 7.25), np.linspace(100, 100.0001, 2000),
    ])
    return pd.DataFrame({"g": rng.choice(["a", "b", None], len(v), p=[0.8, 0.15, 0.05]), "v": v})


@pytest.mark.parametrize("limit", [200_000, 0])
def test_quantiles_by_group(spark, values, limit, monkeypatch):
    """Both ways of finding the rows under a hit, broadcast and salted; a group without a name counts too."""
    monkeypatch.setattr(quantiles, "BROADCAST_STEPS", limit)
    df = spark.createDataFrame(values).repartition(5)
    got = exact_quantiles(df, "v", PROBABILITIES, by=["g"]).collect()
    assert len(got) == 3
    for r in got:
        part = values[values.g.isna()] if r["g"] is None else values[values.g == r["g"]]
        assert r["n"] == len(part)
        np.testing.assert_allclose(r["quantiles"], np.quantile(part.v, PROBABILITIES), rtol=1e-12)


def test_quantiles_overall_skip_missing(spark, values):
    extra = pd.DataFrame({"g": ["a"] * 3, "v": [np.nan, np.nan, None]})
    df = spark.createDataFrame(pd.concat([values, extra])).repartition(3)
    r = exact_quantiles(df, "v", PROBABILITIES).first()
    assert r["n"] == len(values)
    np.testing.assert_allclose(r["quantiles"], np.quantile(values.v, PROBABILITIES), rtol=1e-12)


@few
@given(st.lists(st.floats(allow_nan=False, width=64), min_size=1, max_size=40))
def test_median_of_any_doubles(spark, numbers):
    df = spark.createDataFrame([(x,) for x in numbers], "v double")
    got = exact_quantiles(df, "v", [0.5]).first()["quantiles"][0]
    s = sorted(numbers)
    low, high = s[(len(s) - 1) // 2], s[len(s) // 2]
    want = low if low == high else low * 0.5 + high * 0.5
    assert got == pytest.approx(want, nan_ok=True)


def test_column_medians_leave_out_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None, 3), (2.0, None, 9)], "a double, b double, c int")
    assert column_medians(df, ["a", "b", "c"]) == {"a": 1.5, "c": 6.0}


def test_all_missing_value_is_filled_with_zero_or_stays_missing(spark):
    df = spark.createDataFrame([(None, 2), (None, None)], "value double, pack_count bigint")
    assert [r["value_filled"] for r in X.labelled_value_features(df).collect()] == [0.0, 0.0]
    assert [r["value_log"] for r in X.detailed_value_features(df).collect()] == [None, None]


def test_postprocess(spark):
    raw = [float("nan"), None, float("inf"), float("-inf"), 0.125, 2.675, 9e9, -3.0]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(raw)], "i int, x double").orderBy("i")
    got = [r[0] for r in df.select(N.postprocess_price(F.col("x"), 0.01, 50000.0)).collect()]
    assert got == [0.01, 0.01, 50000.0, 0.01, 0.12, np.round(2.675, 2), 50000.0, 0.01]


@few
@given(st.lists(st.tuples(st.floats(0, 1e6), st.floats(-1e6, 1e6)), min_size=1, max_size=30))
def test_metrics_against_numpy(spark, pairs):
    y, p = (np.array(c) for c in zip(*pairs))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "y double, p double")
    got = df.agg(*M.all_metrics(F.col("y"), F.col("p"))).first()
    half = (np.abs(y) + np.abs(p)) / 2
    assert got["smape"] == pytest.approx(np.mean(np.abs(y - p) / np.where(half == 0, 1e-8, half)) * 100)
    assert 0 <= got["smape"] <= 200 + 1e-9
    assert got["rmse"] == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert got["std_prediction"] == pytest.approx(np.std(p), abs=1e-6)


def test_r2_of_a_flat_target_and_smape_of_nothing(spark):
    df = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, p double")
    assert df.agg(M.r2(F.col("y"), F.col("p"))).first()[0] == 1.0
    assert df.agg(M.r2(F.col("y"), F.col("p") + 1)).first()[0] == 0.0
    assert df.where("y > 5").agg(M.smape(F.col("y"), F.col("p"))).first()[0] == 0.0


def test_align_is_idempotent(spark):
    df = spark.createDataFrame([(1, 2.0, "x")], "sample_id int, a double, b string")
    once = X.align_zero_fill(df, ["c", "a"], ["sample_id"])
    assert once.columns == ["sample_id", "c", "a"] == X.align_zero_fill(once, ["c", "a"], ["sample_id"]).columns
    with pytest.raises(ValueError):
        X.check_same_features(["a", "b"], ["b", "a"])
    with pytest.raises(ValueError):
        X.check_same_features(["a", "b"], ["a"])


def test_folds_partition_the_keys_whatever_the_partitioning(spark):
    one, many = (add_fold(spark.range(500).withColumnRenamed("id", "sample_id").repartition(n), 5) for n in (1, 7))
    a, b = ({r["sample_id"]: r["fold"] for r in df.collect()} for df in (one, many))
    assert a == b and set(a.values()) == set(range(5))


def test_weights_sum_to_one_and_prefer_the_smaller_error(spark):
    scores = spark.createDataFrame([("a", 10.0), ("b", 40.0)], "model string, smape double")
    w = {r["model"]: r["weight"] for r in inverse_error_weights(scores).collect()}
    assert math.isclose(sum(w.values()), 1) and math.isclose(w["a"] / w["b"], 4, rel_tol=1e-6)


def test_validation(spark):
    good = spark.createDataFrame([(1, 2.0), (2, 3.0)], "sample_id bigint, price double")
    assert is_valid(good)
    bad = spark.createDataFrame([(1, None), (1, -1.0), (2, float("nan")), (None, 4.0), (None, 1.0)], "sample_id bigint, price double")
    got = {r["check"]: r["violations"] for r in validate_submission(bad).collect()}
    assert got == {"correct_columns": 0, "price_numeric": 0, "prices_positive": 3, "no_missing_values": 4, "no_duplicate_ids": 2}
    assert not is_valid(good.select("price", "sample_id"))
    assert not is_valid(good.withColumn("price", F.lit("x")))


def test_a_constant_is_told_however_it_is_split(spark):
    """A variance merged from partitions may be a little above zero; the score of a constant is NULL all the same."""
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 29, 196, 300):
        rows = [(1.0, float(rng.normal()), 0.1 * k) for k in range(n)]
        df = spark.createDataFrame(rows, "flat double, x double, y double")
        for parts in (1, 3, 4, 7, 16):
            split = df.repartition(parts)
            got = {r["feature"]: r["score"] for r in f_regression(split, ["flat", "x"], "y").collect()}
            assert got["flat"] is None
            assert {r["score"] for r in f_regression(split, ["x"], "flat").collect()} == {None}
            flat = split.agg(M.r2(F.col("flat"), F.col("x")).alias("r2"), M.r2(F.col("flat"), F.col("flat")).alias("same")).first()
            assert flat["r2"] == 0.0 and flat["same"] == 1.0


def test_f_score_counts_complete_pairs(spark):
    rows = [(1.0, 2.0), (2.0, None), (None, 3.0), (4.0, 1.0), (float("nan"), 9.0), (5.0, 7.5), (6.0, 3.0)]
    got = f_regression(spark.createDataFrame(rows, "x double, y double"), ["x"], "y").first()["score"]
    x, y = np.array([[a, b] for a, b in rows if a is not None and b is not None and a == a]).T
    r2 = np.corrcoef(x, y)[0, 1] ** 2
    assert got == pytest.approx(r2 / (1 - r2) * (len(x) - 2))
