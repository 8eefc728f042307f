"""Mutual information by nearest neighbours against all pairs of rows."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pricewright.operators import information as I


def harmonic(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def plain(x, y, k):
    d = np.maximum(np.abs(x[:, None] - x), np.abs(y[:, None] - y))
    np.fill_diagonal(d, np.iinfo(np.int64).max)
    r = np.sort(d, axis=1)[:, k - 1]
    r = np.maximum(r, 1)
    nx = (np.abs(x[:, None] - x) < r[:, None]).sum(axis=1) - 1
    ny = (np.abs(y[:, None] - y) < r[:, None]).sum(axis=1) - 1
    return r, nx, ny, max(0.0, harmonic(len(x)) + harmonic(k) - np.mean([harmonic(a + 1) + harmonic(b + 1) for a, b in zip(nx, ny)]))


def test_digamma(spark):
    got = [r[0] for r in spark.range(1, 200).select(I.digamma(F.col("id"))).collect()]
    np.testing.assert_allclose(got, [harmonic(n) for n in range(1, 200)], atol=1e-12)


@pytest.mark.parametrize("cell, k", [(512, 3), (16, 3), (5, 1), (4, 6)])
def test_equals_all_pairs(spark, monkeypatch, cell, k):
    """Continuous, discrete, constant and far-out values, in one cell and in many small ones."""
    monkeypatch.setattr(I, "CELL", cell)
    rng = np.random.default_rng(cell)
    n = 240
    y = np.r_[rng.normal(size=n - 2), 50.0, -90.0]
    table = {"near": y + rng.normal(size=n) * 0.1, "steps": np.floor(y * 2), "none": rng.integers(0, 3, n), "flat": np.ones(n), "skewed": np.exp(3 * rng.normal(size=n))}
    rows = spark.createDataFrame([(i, float(y[i]), *(float(v[i]) for v in table.values())) for i in range(n)], ["sample_id", "y", *table]).repartition(3)
    points = I._points(rows, list(table), "y", "sample_id").toPandas()
    got = {r["feature"]: r["score"] for r in I.neighbour_information(rows, list(table), "y", k=k).collect()}
    for f, name in enumerate(table):
        own = points[points.f == f].sort_values("id")
        x, t = own.x.to_numpy(), own.y.to_numpy()
        assert len(set(x)) > 0.95 * n  # equal values are told apart
        assert got[name] == pytest.approx(plain(x, t, k)[3], abs=1e-9), name
    assert got["near"] > 1 and got["flat"] < 0.2


def test_missing_values_vectors_and_few_rows(spark):
    rng = np.random.default_rng(3)
    y = rng.normal(size=60)
    rows = [(i, float(y[i]) if i % 7 else None, float(y[i] + 0.1 * rng.normal()) if i % 5 else float("nan"), float(i) if i < 3 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "sample_id int, y double, a double, b double")
    got = {r["feature"]: r["score"] for r in I.neighbour_information(df, ["a", "b"], "y").collect()}
    known = df.where("y IS NOT NULL AND NOT isnan(a)")
    alone = I.neighbour_information(known, ["a"], "y").first()["score"]
    assert got["b"] == 0.0 and got["a"] == pytest.approx(alone, abs=1e-9) and alone > 0.5
    vectors = spark.createDataFrame([(i, float(y[i]), Vectors.dense([float(y[i]), float(i % 4)])) for i in range(60)], ["sample_id", "y", "v"])
    by_place = {r["feature"]: r["score"] for r in I.neighbour_information(vectors, "v", "y").collect()}
    assert set(by_place) == {"0", "1"} and by_place["0"] > by_place["1"]
    assert [r["score"] for r in I.neighbour_information(df.limit(0), ["a"], "y").collect()] == [0.0]
