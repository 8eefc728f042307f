"""Boosted trees against a plain version that scores every split of every node."""

import heapq
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pricewright.operators import boosting as B
from pricewright.operators.boosting import BoostedTrees, BoostedTreesModel, stops
from pricewright.operators.folds import fold_of
from pricewright.operators.quantiles import sketched_quantiles


def plain_tree(x, g, p):
    """Node dicts of one tree: splits found by looking at all values of all features."""
    def score(rows):
        total = g[rows].sum()
        return (np.sign(total) * max(abs(total) - p["alpha"], 0)) ** 2 / (len(rows) + p["lam"])

    def split(rows, depth):
        if p["depth"] and depth >= p["depth"]:
            return None
        best = None
        for j in range(x.shape[1]):
            for v in np.unique(x[rows, j])[:-1]:
                left, right = rows[x[rows, j] <= v], rows[x[rows, j] > v]
                if min(len(left), len(right)) < p["least"]:
                    continue
                gain = score(left) + score(right) - score(rows)
                if gain > 1e-9 and gain >= p["gamma"] and (best is None or gain > best[0] + 1e-9):
                    best = (gain, j, v, left, right)
        return best

    leaves, heap, values = 1, [], np.zeros(len(g))

    def add(rows, depth, path):
        s = split(rows, depth)
        total = g[rows].sum()
        values[rows] = -np.sign(total) * max(abs(total) - p["alpha"], 0) / (len(rows) + p["lam"])
        if s:
            heapq.heappush(heap, (-s[0], path, depth, s))

    add(np.arange(len(g)), 0, 1)
    while heap and leaves < (p["leaves"] or math.inf):
        _, path, depth, (_, _, _, left, right) = heapq.heappop(heap)
        leaves += 1
        add(left, depth + 1, 2 * path)
        add(right, depth + 1, 2 * path + 1)
    return values, leaves


def plain_boosting(x, y, p, rounds, step):
    base = y.mean()
    out, counts = np.full(len(y), base), []
    for _ in range(rounds):
        values, leaves = plain_tree(x, out - y, p)
        out = out + step * values
        counts.append(leaves)
    return out, counts


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    n = 400
    x = np.c_[rng.integers(0, 12, n), rng.normal(size=n).round(1), rng.integers(0, 3, n)].astype(float)
    y = x[:, 0] ** 1.5 + 5 * np.sin(x[:, 1] * 2) + x[:, 2] * 3 + rng.normal(size=n)
    rows = [(i, float(y[i]), Vectors.dense(x[i])) for i in range(n)]
    return x, y, spark.createDataFrame(rows, ["sample_id", "price", "features"]).repartition(3).cache()


def predictions(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("sample_id").collect()])


@pytest.mark.parametrize("plain, settings", [
    (dict(alpha=0.5, lam=0.7, gamma=2.0, least=5, depth=3, leaves=0), dict(growth="level", maxDepth=3, regAlpha=0.5, regLambda=0.7, gamma=2.0, minChildWeight=5.0)),
    (dict(alpha=0.0, lam=0.0, gamma=0.0, least=1, depth=2, leaves=0), dict(growth="level", maxDepth=2)),
    (dict(alpha=0.5, lam=0.5, gamma=0.0, least=4, depth=0, leaves=7), dict(growth="leaf", numLeaves=7, maxDepth=0, regAlpha=0.5, regLambda=0.5, minChildRows=4)),
    (dict(alpha=0.0, lam=1.0, gamma=0.0, least=4, depth=3, leaves=6), dict(growth="leaf", numLeaves=6, maxDepth=3, regLambda=1.0, minChildRows=4)),
])
def test_equals_the_plain_version(data, monkeypatch, plain, settings):
    monkeypatch.setattr(B, "REWRITE", 2)  # predictions are written meanwhile
    monkeypatch.setattr(B, "CELLS", 300)  # and nodes counted one at a time
    x, y, df = data
    model = BoostedTrees(labelCol="price", maxIter=3, stepSize=0.4, **settings).fit(df)
    want, leaves = plain_boosting(x, y, plain, 3, 0.4)
    np.testing.assert_allclose(predictions(model, df), want, atol=1e-6)
    assert [sum(f < 0 for f in t.feature) for t in model.trees] == leaves
    if plain["leaves"]:
        assert max(leaves) == plain["leaves"]


def test_patience_keeps_what_the_rule_says(data):
    x, y, df = data
    settings = dict(labelCol="price", maxDepth=2, stepSize=0.5, tolerance=0.4, seed=3)
    model = BoostedTrees(maxIter=40, patience=3, **settings).fit(df)
    kept = len(model.trees)
    held = np.array([r["h"] for r in df.orderBy("sample_id").select((fold_of(F.col("sample_id"), 10, seed="validation") == 0).alias("h")).collect()])
    p, losses = np.full(len(y), y[~held].mean()), []
    for _ in range(40):
        values, _ = plain_tree(x[~held], (p - y)[~held], dict(alpha=0, lam=0, gamma=0, least=1, depth=2, leaves=0))
        # values of held-out rows follow from the tree, found again through rows with the same path
        tree = model.trees[len(losses)] if len(losses) < kept else None
        if tree is None:
            break
        p = p + tree.arrays()[5][B._by_value(tree.arrays(), x)]
        assert np.allclose(0.5 * values, tree.arrays()[5][B._by_value(tree.arrays(), x[~held])], atol=1e-6)
        losses.append(((y - p)[held] ** 2).mean())
    assert np.allclose(losses, model.losses) and kept < 40
    history, stop = [math.inf] * 3, None
    for i, loss in enumerate(losses):
        if any(loss + 0.4 < h for h in history):
            history[i % 3] = loss
        else:
            stop = i + 1
            break
    assert stop == kept
    assert model.evaluateEachIteration(df.where(fold_of(F.col("sample_id"), 10, seed="validation") == 0)) == pytest.approx(losses)


def test_stop_rule():
    assert not stops([5, 4, 3], 3, 0.1) and stops([5, 5, 5, 5], 3, 0.1) and not stops([9, 5, 5, 5], 3, 0.1) and not stops([1, 1, 1, 1], 0, 0.1)


def test_draws_are_repeatable_and_partial(data):
    _, y, df = data
    settings = dict(labelCol="price", maxIter=4, maxDepth=2, subsample=0.5, featuresPerTree=0.5, featuresPerNode="sqrt", seed=5)
    one, two = (BoostedTrees(**settings).fit(d) for d in (df, df.repartition(7)))
    assert [t.feature for t in one.trees] == [t.feature for t in two.trees] and np.allclose(predictions(one, df), predictions(two, df))
    assert all(120 < t.rows[0] < 280 for t in one.trees) and len({t.rows[0] for t in one.trees}) > 1
    assert sum(one.featureImportances.toArray()) == pytest.approx(1)


def test_pipeline_round_trip_and_schema(spark, data, tmp_path):
    x, y, _ = data
    raw = spark.createDataFrame([(i, float(y[i]), *map(float, x[i])) for i in range(len(y))], "sample_id int, price double, a double, b double, c double")
    stages = [VectorAssembler(inputCols=["a", "b", "c"], outputCol="v"), BoostedTrees(featuresCol="v", labelCol="price", maxIter=2, maxDepth=2, predictionCol="p")]
    fitted = Pipeline(stages=stages).fit(raw)
    fitted.write().overwrite().save(str(tmp_path / "pipeline"))
    again = PipelineModel.load(str(tmp_path / "pipeline"))
    assert isinstance(again.stages[1], BoostedTreesModel) and again.stages[1].getPredictionCol() == "p"
    both = fitted.transform(raw).join(again.transform(raw).select("sample_id", F.col("p").alias("q")), "sample_id")
    assert both.where("p = q").count() == len(y)
    saved = BoostedTrees(maxIter=7, growth="leaf", numLeaves=3)
    saved.write().overwrite().save(str(tmp_path / "estimator"))
    assert BoostedTrees.load(str(tmp_path / "estimator")).setting("maxIter") == 7
    with pytest.raises(TypeError):
        BoostedTrees(featuresCol="a", labelCol="price").fit(raw)
    with pytest.raises(ValueError):
        BoostedTrees(featuresCol="v", labelCol="price", growth="leaf").fit(stages[0].transform(raw))


def test_missing_values_many_values_and_empty(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=3000)
    x[::10] = np.nan
    y = np.where(np.isnan(x), -3.0, np.round(x))
    df = spark.createDataFrame([(i, float(y[i]) if i % 50 else None, Vectors.dense([float(x[i])])) for i in range(3000)], ["sample_id", "price", "features"])
    model = BoostedTrees(labelCol="price", maxIter=6, maxDepth=5, stepSize=0.9, maxBins=64).fit(df)
    rows = model.transform(df).where("price IS NOT NULL").select("price", "prediction").toPandas()
    assert np.mean(np.abs(rows.price - rows.prediction)) < 0.1 and max(len(t.feature) for t in model.trees) > 8
    with pytest.raises(ValueError):
        BoostedTrees(labelCol="price").fit(df.limit(0))
    flat = BoostedTrees(labelCol="price", maxIter=2).fit(df.withColumn("price", F.lit(2.0)))
    assert all(len(t.feature) == 1 for t in flat.trees) and predictions(flat, df.limit(3)).tolist() == [2.0] * 3


def test_sketched_quantiles_stay_within_their_rank_error(spark):
    rng = np.random.default_rng(2)
    values = np.r_[rng.lognormal(size=30_000), np.full(15_000, 1.0)]
    rows = spark.createDataFrame([("a" if i % 10 else "b", float(v)) for i, v in enumerate(values)] + [("c", None), ("a", float("nan"))], "g string, v double").repartition(6)
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r for r in sketched_quantiles(rows, "v", shares, ["g"], accuracy=100).collect()}
    assert set(got) == {"a", "b"}
    for g, r in got.items():
        own = np.sort(values[[("a" if i % 10 else "b") == g for i in range(len(values))]])
        assert r["n"] == len(own)
        for p, q in zip(shares, r["quantiles"]):
            low, high = np.searchsorted(own, q, "left"), np.searchsorted(own, q, "right")
            assert q in own and low - len(own) / 100 - 1 <= p * len(own) <= high + len(own) / 100 + 1
    whole = sketched_quantiles(rows, "v", [0.5]).first()
    assert abs(np.searchsorted(np.sort(values), whole["quantiles"][0]) - len(values) / 2) < 15_002


@pytest.mark.parametrize("settings", [
    dict(growth="level", maxDepth=4, subsample=0.7, featuresPerTree=0.7, regAlpha=0.1, regLambda=0.1, minChildWeight=2.0),
    dict(growth="leaf", numLeaves=9, maxDepth=5, featuresPerTree=0.7, minChildRows=3),
    dict(growth="level", maxDepth=3, subsample=0.8, featuresPerNode="sqrt", minSplitRows=5, patience=4, tolerance=0.05),
])
def test_one_task_grows_the_trees_that_jobs_grow(data, monkeypatch, settings):
    """More rounds than are written at once, and counted a few rows at a time, by the default and by jobs."""
    _, y, df = data
    estimator = BoostedTrees(labelCol="price", maxIter=11, stepSize=0.3, **settings)
    inside = estimator.fit(df)
    monkeypatch.setattr(B, "LOCAL_BYTES", 0)
    jobs = estimator.fit(df)
    assert inside.trees == jobs.trees and len(inside.trees) > 3 and inside.losses == pytest.approx(jobs.losses)
