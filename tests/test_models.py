"""Closed forms, reductions and ensembles against NumPy."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pricewright.operators import evaluate as E
from pricewright.operators.ensemble import BlendModel, StackModel, fit_blend, fit_stack, nested_cv
from pricewright.operators.folds import add_fold
from pricewright.operators.models import STACK_FULL, ModelSpec, apply_model, fit_model
from pricewright.operators.reduce import fit_projection, gram
from pricewright.operators.selection import best_features, f_regression, mutual_information
from pricewright.operators.vectorize import TextSettings, fit_tfidf
from pricewright.plans import stack
from pricewright.plans.common import with_vector
from pricewright.session import materialise, owned_tables
from pricewright.sources.submission import exists

FOREST = ModelSpec("rf", "forest", dict(numTrees=3, maxDepth=3))
BOOST = ModelSpec("gb", "boosting", dict(maxIter=3, maxDepth=2, validation=0.1, validationTol=1e-4))
RIDGE = ModelSpec("ridge", "ridge", dict(alpha=10.0))
ELASTIC = ModelSpec("enet", "elastic_net", dict(alpha=0.1, l1_ratio=0.5))


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3)) * [1, 5, 0.2]
    y = np.exp(2 + 0.3 * x[:, 0] - 0.05 * x[:, 1] + rng.normal(size=300) * 0.1)
    rows = [(i, float(y[i]), Vectors.dense(x[i])) for i in range(300)]
    return x, y, spark.createDataFrame(rows, ["sample_id", "price", "features"]).repartition(3).cache()


def test_ridge_is_the_closed_form(data):
    x, y, df = data
    model = fit_model(RIDGE, df, "price")
    xc, yc = x - x.mean(0), y - y.mean()
    np.testing.assert_allclose(model.coefficients.toArray(), np.linalg.solve(xc.T @ xc + 10 * np.eye(3), xc.T @ yc), rtol=1e-9)


def test_elastic_net_meets_its_optimality_conditions(data):
    x, y, df = data
    b = fit_model(ELASTIC, df, "price").coefficients.toArray()
    xc, yc = x - x.mean(0), y - y.mean()
    slope = xc.T @ (yc - xc @ b) / len(y) - 0.05 * b
    for j in range(3):
        if abs(b[j]) > 1e-12:
            assert slope[j] == pytest.approx(0.05 * np.sign(b[j]), abs=1e-5)
        else:
            assert abs(slope[j]) <= 0.05 + 1e-5


@pytest.mark.parametrize("centred", [False, True])
def test_projection_is_the_svd(spark, centred):
    rng = np.random.default_rng(2)
    dense = rng.random((120, 12)) * (rng.random((120, 12)) < 0.4)
    dense[5] = 0
    rows = [(i, [(int(j), float(dense[i, j])) for j in np.flatnonzero(dense[i])]) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, v array<struct<idx:int,weight:double>>").repartition(4)
    p = fit_projection(df, "v", 12, 5, centred)
    base = dense - dense.mean(0) if centred else dense
    _, s, vt = np.linalg.svd(base, full_matrices=False)
    np.testing.assert_allclose(p.singular_values, s[:5], rtol=1e-9)
    got = {r["id"]: r["z"] for r in p.transform(df, "v", "z").collect()}
    z = np.array([got[i] for i in range(120)])
    np.testing.assert_allclose(np.abs(z), np.abs(base @ vt[:5].T), atol=1e-9)


def test_tfidf_weights(spark):
    texts = ["red tea red", "green tea", "", "red cup", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    model = fit_tfidf(df, "t", TextSettings(max_features=10, min_df=1, max_df=0.9, ngram_range=(1, 1)))
    assert model.terms == ["cup", "green", "red", "tea"] and model.n_docs == 5
    got = {r["id"]: r["v"] for r in model.transform(df, "t", "v").collect()}
    idf = {t: np.log(6 / (1 + d)) + 1 for t, d in (("cup", 1), ("green", 1), ("red", 2), ("tea", 2))}
    raw = np.array([(1 + np.log(2)) * idf["red"], idf["tea"]])
    assert [e["idx"] for e in got[0]] == [2, 3] and got[2] == got[4] == []
    np.testing.assert_allclose([e["weight"] for e in got[0]], raw / np.linalg.norm(raw))


def test_scores_find_the_feature_that_matters(spark, data):
    x, y, df = data
    f = {r["feature"]: r["score"] for r in f_regression(df, "features", "price").collect()}
    r = np.array([np.corrcoef(x[:, j], y)[0, 1] for j in range(3)])
    for j in range(3):
        assert f[str(j)] == pytest.approx(r[j] ** 2 / (1 - r[j] ** 2) * 298)
    mi = mutual_information(df, "features", "price")
    top = mi.orderBy(F.desc("score")).first()["feature"]
    assert top in ("0", "1") and best_features(mi, ["0", "1", "2"], 2) == ["0", "1"]
    assert best_features(mi, ["0", "1", "2"], 9) == ["0", "1", "2"]


def test_blend_saves_and_loads(spark, data, tmp_path):
    _, y, df = data
    fitted = fit_blend(df, [FOREST, BOOST, RIDGE], folds=2)
    weights = fitted.model.weights
    assert sum(weights.values()) == pytest.approx(1) and fitted.oof.count() == 300
    scores = {r["model"]: r["smape"] for r in fitted.metrics.where("scope = 'out_of_fold'").collect()}
    assert weights["ridge"] / weights["rf"] == pytest.approx(scores["rf"] / scores["ridge"], rel=1e-6)
    middle = df.agg(100 * F.avg(F.abs(F.col("price") - float(np.median(y))) / ((F.col("price") + float(np.median(y))) / 2))).first()[0]
    assert min(scores.values()) < middle
    fitted.model.save(str(tmp_path / "m"), spark)
    again = BlendModel.load(str(tmp_path / "m"), spark)
    both = fitted.model.transform(df).select("sample_id", "prediction").join(
        again.transform(df).select("sample_id", F.col("prediction").alias("q")), "sample_id")
    assert both.where("prediction = q").count() == 300


def test_stack_is_its_meta_model_over_its_base_models(spark, data, tmp_path):
    _, y, df = data
    fitted = fit_stack(df, [FOREST, RIDGE, ELASTIC], folds=2)
    m = fitted.model
    p = df
    for name, base in m.models.items():
        p = apply_model(base, p, f"q_{name}")
    c = m.meta.coefficients.toArray()
    hand = F.lit(float(m.meta.intercept)) + sum(F.col(f"q_{s.name}") * float(v) for s, v in zip(m.specs, c))
    by_hand = p.select("sample_id", hand.alias("h")).join(m.transform(df), "sample_id")
    assert by_hand.where(F.abs(F.col("h") - F.col("prediction")) < 1e-9).count() == 300
    m.save(str(tmp_path / "m"), spark)
    again = StackModel.load(str(tmp_path / "m"), spark)
    assert again.transform(df).select("sample_id", "prediction").exceptAll(m.transform(df).select("sample_id", "prediction")).isEmpty()


def ridge(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    b = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return y.mean() - x.mean(0) @ b, b


def stacked(x, y, fold, k, alphas):
    """Out-of-fold matrix, meta-ridge on it, and the prediction function of the whole stack."""
    oof = np.zeros((len(y), len(alphas)))
    for i in range(k):
        for j, alpha in enumerate(alphas):
            a, b = ridge(x[fold != i], y[fold != i], alpha)
            oof[fold == i, j] = a + x[fold == i] @ b
    base = [ridge(x, y, alpha) for alpha in alphas]
    a, b = ridge(oof, y, 1.0)
    return oof, lambda z: a + np.stack([m + z @ c for m, c in base], axis=1) @ b


MIXED = [ModelSpec("loose", "ridge", dict(alpha=1.0)), ModelSpec("stiff", "ridge", dict(alpha=500.0))]


def test_stack_of_two_models_is_its_closed_form(data):
    x, y, df = data
    fitted = fit_stack(df, MIXED, folds=5)
    rows = fitted.oof.orderBy("sample_id").toPandas()
    oof, predict = stacked(x, y, rows.fold.to_numpy(), 5, [1.0, 500.0])
    np.testing.assert_allclose(rows[["oof_loose", "oof_stiff"]].to_numpy(), oof, rtol=1e-7)
    got = fitted.model.transform(df).orderBy("sample_id").toPandas().prediction
    np.testing.assert_allclose(got, predict(x), rtol=1e-5)
    by_fold = fitted.by_fold.toPandas()
    assert len(by_fold) == 10 and by_fold.n.sum() == 600


def test_nested_cross_validation_is_its_closed_form(data):
    x, y, df = data
    got = nested_cv(df, MIXED, outer=3, inner=3).orderBy("sample_id").toPandas()
    inner = add_fold(df, 3).orderBy("sample_id").toPandas().fold.to_numpy()
    outer = got.fold.to_numpy()
    for i in range(3):
        _, predict = stacked(x[outer != i], y[outer != i], inner[outer != i], 3, [1.0, 500.0])
        np.testing.assert_allclose(got.prediction[outer == i], predict(x[outer == i]), rtol=1e-5)


def test_the_meta_model_is_chosen_by_name(data):
    _, _, df = data
    shares = [fit_stack(df, [RIDGE], folds=2, meta=m).model.meta.getElasticNetParam() for m in ("ridge", "elastic_net", "other")]
    assert shares[0] == shares[2] == 0 and shares[1] > 0


def test_boosted_specs_differ():
    specs = {s.name: s.params for s in STACK_FULL}
    assert specs["xgboost"] != specs["lightgbm"]


def test_gram_partials_do_not_grow_with_the_splits(spark):
    rows = spark.range(2000).select(F.array(F.struct((F.col("id") % 7).cast("int").alias("idx"), F.lit(0.5).alias("weight"))).alias("v"))
    found = [gram(rows.repartition(parts), "v", 7) for parts in (4, 400)]
    np.testing.assert_allclose(found[0][2], found[1][2])
    assert found[0][0] == found[1][0] == 2000 and found[0][1].sum() == pytest.approx(1000)


def test_tables_go_with_their_owner(spark):
    with owned_tables(spark):
        path = materialise(spark.range(5), "short").inputFiles()[0].rsplit("/", 1)[0]
        assert exists(spark, path)
    assert not exists(spark, path)


def test_a_saved_stack_pipeline_predicts_alike(spark, tmp_path):
    rows = spark.range(120).select(
        F.col("id").alias("sample_id"), F.concat(F.lit("Item Name: "), F.when(F.col("id") % 3 == 0, "Acme tea").otherwise("Bolt cup"), F.lit(" size "), F.col("id") % 9,
        F.lit("\nValue: "), F.col("id") % 17, F.lit("\nCount: "), F.col("id") % 5 + 1).alias("catalog_content"),
        F.lit("http://x").alias("image_link"), (F.col("id") % 17 * 2.0 + 5).alias("price"))
    settings = stack.StackSettings(text=TextSettings(max_features=30, min_df=2, max_df=0.95), components=5, folds=3, models=[RIDGE, ELASTIC], fit_on="train", mode="lines")
    result = stack.run(rows, rows.drop("price"), settings)
    result.pipeline.save(str(tmp_path / "p"), spark)
    again = stack.StackPipeline.load(str(tmp_path / "p"), spark)
    fresh = rows.select("sample_id", "catalog_content", "image_link")
    both = again.predict(fresh).withColumnRenamed("prediction", "again").join(result.predictions, "sample_id")
    assert both.where(F.abs(F.col("again") - F.col("prediction")) < 1e-9).count() == 120
    assert again.submission(fresh).where("price BETWEEN 0.01 AND 50000").count() == 120
    with pytest.raises(ValueError):
        with_vector(fresh.withColumn("text", F.array(F.lit(1.0))), ["value"], "text", ["sample_id"])


def test_unweighted_models_count_equally(spark):
    df = spark.createDataFrame([(1.0, 3.0)], "a double, b double")
    assert df.select(E.weighted_sum({"a": F.col("a"), "b": F.col("b")}, {})).first()[0] == 2.0


def test_linear_fits_come_from_one_pass(spark, data):
    """Sums of folds give what separate fits on the rows give, also far from the origin."""
    from pricewright.operators.models import fit_linear
    from pricewright.operators.moments import added, moments

    x, y, _ = data
    far = x + 1e4
    rows = spark.createDataFrame([(i, float(y[i]) + 1e3, Vectors.dense(far[i])) for i in range(300)] + [(900, None, Vectors.dense([0.0] * 3))], ["sample_id", "price", "features"])
    rows = materialise(add_fold(rows, 4).repartition(5), "folded")
    cells = moments(rows, "price", by=["fold"])
    fold = add_fold(spark.range(300).withColumnRenamed("id", "sample_id"), 4).orderBy("sample_id").toPandas().fold.to_numpy()
    for i in range(4):
        m = added(v for k, v in cells.items() if k != (i,))
        a, b = ridge(x[fold != i], y[fold != i], 10.0)
        model = fit_linear(RIDGE, m, "price")
        np.testing.assert_allclose(model.coefficients.toArray(), b, rtol=1e-9)
        assert model.intercept == pytest.approx(a + 1e3 - 1e4 * b.sum(), rel=1e-9) and m.n == (fold != i).sum()
        sparse = fit_linear(ELASTIC, m, "price").coefficients.toArray()
        xc, yc = x[fold != i] - x[fold != i].mean(0), y[fold != i] - y[fold != i].mean()
        slope = xc.T @ (yc - xc @ sparse) / m.n - 0.05 * sparse
        assert all(slope[j] == pytest.approx(0.05 * np.sign(v), abs=1e-9) if v else abs(slope[j]) <= 0.05 + 1e-9 for j, v in enumerate(sparse))


def test_a_mixed_stack_fits_its_meta_model_on_the_rows(data):
    x, y, df = data
    fitted = fit_stack(df, [MIXED[0], FOREST, MIXED[1]], folds=3)
    rows = fitted.oof.toPandas()
    a, b = ridge(rows[["oof_loose", "oof_rf", "oof_stiff"]].to_numpy(), rows.price.to_numpy(), 1.0)
    np.testing.assert_allclose(fitted.model.meta.coefficients.toArray(), b, rtol=1e-6)
    oof, _ = stacked(x, y, fitted.oof.orderBy("sample_id").toPandas().fold.to_numpy(), 3, [1.0, 500.0])
    np.testing.assert_allclose(fitted.oof.orderBy("sample_id").toPandas()[["oof_loose", "oof_stiff"]].to_numpy(), oof, rtol=1e-7)
