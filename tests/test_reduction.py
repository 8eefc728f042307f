"""Sketched and incremental reductions against NumPy's SVD."""

import numpy as np
import pytest

from pricewright.operators import incremental as N
from pricewright.operators import sketch as S
from pricewright.operators.incremental import Summary, fit_incremental
from pricewright.operators.reduce import MAX_COLUMNS, fit_projection


def sparse_rows(spark, dense, parts=5):
    rows = [(i, [(int(j), float(r[j])) for j in np.flatnonzero(r)] if i else None) for i, r in enumerate(dense)]
    return spark.createDataFrame(rows, "id int, v array<struct<idx:int,weight:double>>").repartition(parts)


@pytest.fixture(scope="module")
def dense():
    rng = np.random.default_rng(2)
    low = rng.normal(size=(160, 8)) @ rng.normal(size=(8, 40)) * (rng.random((160, 40)) < 0.5)
    low[0] = 0
    return low


@pytest.mark.parametrize("centred", [False, True])
@pytest.mark.parametrize("k", [5, 40])
def test_sketch_is_the_svd(spark, dense, centred, k, monkeypatch):
    monkeypatch.setattr(S, "_ENTRIES", 70)
    monkeypatch.setattr(S, "FAN", 2)
    base = dense - dense.mean(0) if centred else dense
    _, s, vt = np.linalg.svd(base, full_matrices=False)
    found = S.fit_sketched(sparse_rows(spark, dense), "v", 40, k, centred)
    np.testing.assert_allclose(found.singular_values, s[:k], rtol=1e-5, atol=1e-9)
    if k == 5:
        np.testing.assert_allclose(np.abs(found.components.T @ vt[:5].T), np.eye(5), atol=1e-3)


def test_more_columns_than_a_gram_matrix_may_have(spark):
    rng = np.random.default_rng(5)
    width = 3 * MAX_COLUMNS
    columns, weights = rng.integers(0, width, (300, 6)), rng.normal(size=(300, 6))
    rows = [(i, sorted({int(c): float(w) for c, w in zip(columns[i], weights[i])}.items())) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, v array<struct<idx:int,weight:double>>").repartition(4)
    whole = np.zeros((300, width))
    for i, entries in rows:
        for c, w in entries:
            whole[i, c] = w
    found = fit_projection(df, "v", width, 6, False)
    want = np.linalg.svd(whole, compute_uv=False)[:6]
    assert (found.singular_values <= want * (1 + 1e-9)).all() and (found.singular_values > 0.97 * want).all()
    got = np.array([r["z"] for r in found.transform(df, "v", "z").orderBy("id").collect()])
    np.testing.assert_allclose(got, whole @ found.components, atol=1e-9)
    with pytest.raises(ValueError):
        S.fit_sketched(df, "v", S.LIMIT, 6)
    with pytest.raises(ValueError):
        S.fit_sketched(df.limit(0), "v", width, 6)


def test_incremental_equals_all_at_once(spark, dense, tmp_path, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 7)
    monkeypatch.setattr(N, "FAN", 2)
    df = sparse_rows(spark, dense)
    base = dense - dense.mean(0)
    _, s, vt = np.linalg.svd(base, full_matrices=False)
    whole = fit_incremental(df, "v", 40, 40)
    assert whole.n == 160
    np.testing.assert_allclose(whole.mean, dense.mean(0), atol=1e-12)
    np.testing.assert_allclose(whole.values, s, atol=1e-9)
    fit_incremental(df.where("id < 90"), "v", 40, 40).save(str(tmp_path / "s"), spark)
    later = fit_incremental(df.where("id >= 90"), "v", 40, 40, start=Summary.load(str(tmp_path / "s"), spark))
    np.testing.assert_allclose(later.values, whole.values, atol=1e-9)
    np.testing.assert_allclose(np.abs(later.projection().components.T[:5] @ whole.projection().components[:, :5]), np.eye(5), atol=1e-6)
    assert fit_incremental(df.limit(0), "v", 40, 40, start=whole).n == 160
    few = fit_incremental(df, "v", 40, 12)
    assert few.vectors.shape == (12, 40) and np.allclose(few.values[:4], s[:4], rtol=0.02)
    with pytest.raises(ValueError):
        fit_incremental(df, "v", 40, 5, start=whole)
