"""Steps that the blend and other fits share: thresholds in one pass, histograms by feature, columns of arrays."""

import numpy as np
import pyarrow as pa
import pytest

from pricewright.operators import boosting
from pricewright.operators.reduce import Projection, number_rows


def _vectors(spark, rows, slices=3):
    return spark.createDataFrame([(list(map(float, r)),) for r in rows], "x array<double>").repartition(slices)


def test_thresholds_read_the_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(i, i % 3, float("nan")) for i in range(500)]
    found = boosting._thresholds(_vectors(spark, rows).mapInArrow(counted, "x array<double>"), 3, 16)
    assert seen.value == 500
    assert found[0].tolist() == [np.ceil(500 * i / 16) - 1 for i in range(1, 16)]  # few enough to be exact
    assert found[1].tolist() == [0.0, 1.0] and found[2].tolist() == []


def test_thresholds_of_many_rows_are_near_the_quantiles(spark, monkeypatch):
    bins, n = 16, 40_000
    rng = np.random.default_rng(1)
    x = np.column_stack([rng.normal(size=n), np.where(rng.random(n) < 0.7, 2.0, rng.normal(size=n)), rng.integers(0, 5, n)])
    x[::50, 0] = np.nan
    monkeypatch.setattr(boosting, "SORT_BYTES", 8 * 3 * 700)  # dozens of parts a task
    found = boosting._thresholds(_vectors(spark, x, 2), 3, bins)
    assert found[2].tolist() == [0.0, 1.0, 2.0, 3.0]
    known = np.sort(x[~np.isnan(x[:, 0]), 0])
    for share, cut in zip(np.arange(1, bins) / bins, found[0]):
        assert abs(np.searchsorted(known, cut) - share * len(known)) <= len(known) / 100
    assert len(found[0]) == bins - 1 and set(found[0]) <= set(known) and set(found[1]) <= set(x[:, 1])
    assert 2.0 in found[1] and len(found[1]) < bins - 1  # one value fills most bins


@pytest.mark.parametrize("wanted", [[1, 2], [2]])
def test_histograms_of_several_nodes(spark, wanted):
    rng = np.random.default_rng(2)
    n, width, bins = 300, 4, 8
    b = rng.integers(0, bins, (n, width)).astype(np.uint8)
    y = rng.integers(-5, 5, n).astype(float)
    rows = spark.createDataFrame([(float(y[i]), i, bool(i % 10 == 0), bytearray(b[i].tobytes()), 0.0) for i in range(n)], "y double, h long, held boolean, bins binary, p double")
    tree = boosting.Tree([1, -1, -1], [3, 0, 0], [0.0] * 3, [1, -1, -1], [2, -1, -1], [0.0] * 3)
    features = np.array([0, 2, 3])
    scan = boosting._Scan([], tree.arrays(), wanted, 0, 1.0, features, width, bins, 1.0, False)
    found, _ = boosting._counts(rows.repartition(3), scan)
    for node in wanted:
        mine = (np.arange(n) % 10 != 0) & ((b[:, 1] > 3) == (node == 2))
        g, count = np.zeros((width, bins)), np.zeros((width, bins), np.int64)
        for f in features:
            np.add.at(g[f], b[mine, f], -y[mine])
            np.add.at(count[f], b[mine, f], 1)
        assert (found[node][0] == g).all() and (found[node][1] == count).all()


def test_columns_of_arrays():
    matrix = np.arange(6.0).reshape(3, 2)
    assert number_rows(matrix).to_pylist() == matrix.tolist()
    assert number_rows(np.empty((2, 0))).to_pylist() == [[], []]
    assert boosting._byte_rows(matrix.astype(np.uint8)).to_pylist() == [bytes([0, 1]), bytes([2, 3]), bytes([4, 5])]
    assert boosting._byte_rows(np.empty((0, 2), np.uint8)).type == pa.binary()


def test_projection_of_empty_rows_and_batches(spark):
    rng = np.random.default_rng(3)
    parts = rng.normal(size=(5, 3))
    rows = [(i, [(j, float(i + j)) for j in range(5) if (i + j) % 3 == 0] if i % 4 else []) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, s array<struct<idx:int,weight:double>>").repartition(3)
    for mean in (None, rng.normal(size=5)):
        found = {r["id"]: r["v"] for r in Projection(parts, np.ones(3), mean).transform(df, "s", "v").collect()}
        for i, entries in rows:
            dense = np.zeros(5)
            for j, w in entries:
                dense[j] = w
            assert np.allclose(found[i], (dense if mean is None else dense - mean) @ parts)
