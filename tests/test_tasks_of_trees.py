"""Rows of tree fits are dealt over tasks by their number: files of alike rows are few and uneven splits."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from pricewright.operators import boosting, models
from pricewright.operators.boosting import BoostedTrees, bin_rows
from pricewright.operators.models import ModelSpec, apply_model, estimator, fit_model
from pricewright.session import materialise


@pytest.fixture(scope="module")
def one_split(spark):
    x = F.array((F.col("id") % 7).cast("double"), (F.col("id") % 3).cast("double"))
    rows = spark.range(20_000).select(F.col("id").alias("sample_id"), (F.col("id") % 7 * 2.0 + F.col("id") % 3).alias("price"), array_to_vector(x).alias("features"))
    return materialise(rows.coalesce(1), "one-split")


def test_cached_rows_of_a_task_are_bounded(spark, one_split, monkeypatch):
    spec = ModelSpec("rf", "forest", dict(numTrees=1, maxDepth=4, featureSubsetStrategy="all", bootstrap=False))
    assert models.spread(one_split, spec).rdd.getNumPartitions() == one_split.rdd.getNumPartitions()
    before = apply_model(fit_model(spec, one_split, "price"), one_split, "p").orderBy("sample_id").select("p").collect()
    monkeypatch.setattr(models, "TASK_BYTES", 1 << 20)
    parts = models.spread(one_split, spec).rdd.glom().map(len).collect()
    assert sum(parts) == 20_000 and max(parts) * models._row_bytes(spec, 2) < 1.2 * (1 << 20)
    after = apply_model(fit_model(spec, one_split, "price"), one_split, "p").orderBy("sample_id").select("p").collect()
    assert [r["p"] for r in after] == pytest.approx([r["p"] for r in before])


def test_binned_rows_are_even(spark, one_split, monkeypatch):
    settings = dict(labelCol="price", maxIter=3, maxDepth=3, patience=2)
    before = BoostedTrees(**settings).fit(one_split)
    monkeypatch.setattr(boosting, "TASK_BYTES", 1 << 17)
    binned = bin_rows(one_split, "features", "price", "sample_id")
    parts = [len(p) for p in binned.rows.rdd.glom().collect()]
    assert sum(parts) == 20_000 and len([n for n in parts if n]) > 4 and max(parts) < 10_000
    after = BoostedTrees(**settings).fit(one_split)
    assert [t.feature for t in after.trees] == [t.feature for t in before.trees] and after.losses == pytest.approx(before.losses)


def test_bytes_of_a_column_become_rows():
    rows = [bytes([i, i + 1, i + 2]) for i in range(50)]
    for kind in (pa.binary(), pa.large_binary()):
        column = pa.array(rows, kind)
        for part in (column, column.slice(7, 20), column.slice(0, 0)):
            want = np.array([list(b.as_py()) for b in part], np.uint8).reshape(-1, 3)
            assert (boosting._bin_matrix(part, 3) == want).all() and boosting._bin_matrix(part, 3).shape == want.shape


def test_shallow_trees_keep_no_table_of_nodes_and_are_the_same(spark):
    """Rows are led down few levels anew, which is cheaper; and no key is read where no model draws by it."""
    rows = spark.range(400).select(F.col("id").cast("double").alias("price"), array_to_vector(F.array(F.sin("id"), F.col("id") % 7.0)).alias("features")).repartition(2)
    for spec in (ModelSpec("rf", "forest", dict(numTrees=3, maxDepth=4)), ModelSpec("gb", "boosting", dict(maxIter=3, maxDepth=3, subsamplingRate=0.8))):
        plain = estimator(spec, rows, "price", "features")
        assert not plain.getCacheNodeIds()
        assert fit_model(spec, rows, "price").toDebugString.split("\n", 1)[1] == plain.setCacheNodeIds(True).fit(rows).toDebugString.split("\n", 1)[1]
    assert estimator(ModelSpec("rf", "forest", dict(maxDepth=15)), rows, "price", "features").getCacheNodeIds()
