"""Truncated SVD and PCA of sparse rows through their Gram matrix.

The Gram matrix of p columns has p x p numbers whatever the number of rows.  MLlib adds it up from sparse rows in one
pass, where an iterative SVD makes many; the driver receives the p x p result only and takes its eigenvectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pricewright.session import new_table_path

MAX_COLUMNS = 4096  # 128 MB of doubles on the driver, half of it in a task
PARTIALS_A_CORE = 4
_BATCH = 2048


def _dense(columns: np.ndarray, weights: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """Rows of zeros but for the entries between consecutive ``ends``."""
    block = np.zeros((len(ends) - 1, width))
    own = slice(ends[0], ends[-1])
    block[np.repeat(np.arange(len(ends) - 1), np.diff(ends)), columns[own]] = weights[own]
    return block


def number_rows(matrix: np.ndarray) -> pa.Array:
    """A column of arrays from the rows of a matrix, without an object for each row."""
    ends = np.arange(len(matrix) + 1, dtype=np.int64) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.ascontiguousarray(matrix, dtype=float).ravel()))


def as_vectors(df: DataFrame, sparse: str, width: int) -> DataFrame:
    """One column ``vector`` from arrays of (idx, weight): written as the parts of a sparse vector, read as one."""
    path = new_table_path(df.sparkSession, "vectors")
    parts = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(width).alias("size"),
                     F.col(sparse)["idx"].alias("indices"), F.col(sparse)["weight"].alias("values"))
    df.select(parts.alias("vector")).write.parquet(path)
    return df.sparkSession.read.schema(StructType([StructField("vector", VectorUDT())])).parquet(path)


def gram(df: DataFrame, sparse: str, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, column sums, and the matrix of products of all pairs of columns.

    Splits are merged into some per core, without a shuffle, so the partial matrices that travel depend on the cluster
    and not on the number of files; Spark's tree aggregation adds them up.
    """
    if width > MAX_COLUMNS:
        raise ValueError(f"at most {MAX_COLUMNS} columns")
    vectors = as_vectors(df, sparse, width)
    vectors = vectors.coalesce(PARTIALS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)
    n, total = vectors.agg(F.count(F.lit(1)), Summarizer.sum(F.col("vector"))).first()
    if not n:
        raise ValueError("no rows to fit on")
    products = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector")).computeGramianMatrix()
    return n, total.toArray(), products.toArray()


@dataclass
class Projection:
    """Row vectors times ``components`` (width x k), after subtracting ``mean`` when there is one."""

    components: np.ndarray
    singular_values: np.ndarray
    mean: np.ndarray | None = None

    @property
    def k(self) -> int:
        return self.components.shape[1]

    def column(self, sparse: Column) -> Column:
        shared = self.components
        width = shared.shape[0]
        shift = None if self.mean is None else self.mean @ shared

        rows = max(1, min(_BATCH, _BATCH * MAX_COLUMNS // max(1, width)))

        @F.arrow_udf("array<double>")
        def project(indices: pa.Array, weights: pa.Array) -> pa.Array:
            columns, values = (a.flatten().to_numpy(zero_copy_only=False) for a in (indices, weights))
            ends = np.r_[0, np.cumsum(pc.list_value_length(indices).to_numpy(zero_copy_only=False))].astype(np.int64)
            out = np.empty((len(indices), shared.shape[1]))
            for start in range(0, len(indices), rows):
                block = _dense(columns, values, ends[start:start + rows + 1], width) @ shared
                out[start:start + rows] = block if shift is None else block - shift
            return number_rows(out)

        return project(sparse["idx"], sparse["weight"])

    def state(self) -> dict:
        return {"components": self.components.tolist(), "singular_values": self.singular_values.tolist(), "mean": None if self.mean is None else self.mean.tolist()}

    @staticmethod
    def of(state: dict) -> "Projection":
        return Projection(np.array(state["components"]), np.array(state["singular_values"]), None if state["mean"] is None else np.array(state["mean"]))

    def transform(self, df: DataFrame, sparse: str, column: str) -> DataFrame:
        return df.withColumn(column, self.column(F.col(sparse)))


def with_signs(components: np.ndarray) -> np.ndarray:
    """Columns turned so that the largest entry of each is positive."""
    signs = np.sign(components[np.abs(components).argmax(axis=0), np.arange(components.shape[1])])
    return components * np.where(signs == 0, 1, signs)


def fit_projection(df: DataFrame, sparse: str, width: int, k: int, centred: bool) -> Projection:
    """The ``k`` leading right singular vectors; with ``centred`` the principal components.

    ``k`` is limited to the width.  The sign of a component is chosen so that its largest entry is positive.  More than
    ``MAX_COLUMNS`` columns are sketched, see :mod:`pricewright.operators.sketch`.
    """
    if width > MAX_COLUMNS:
        from pricewright.operators.sketch import fit_sketched  # which needs this module

        return fit_sketched(df, sparse, width, k, centred)
    k = min(k, width)
    n, total, products = gram(df, sparse, width)
    mean = None
    if centred:
        mean = total / n
        products = products - n * np.outer(mean, mean)
    values, vectors = np.linalg.eigh((products + products.T) / 2)
    order = np.argsort(values)[::-1][:k]
    return Projection(with_signs(vectors[:, order]), np.sqrt(np.maximum(values[order], 0)), mean)
