"""Incremental PCA: a summary of bounded size that rows update and that two of merge.

A summary holds the number of rows, their mean, and the leading singular values and vectors of the rows less the
mean.  Two summaries are stacked, with one more row for the distance of their means, and reduced again.  Tasks fold their
rows in chunks; the summaries of tasks merge some at a time until one is left, and that merges with an earlier one.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.operators.reduce import MAX_COLUMNS, Projection, with_signs
from pricewright.session import materialise

CHUNK = 1024  # rows that are folded at once
FAN = 8  # summaries that one task merges


@dataclass
class Summary:
    """Of ``n`` rows: mean, singular values and vectors (one a row) of what is left without the mean; ``k`` at most."""

    k: int
    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def empty(k: int, width: int) -> "Summary":
        return Summary(k, 0, np.zeros(width), np.zeros(0), np.zeros((0, width)))

    def _joined(self, n: int, mean: np.ndarray, rows: np.ndarray) -> "Summary":
        """With n more rows of which ``rows`` are the differences from ``mean``, or as good as those."""
        if not n:
            return self
        total = self.n + n
        gap = np.sqrt(self.n * n / total) * (self.mean - mean)
        _, values, vectors = np.linalg.svd(np.vstack([self.values[:, None] * self.vectors, rows, gap]), full_matrices=False)
        kept = min(self.k, len(values))
        return Summary(self.k, total, self.mean + (mean - self.mean) * (n / total), values[:kept], vectors[:kept])

    def update(self, rows: np.ndarray) -> "Summary":
        mean = rows.mean(axis=0) if len(rows) else self.mean
        return self._joined(len(rows), mean, rows - mean)

    def merge(self, other: "Summary") -> "Summary":
        return self._joined(other.n, other.mean, other.values[:, None] * other.vectors)

    def projection(self) -> Projection:
        return Projection(with_signs(self.vectors.T.copy()), self.values, self.mean)

    def packed(self) -> bytes:
        return np.r_[self.k, self.n, len(self.values), self.mean, self.values, self.vectors.ravel()].astype(float).tobytes()

    @staticmethod
    def unpacked(data: bytes) -> "Summary":
        x = np.frombuffer(data)
        kept = int(x[2])
        width = (len(x) - 3 - kept) // (1 + kept)
        return Summary(int(x[0]), int(x[1]), x[3:3 + width], x[3 + width:3 + width + kept], x[3 + width + kept:].reshape(kept, width))

    def save(self, path: str, spark) -> None:
        state = {"k": self.k, "n": self.n, "mean": self.mean.tolist(), "values": self.values.tolist()}
        rows = [(-1, json.dumps(state), None)] + [(i, None, v.tolist()) for i, v in enumerate(self.vectors)]
        spark.createDataFrame(rows, "number int, state string, vector array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(path: str, spark) -> "Summary":
        rows = spark.read.parquet(path).orderBy("number").collect()  # k vectors
        state = json.loads(rows[0]["state"])
        vectors = np.array([r["vector"] for r in rows[1:]]).reshape(-1, len(state["mean"]))
        return Summary(state["k"], state["n"], np.array(state["mean"]), np.array(state["values"]), vectors)


def _chunks(batches, width: int):
    """Dense rows, ``CHUNK`` at a time, of batches of arrays of (idx, weight)."""
    for batch in batches:
        for a in range(0, batch.num_rows, CHUNK):
            lists = batch.column(0).slice(a, CHUNK)
            sizes = [n or 0 for n in pa.compute.list_value_length(lists).to_pylist()]
            entries, out = lists.flatten(), np.zeros((len(sizes), width))
            out[np.repeat(np.arange(len(sizes)), sizes), entries.field(0).to_numpy(zero_copy_only=False)] = entries.field(1).to_numpy(zero_copy_only=False)
            yield out


def fit_incremental(df: DataFrame, sparse: str, width: int, k: int, start: Summary | None = None) -> Summary:
    """The summary of sparse rows (idx, weight), after ``start`` if there is one.

    With ``k`` as large as the width it is that of all rows at once.  With fewer, what each reduction leaves out is lost, so
    the result depends, a little, on how the rows are split; splits are merged to one per core.  Null arrays are rows of zeros;
    without rows the result is ``start``.
    """
    if width > MAX_COLUMNS:
        raise ValueError(f"at most {MAX_COLUMNS} columns")
    k = min(k, width)
    if start is not None and (start.k, len(start.mean)) != (k, width):
        raise ValueError("the earlier summary has another size")

    def fold(batches):
        summary = Summary.empty(k, width)
        for rows in _chunks(batches, width):
            summary = summary.update(rows)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([summary.packed()], pa.binary())], names=["part", "summary"])

    def merge(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        summary = Summary.empty(k, width)
        for data in group.column("summary"):
            summary = summary.merge(Summary.unpacked(data.as_py()))
        return pa.table({"part": group.column("part").slice(0, 1), "summary": pa.array([summary.packed()], pa.binary())})

    rows = df.select(sparse).coalesce(df.sparkSession.sparkContext.defaultParallelism)
    count = rows.rdd.getNumPartitions()
    found = materialise(rows.mapInArrow(fold, "part int, summary binary"), "summaries")
    while count > FAN:
        found = found.withColumn("to", F.floor(F.col("part") / FAN).cast("int")).groupBy("to").applyInArrow(merge, "part int, summary binary")
        found, count = materialise(found.withColumn("part", F.floor(F.col("part") / FAN).cast("int")), "summaries"), -(-count // FAN)
    summary = start or Summary.empty(k, width)
    for r in found.orderBy("part").collect():  # at most FAN summaries
        summary = summary.merge(Summary.unpacked(bytes(r["summary"])))
    return summary
