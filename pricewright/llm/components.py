"""Connected components of links: union-find inside each task, then large-star and small-star rounds in Spark."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.session import materialise

TASK_LINKS = 500_000  # links a task's union-find holds at once
FILE_LINKS = 100_000  # links of a file that a round writes, at most that many on average


def _forest(batches):
    """Replaces the links of one task by links to the smallest member of each group that they form."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def out():
        members = [x for x in parent if find(x) != x]
        return pa.RecordBatch.from_arrays([pa.array(members, pa.int64()), pa.array([find(x) for x in members], pa.int64())], names=["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > TASK_LINKS:
            yield out()
            parent.clear()
    yield out()


def components(links: DataFrame) -> DataFrame:
    """id, component for every id in ``links`` (columns a, b; a written table): the smallest id that links lead to.

    An empty table of links gives an empty result.  Each round is written to the shared folder, so an executor
    that is lost costs its tasks only; nothing is collected but a count of the links and one a round.  The files
    follow the number of links, not the number of shuffle partitions.
    """
    files = max(1, math.ceil(links.count() / FILE_LINKS))
    edges = materialise(links.select("a", "b").mapInArrow(_forest, "u long, v long").distinct(), "forest", files=files)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = materialise(small.where("u <> v").unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "forest", files=files)
        # done when every id has one link and no target has a link itself
        many = after.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        deep = after.join(after.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        if not many and not deep:
            return after.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                after.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
        edges = after
