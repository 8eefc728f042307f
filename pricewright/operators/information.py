"""Mutual information by nearest neighbours: the estimator of Kraskov, Stoegbauer and Grassberger for two numbers.

For every row the distance to its k-th nearest neighbour is found in the plane of feature and target, and the rows
that are nearer than that along each axis are counted; the mean digamma of the counts gives the information.

Distances: the plane is cut into strips of about as many rows, and those into cells.  A cell's rows are compared with
each other, which bounds every distance; only rows whose bound reaches over an edge ask the cells that it reaches.
Counts: points and the ends of all intervals are range-partitioned and sorted together, and running numbers of points
are subtracted.  No row is compared with all others, and no cell or range grows with a value's frequency, because
values are told apart by noise far below their spread.  Values are whole numbers of a fine grid, so that all
comparisons are exact.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.session import materialise

CELL = 512  # rows of a cell on average
MAX_CELLS = 1 << 17  # cells of a feature: their edges go to every task
GRID = 46  # bits of a standard deviation
NOISE = 1e-10  # of the spread, or of the mean size if that is larger


def digamma(n: Column) -> Column:
    """The logarithmic derivative of the gamma function for n >= 1."""
    x = n.cast("double")
    big = x + 6.0
    square = 1.0 / (big * big)
    series = square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square * (1 / 240 - square / 132))))
    return F.log(big) - 0.5 / big - series - sum((1.0 / (x + float(i)) for i in range(6)), F.lit(0.0))


def _noise(*parts: Column) -> Column:
    """A number between -1 and 1 from a hash."""
    digits = F.substring(F.md5(F.concat_ws("/", *[p.cast("string") for p in parts]).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / float(1 << 31) - 1.0


def _points(df: DataFrame, features: list[str] | str, target: str, key: str) -> DataFrame:
    """f, id, x, y on the grid, of all rows with a feature and a target."""
    y = F.col(target).cast("double").alias("y")
    values = vector_to_array(features) if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    rows = df.select(F.monotonically_increasing_id().alias("id"), F.col(key).cast("string").alias("key"), y, F.posexplode(values).alias("f", "x"))
    rows = materialise(rows.where("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)"), "pairs")
    spread = lambda c: F.when(F.min(c) < F.max(c), F.stddev_pop(c)).otherwise(1.0)
    size = rows.groupBy("f").agg(spread("x").alias("sx"), spread("y").alias("sy"), F.avg(F.abs("x")).alias("ax"), F.avg(F.abs("y")).alias("ay"))

    def grid(value: str, s: str, a: str, *salt: Column) -> Column:
        noise = NOISE * F.greatest(F.lit(1.0), F.col(a) / F.col(s)) * _noise(*salt)
        return F.rint((F.col(value) / F.col(s) + noise) * float(1 << GRID)).cast("long")

    placed = rows.join(F.broadcast(size), "f")  # one row a feature
    return materialise(placed.select("f", "id", grid("x", "sx", "ax", F.col("f"), F.col("key")).alias("x"), grid("y", "sy", "ay", F.lit("y"), F.col("key")).alias("y")), "points")


class _Plane:
    """Edges of strips and cells of every feature; a value belongs behind all edges below it."""

    def __init__(self, x_edges: dict[int, np.ndarray], y_edges: dict[tuple[int, int], np.ndarray], width: int):
        self.x, self.y, self.width = x_edges, y_edges, width
        self.none = np.empty(0, np.int64)

    def strips(self, f: int, x: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.x.get(f, self.none), x, side="left")

    def cells(self, f: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        strip = self.strips(f, x)
        out = np.empty(len(x), np.int64)
        for s in np.unique(strip):
            mine = strip == s
            out[mine] = s * self.width + np.searchsorted(self.y.get((f, int(s)), self.none), y[mine], side="left")
        return out

    def reached(self, f: int, x: int, y: int, reach: int) -> list[int]:
        """Cells that hold places at most ``reach`` away along both axes."""
        edges = self.x.get(f, self.none)
        out = []
        for s in range(int(np.searchsorted(edges, x - reach)), int(np.searchsorted(edges, x + reach)) + 1):
            lines = self.y.get((f, s), self.none)
            out.extend(range(s * self.width + int(np.searchsorted(lines, y - reach)), s * self.width + int(np.searchsorted(lines, y + reach)) + 1))
        return out


def _plane(points: DataFrame, n: int) -> _Plane:
    """Any edges are right; these come from sketches."""
    per_axis = max(1, math.ceil(math.sqrt(min(n / CELL, MAX_CELLS))))
    if per_axis == 1:
        return _Plane({}, {}, 1)
    shares = F.array(*[F.lit(i / per_axis) for i in range(1, per_axis)])
    edges = points.groupBy("f").agg(F.percentile_approx("x", shares, 20 * per_axis).alias("e")).collect()  # fewer than sqrt(MAX_CELLS) numbers a feature
    half = _Plane({r["f"]: np.unique(r["e"]) for r in edges}, {}, per_axis)

    def strips(batches):
        for batch in batches:
            f, x = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            strip = np.empty(len(f), np.int32)
            for one in np.unique(f):
                strip[f == one] = half.strips(int(one), x[f == one])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(strip), batch.column(2)], names=["f", "strip", "y"])

    lines = points.select("f", "x", "y").mapInArrow(strips, "f int, strip int, y long").groupBy("f", "strip")
    lines = lines.agg(F.percentile_approx("y", shares, 20 * per_axis).alias("e")).collect()  # at most MAX_CELLS numbers a feature
    return _Plane(half.x, {(r["f"], r["strip"]): np.unique(r["e"]) for r in lines}, per_axis)


def _nearest(x: np.ndarray, y: np.ndarray, others_x: np.ndarray, others_y: np.ndarray, k: int) -> np.ndarray:
    """The k smallest distances of each (x, y) to the others, ascending; what is missing is -1 at the end."""
    out = np.full((len(x), k), -1, np.int64)
    have = min(k, len(others_x))
    step = max(1, (1 << 20) // max(1, len(others_x)))
    for a in range(0, len(x) if have else 0, step):
        d = np.maximum(np.abs(x[a:a + step, None] - others_x), np.abs(y[a:a + step, None] - others_y))
        out[a:a + step, :have] = np.sort(np.partition(d, have - 1, axis=1)[:, :have], axis=1)
    return out


def _radii(points: DataFrame, plane: _Plane, k: int) -> DataFrame:
    """f, id, x, y and the distance ``r`` to the k-th nearest other row."""
    shared = points.sparkSession.sparkContext.broadcast(plane)  # at most MAX_CELLS numbers a feature

    def place(batches):
        for batch in batches:
            f, x, y = (batch.column(i).to_numpy() for i in (0, 2, 3))
            cell = np.empty(len(f), np.int64)
            for one in np.unique(f):
                mine = f == one
                cell[mine] = shared.value.cells(int(one), x[mine], y[mine])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=["f", "id", "x", "y", "cell"])

    def inside(group: pa.Table) -> pa.Table:
        """Distances within the cell, and which other cells could hold a nearer row."""
        f, cell = group.column("f")[0].as_py(), group.column("cell")[0].as_py()
        x, y = group.column("x").to_numpy(), group.column("y").to_numpy()
        near = _nearest(x, y, x, y, k + 1)[:, 1:]  # without the row itself, at distance 0
        whole = near[:, -1] >= 0
        everywhere = int(max(np.abs(x).max(), np.abs(y).max())) + (1 << 60)
        reach = np.where(whole, near[:, -1] - 1, everywhere)
        asked = []
        edges = shared.value.x.get(f, shared.value.none)
        strip = cell // shared.value.width
        lines = shared.value.y.get((f, strip), shared.value.none)
        at = cell % shared.value.width
        low_x, high_x = (edges[strip - 1] if strip else -(1 << 62)), (edges[strip] if strip < len(edges) else 1 << 62)
        low_y, high_y = (lines[at - 1] if at else -(1 << 62)), (lines[at] if at < len(lines) else 1 << 62)
        held = (x - reach > low_x) & (x + reach <= high_x) & (y - reach > low_y) & (y + reach <= high_y)
        for i in range(len(x)):
            asked.append([] if held[i] else [c for c in shared.value.reached(f, int(x[i]), int(y[i]), int(reach[i])) if c != cell])
        return pa.table({"f": group.column("f"), "id": group.column("id"), "x": group.column("x"), "y": group.column("y"), "cell": group.column("cell"),
                         "near": pa.array([v[v >= 0].tolist() for v in near], pa.list_(pa.int64())), "asked": pa.array(asked, pa.list_(pa.int64()))})

    kind = "f int, id long, x long, y long, cell long"
    placed = points.select("f", "id", "x", "y").mapInArrow(place, kind)
    first = materialise(placed.groupBy("f", "cell").applyInArrow(inside, f"{kind}, near array<long>, asked array<long>"), "near")

    def answer(asking: pa.Table, own: pa.Table) -> pa.Table:
        x, y, ox, oy = (t.column(c).to_numpy() for t in (asking, own) for c in ("x", "y"))
        near = _nearest(x, y, ox, oy, k)
        return pa.table({"f": asking.column("f"), "id": asking.column("id"), "near": pa.array([v[v >= 0].tolist() for v in near], pa.list_(pa.int64()))})

    open_rows = first.where(F.size("asked") > 0)
    asking = open_rows.select("f", F.explode("asked").alias("cell"), "id", "x", "y")
    answers = asking.groupBy("f", "cell").cogroup(first.select("f", "cell", "x", "y").groupBy("f", "cell")).applyInArrow(answer, "f int, id long, near array<long>")
    merged = open_rows.select("f", "id", "near").unionByName(answers).groupBy("f", "id").agg(F.array_sort(F.flatten(F.collect_list("near"))).alias("near"))
    kth = F.get("near", k - 1).alias("r")
    found = first.where(F.size("asked") == 0).select("f", "id", "x", "y", kth)
    return found.unionByName(open_rows.select("f", "id", "x", "y").join(merged, ["f", "id"]).select("f", "id", "x", "y", kth))


def _counts(radii: DataFrame) -> DataFrame:
    """f, id, axis and the number ``n`` of other rows that are nearer than ``r`` along the axis.

    An interval's lower end sorts before the points of its value and its upper end behind them.
    """
    reach = F.greatest(F.col("r") - 1, F.lit(0))  # rows in one place are 0 apart
    ends = [F.struct(F.lit(a).alias("axis"), (F.col(c) + F.lit(sign).cast("long") * reach).alias("v"), F.lit(kind).alias("kind"))
            for a, c in enumerate("xy") for kind, sign in ((0, -1), (1, 0), (2, 1))]
    events = radii.select("f", "id", F.explode(F.array(*ends)).alias("e")).select("f", "e.axis", "e.v", "e.kind", "id")
    ordered = events.repartitionByRange("f", "axis", "v").sortWithinPartitions("f", "axis", "v", "kind")

    def run(batches):
        seen = 0
        for batch in batches:
            kind = batch.column(3).to_numpy()
            count = seen + np.cumsum(kind == 1)
            seen = int(count[-1]) if len(count) else seen
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), pa.array(kind), pa.array(count, pa.int64())], names=["f", "axis", "id", "kind", "count"])

    # the running number of a partition's points is stored with the partition's number
    counted = ordered.mapInArrow(run, "f int, axis int, id long, kind int, count long").withColumn("part", F.spark_partition_id())
    counted = materialise(counted, "counted")
    sizes = counted.groupBy("part").agg(F.max("count").alias("size")).collect()  # one row a partition of the shuffle
    before, offsets = 0, []
    for row in sorted(sizes, key=lambda r: r["part"]):
        offsets.append((row["part"], before))
        before += row["size"]
    shifts = radii.sparkSession.createDataFrame(offsets, "part int, offset long")
    whole = counted.where("kind <> 1").join(F.broadcast(shifts), "part").withColumn("count", (F.col("count") + F.col("offset")) * (F.col("kind") - 1))
    return whole.groupBy("f", "id", "axis").agg((F.sum("count") - 1).alias("n"))


def neighbour_information(df: DataFrame, features: list[str] | str, target: str, key: str = "sample_id", k: int = 3) -> DataFrame:
    """feature, score: mutual information in nats of each feature and the target, at least 0.

    ``features`` is a list of columns, or one vector column whose features are named by position.  Values are divided by
    their standard deviation and get noise of 1e-10 from a hash of ``key``, so equal values are told apart, by the same
    amounts in every run if keys differ.  Only rows where both numbers are known count; a feature with at most k of them
    has the score 0.
    """
    points = _points(df, features, target, key)
    sizes = {r["f"]: r["n"] for r in points.groupBy("f").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a feature
    enough = [f for f, n in sizes.items() if n > k]
    width = len(features) if not isinstance(features, str) else max(sizes, default=-1) + 1
    names = features if not isinstance(features, str) else [str(i) for i in range(width)]
    every = df.sparkSession.createDataFrame(list(enumerate(names)), "f int, feature string")
    if not enough:
        return every.select("feature", F.lit(0.0).alias("score"))
    chosen = points.where(F.col("f").isin(*enough))
    radii = materialise(_radii(chosen, _plane(chosen, max(sizes.values())), k), "radii")
    means = _counts(radii).groupBy("f").agg(F.sum(digamma(F.col("n") + 1)).alias("s"), F.count(F.lit(1)).alias("pairs"))
    rows = F.col("pairs") / 2  # two axes
    score = F.greatest(F.lit(0.0), digamma(rows) + digamma(F.lit(k)) - F.col("s") / rows)
    return every.join(means, "f", "left").select("feature", F.coalesce(score, F.lit(0.0)).alias("score"))
