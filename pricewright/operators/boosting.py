"""Boosted trees with second-order gains: level by level or best leaf first, with early stopping by patience.

Features become bin numbers once and are written.  For each round the open nodes of one tree get histograms, sums of
gradients and counts per (node, feature, bin): a task adds up its rows in arrays, Spark sums the arrays of all tasks in blocks.
Only the smaller of two siblings is counted; the other is its parent less that.  Gradients are integers on a common
scale whose sums a double holds exactly, so that they are the same in any order.

What reaches the driver is the histograms of some nodes, ``CELLS`` cells at a time, whatever the number of rows.
Predictions are written with the rows every few rounds, so a lost executor costs its tasks only.

Rows of at most ``LOCAL_BYTES`` are boosted inside one task, where a round costs no job; the sums are exact, so the trees are the same.
"""

from __future__ import annotations

import heapq
import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from pricewright.operators.folds import fold_of
from pricewright.operators.reduce import number_rows
from pricewright.session import materialise

CELLS = 1 << 20  # cells of the histograms that one scan brings to the driver
TASK_BYTES = 2 << 20  # rows that are worth a task, some 64 bytes and a byte a feature each: many small scans make a tree
LOCAL_BYTES = 64 << 20  # rows, measured alike, that one task boosts by itself
GATHER = 1 << 18  # bin numbers that such a task counts at once
WRITE_BYTES = 64 << 20  # rows that a task writes, at most
REWRITE = 8  # rounds after which predictions are written with the rows
MAX_BINS = 256  # a bin number is one byte
SORT_BYTES = 32 << 20  # values that a task sorts at once when it looks for thresholds
FAN = 16  # summaries of sorted values that become one
_BITS = 30  # of a gradient's integer, at most
_BLOCK = 1 << 15  # cells of a histogram that travel in a row


# ---- trees ----

@dataclass
class Tree:
    """Nodes in arrays; a row goes left while its value is at most the threshold, and without a value."""

    feature: list[int] = field(default_factory=list)  # -1 for a leaf
    bin: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    path: list[int] = field(default_factory=list)  # 1 for the root, 2p and 2p + 1 for the children of p

    def arrays(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(x) for x in (self.feature, self.bin, self.threshold, self.left, self.right, self.value))


def _leaf_of(tree: tuple[np.ndarray, ...], n: int, goes_right) -> np.ndarray:
    """Index of the node at which each of ``n`` rows ends; ``goes_right(rows, nodes)`` decides."""
    feature, left, right = tree[0], tree[3], tree[4]
    at, moving = np.zeros(n, np.int64), np.arange(n)
    while True:
        moving = moving[feature[at[moving]] >= 0]
        if not len(moving):
            return at
        node = at[moving]
        at[moving] = np.where(goes_right(moving, node), right[node], left[node])


def _by_bin(tree, bins: np.ndarray) -> np.ndarray:
    return _leaf_of(tree, len(bins), lambda rows, node: bins[rows, tree[0][node]] > tree[1][node])


def _by_value(tree, x: np.ndarray) -> np.ndarray:
    return _leaf_of(tree, len(x), lambda rows, node: x[rows, tree[0][node]] > tree[2][node])


# ---- settings ----

class _Settings(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    keyCol = Param(Params._dummy(), "keyCol", "column whose hash draws rows", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "number of trees, at most", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of a tree's values that is added", TypeConverters.toFloat)
    growth = Param(Params._dummy(), "growth", "level: all nodes of a level; leaf: the best leaf first", TypeConverters.toString)
    maxDepth = Param(Params._dummy(), "maxDepth", "splits above a leaf, at most; 0 for any number", TypeConverters.toInt)
    numLeaves = Param(Params._dummy(), "numLeaves", "leaves of a tree, at most; 0 for any number", TypeConverters.toInt)
    regAlpha = Param(Params._dummy(), "regAlpha", "L1 penalty of leaf values", TypeConverters.toFloat)
    regLambda = Param(Params._dummy(), "regLambda", "L2 penalty of leaf values", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "smallest gain of a split", TypeConverters.toFloat)
    minChildWeight = Param(Params._dummy(), "minChildWeight", "smallest sum of hessians of a child", TypeConverters.toFloat)
    minChildRows = Param(Params._dummy(), "minChildRows", "fewest rows of a child", TypeConverters.toInt)
    minSplitRows = Param(Params._dummy(), "minSplitRows", "fewest rows of a node that is split", TypeConverters.toInt)
    subsample = Param(Params._dummy(), "subsample", "share of rows that a tree sees", TypeConverters.toFloat)
    featuresPerTree = Param(Params._dummy(), "featuresPerTree", "share of features that a tree sees", TypeConverters.toFloat)
    featuresPerNode = Param(Params._dummy(), "featuresPerNode", "all, or sqrt: as many features for each node, drawn anew", TypeConverters.toString)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, at most", TypeConverters.toInt)
    patience = Param(Params._dummy(), "patience", "rounds without gain after which to stop; 0 for never", TypeConverters.toInt)
    tolerance = Param(Params._dummy(), "tolerance", "what counts as gain", TypeConverters.toFloat)
    validation = Param(Params._dummy(), "validation", "share of rows that are held out for the error", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)

    def _defaults(self) -> None:
        self._setDefault(
            featuresCol="features", labelCol="label", predictionCol="prediction", keyCol="sample_id", maxIter=100, stepSize=0.1, growth="level", maxDepth=6,
            numLeaves=0, regAlpha=0.0, regLambda=0.0, gamma=0.0, minChildWeight=0.0, minChildRows=1, minSplitRows=2, subsample=1.0, featuresPerTree=1.0,
            featuresPerNode="all", maxBins=MAX_BINS, patience=0, tolerance=1e-4, validation=0.1, seed=42)

    def setting(self, name: str):
        return self.getOrDefault(name)


def soft(g, alpha: float):
    """A sum of gradients after the L1 penalty."""
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0.0)


@dataclass
class _Split:
    gain: float
    feature: int
    bin: int
    left_g: float
    left_n: int


@dataclass
class _Node:
    g: float
    n: int
    depth: int
    histogram: tuple[np.ndarray, np.ndarray] | None = None  # gradients and counts, features x bins
    split: _Split | None = None
    opened: bool = False  # its children are known


def _may_split(node: _Node, p: dict) -> bool:
    return node.n >= p["minSplitRows"] and not (p["maxDepth"] and node.depth >= p["maxDepth"])


def _largest(left_g: np.ndarray, left_n: np.ndarray, fit: np.ndarray, node: _Node, p: dict) -> tuple[float, int, int] | None:
    """The largest allowed gain of cuts (features x places) with these sums to their left, and the first place that has it.

    The gain is the sum of the children's scores less the parent's, where a score is T(G)**2 / (H + lambda) and T
    takes the L1 penalty off.
    """
    def score(g, n):
        return np.maximum(np.abs(g) - p["regAlpha"], 0.0) ** 2 / np.maximum(n + p["regLambda"], 1e-300)

    right_n, whole = node.n - left_n, float(score(np.float64(node.g), node.n))
    gain = score(left_g, left_n) + score(node.g - left_g, right_n) - whole
    least = max(p["minChildRows"], p["minChildWeight"], 1)
    gain[~(fit & (left_n >= least) & (right_n >= least))] = -np.inf
    row, place = divmod(int(gain.argmax()), gain.shape[1])
    best = float(gain[row, place])
    return (best, row, place) if best > max(0.0, 1e-12 * abs(whole)) and best >= p["gamma"] else None


def best_split(histogram, node: _Node, usable: np.ndarray, allowed: np.ndarray, p: dict) -> _Split | None:
    """The split with the largest gain, the first feature and bin of equals; None if none is allowed.

    ``usable`` says which bins have a bin to the right, ``allowed`` which features take part.
    """
    if not _may_split(node, p):
        return None
    chosen = np.flatnonzero(allowed)
    left_g, left_n = np.cumsum(histogram[0][chosen], axis=1), np.cumsum(histogram[1][chosen], axis=1)
    found = _largest(left_g, left_n, usable[chosen], node, p)
    if found is None:
        return None
    gain, row, cut = found
    return _Split(gain, int(chosen[row]), cut, float(left_g[row, cut]), int(left_n[row, cut]))


def split_of_rows(bin_numbers: np.ndarray, g: np.ndarray, features: np.ndarray, node: _Node, p: dict) -> _Split | None:
    """The same split from the rows of a node with fewer rows than a histogram has bins: cuts between rows in the order of a feature.

    Bins without a row have the gain of the bin before, which comes first.
    """
    if not _may_split(node, p) or node.n < 2:
        return None
    columns = np.ascontiguousarray(bin_numbers.T)
    order = np.argsort(columns, axis=1, kind="stable")
    columns = np.take_along_axis(columns, order, axis=1)
    left_g = np.cumsum(g[order], axis=1)[:, :-1]
    found = _largest(left_g, np.arange(1, node.n), columns[:, :-1] != columns[:, 1:], node, p)
    if found is None:
        return None
    gain, row, place = found
    return _Split(gain, int(features[row]), int(columns[row, place]), float(left_g[row, place]), place + 1)


class _Grower:
    """One tree: which nodes need histograms next, and which splits are made."""

    def __init__(self, p: dict, usable: np.ndarray, features: np.ndarray, tree: int):
        self.p, self.usable, self.features, self.tree = p, usable, features, tree
        self.nodes: dict[int, _Node] = {}
        self.limit = p["numLeaves"] or math.inf

    def allowed(self, path: int) -> np.ndarray:
        chosen = np.zeros(len(self.usable), bool)
        if self.p["featuresPerNode"] == "sqrt":
            draw = np.random.default_rng([self.p["seed"], self.tree, path])
            chosen[draw.choice(self.features, max(1, math.isqrt(len(self.features))), replace=False)] = True
        else:
            chosen[self.features] = True
        return chosen

    def see(self, path: int, histogram) -> None:
        node = self.nodes[path]
        node.split = best_split(histogram, node, self.usable, self.allowed(path), self.p)
        node.histogram = histogram if node.split else None

    def plant(self, histogram) -> None:
        own = self.features[0]
        self.nodes[1] = _Node(float(histogram[0][own].sum()), int(histogram[1][own].sum()), 0)
        self.see(1, histogram)

    def plan(self) -> tuple[list[int], list[int]]:
        """Splits in the order in which they are made, and nodes whose children must be known to go on.

        Best leaf first; with a budget no more nodes are opened ahead than could still be split.
        """
        root = self.nodes[1]
        heap = [(-root.split.gain, 1)] if root.split else []
        made, leaves = [], 1
        while heap and leaves < self.limit:
            _, path = heap[0]
            if not self.nodes[path].opened and leaves + 1 < self.limit:
                room = len(heap) if self.limit == math.inf else int(self.limit - leaves)
                return made, [q for _, q in sorted(heap)[:room] if not self.nodes[q].opened]
            heapq.heappop(heap)
            made.append(path)
            leaves += 1
            for child in (2 * path, 2 * path + 1):
                if child in self.nodes and self.nodes[child].split:
                    heapq.heappush(heap, (-self.nodes[child].split.gain, child))
        return made, []

    def open(self, paths: list[int]) -> list[int]:
        """Makes children; the smaller of two is returned to be counted, unless neither can be split."""
        wanted = []
        for path in paths:
            node = self.nodes[path]
            s = node.split
            self.nodes[2 * path] = left = _Node(s.left_g, s.left_n, node.depth + 1)
            self.nodes[2 * path + 1] = right = _Node(node.g - s.left_g, node.n - s.left_n, node.depth + 1)
            node.opened = True
            if max(left.n, right.n) >= max(2, self.p["minSplitRows"]) and not (self.p["maxDepth"] and left.depth >= self.p["maxDepth"]):
                wanted.append(2 * path if left.n <= right.n else 2 * path + 1)
            else:
                node.histogram = None
        return wanted

    def counted(self, path: int, histogram) -> None:
        """A child's histogram, which gives that of its sibling too."""
        parent, self.nodes[path // 2].histogram = self.nodes[path // 2].histogram, None
        self.see(path, histogram)
        self.see(path ^ 1, (parent[0] - histogram[0], parent[1] - histogram[1]))

    def _built(self, splits: set[int], thresholds: list[np.ndarray], with_values: bool) -> Tree:
        tree, todo = Tree(), [(1, self.nodes[1].g, self.nodes[1].n, -1, False)]
        while todo:
            path, g, n, parent, right = todo.pop()
            at = len(tree.feature)
            if parent >= 0:
                (tree.right if right else tree.left)[parent] = at
            s = self.nodes[path].split if path in splits else None
            value = float(-soft(g, self.p["regAlpha"]) / (n + self.p["regLambda"]) * self.p["stepSize"]) if with_values and n + self.p["regLambda"] > 0 else 0.0
            row = (s.feature, s.bin, float(thresholds[s.feature][s.bin]), s.gain) if s else (-1, 0, 0.0, 0.0)
            for column, x in zip((tree.feature, tree.bin, tree.threshold, tree.gain), row):
                column.append(x)
            tree.left.append(-1)
            tree.right.append(-1)
            tree.value.append(value)
            tree.rows.append(n)
            tree.path.append(path)
            if s:
                todo += [(2 * path + 1, g - s.left_g, n - s.left_n, at, True), (2 * path, s.left_g, s.left_n, at, False)]
        return tree

    def routes(self, thresholds) -> Tree:
        """All opened nodes, to lead rows to those that are counted."""
        return self._built({p for p, node in self.nodes.items() if node.opened}, thresholds, False)

    def finished(self, thresholds) -> Tree:
        return self._built(set(self.plan()[0]), thresholds, True)


# ---- rows ----

def _matrix(column, width: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _bin_matrix(column, width: int) -> np.ndarray:
    """The bytes of a column of ``width`` bytes a row, without an object for each row."""
    if not len(column):
        return np.empty((0, width), np.uint8)
    _, ends, data = column.buffers()
    start = int(np.frombuffer(ends, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset])
    return np.frombuffer(data, np.uint8, len(column) * width, start).reshape(-1, width)


def _added_up(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the sums of their weights."""
    order = np.argsort(values, kind="stable")
    values = values[order]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)
    return values[first], np.add.reduceat(weights[order], first) if len(first) else np.empty(0)


def _thinned(values: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` of some ordered values: the middles of as many runs of equal weight."""
    ends = np.cumsum(weights)
    middles = (np.arange(most) + 0.5) * (ends[-1] / most)
    at, n = np.unique(np.minimum(np.searchsorted(ends, middles), len(values) - 1), return_counts=True)
    return values[at], n * (ends[-1] / most)


class _Summary:
    """A feature's values and how often each comes: all of them while they are at most ``most``, then every so many-th.

    A part of the rows that is thinned moves a rank by at most half a run of it, and so does each time that ``FAN`` parts become one.
    """

    def __init__(self, most: int):
        self.most, self.whole, self.parts = most, True, []

    def add(self, values: np.ndarray, weights: np.ndarray) -> None:
        self.parts.append(self._kept(values, weights))
        if len(self.parts) == FAN:
            self.parts = [self.one()]

    def _kept(self, values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(values) <= self.most:
            return values, weights
        self.whole = False
        return _thinned(values, weights, self.most)

    def one(self) -> tuple[np.ndarray, np.ndarray]:
        return self._kept(*_added_up(*(np.concatenate([part[i] for part in self.parts]) if self.parts else np.empty(0) for i in (0, 1))))


def _thresholds(vectors: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Thresholds of each feature: its distinct values but the last if they are few, else sketched quantiles.

    One pass: a task sorts its rows, some ``SORT_BYTES`` at a time, and sends at most 20 x ``bins`` values of a feature with
    their weights, so a quantile's rank is off by some share of 1 / (20 x ``bins``); of few values all are sent, and it is exact.
    """
    most, rows = 20 * bins, max(1, SORT_BYTES // (8 * width))

    def summarise(batches):
        known, waiting = [_Summary(most) for _ in range(width)], []

        def take() -> None:
            x = np.concatenate(waiting).T.copy()
            waiting.clear()
            x.sort(axis=1)  # NaN last
            for j in range(width):
                values = x[j, :len(x[j]) - int(np.isnan(x[j]).sum())]
                first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.empty(0, np.int64)
                known[j].add(values[first], np.diff(np.r_[first, len(values)]).astype(float))

        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                waiting.append(_matrix(batch.column(0).slice(a, rows), width))
                if sum(map(len, waiting)) >= rows:
                    take()
        if waiting:
            take()
        for j, summary in enumerate(known):
            values, weights = summary.one()
            yield pa.RecordBatch.from_arrays(
                [pa.array([j], pa.int32()), pa.array([summary.whole]), pa.array([values], pa.list_(pa.float64())), pa.array([weights], pa.list_(pa.float64()))],
                names=["feature", "whole", "value", "weight"])

    shares = np.arange(1, bins) / bins

    def merge(group: pa.Table) -> pa.Table:
        whole = all(group.column("whole").to_pylist())
        values, weights = _added_up(*(group.column(c).combine_chunks().flatten().to_numpy() for c in ("value", "weight")))
        if whole and len(values) <= bins:
            cuts = values[:-1]
        else:
            ends = np.cumsum(weights)
            cuts = np.unique(values[np.minimum(np.searchsorted(ends, np.ceil(shares * ends[-1])), len(values) - 1)])
        return pa.table({"feature": group.column("feature").slice(0, 1), "cuts": pa.array([cuts], pa.list_(pa.float64()))})

    parts = vectors.select("x").mapInArrow(summarise, "feature int, whole boolean, value array<double>, weight array<double>")
    out = [np.empty(0)] * width
    for r in parts.groupBy("feature").applyInArrow(merge, "feature int, cuts array<double>").collect():  # fewer than ``bins`` numbers a feature
        out[r["feature"]] = np.array(r["cuts"], float)
    return out


def _byte_rows(b: np.ndarray) -> pa.Array:
    """A binary column of the rows of a matrix of bytes."""
    ends = np.arange(len(b) + 1, dtype=np.int32) * b.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(b), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(b)])


def _binned(vectors: DataFrame, thresholds: list[np.ndarray]) -> DataFrame:
    """x becomes one byte a feature: the number of thresholds below the value; rows without a value are in the first bin."""
    shared = vectors.sparkSession.sparkContext.broadcast(thresholds)  # fewer than MAX_BINS numbers a feature
    others = [c for c in vectors.columns if c != "x"]
    schema = StructType([vectors.schema[c] for c in others]).add("bins", "binary")

    def run(batches):
        cuts = shared.value
        for batch in batches:
            x = _matrix(batch.column(batch.schema.get_field_index("x")), len(cuts))
            b = np.empty(x.shape, np.uint8)
            for j, edges in enumerate(cuts):
                b[:, j] = np.searchsorted(edges, np.where(np.isnan(x[:, j]), -np.inf, x[:, j]), side="left")
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(c)) for c in others], _byte_rows(b)], names=[*others, "bins"])

    return vectors.mapInArrow(run, schema)


def _draw(hashes: np.ndarray, tree: int) -> np.ndarray:
    """A number in [0, 1) for each row and tree."""
    x = hashes.astype(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).astype(np.float64) / 2.0**64


@dataclass
class _Scan:
    """What a task needs to count some nodes: sent with every job, a few numbers a node."""

    trees: list  # since the predictions were written
    routes: tuple | None
    wanted: list[int]  # node indices of ``routes``
    tree: int
    subsample: float
    features: np.ndarray
    width: int
    bins: int
    scale: float
    loss: bool


def _counts(rows: DataFrame, scan: _Scan) -> tuple[dict[int, tuple[np.ndarray, np.ndarray]], float]:
    """Histograms of the wanted nodes over all features, and the mean squared error of the held-out rows."""
    def run(batches):
        chosen, cells, nodes = scan.features, len(scan.features) * scan.bins, len(scan.wanted)
        g_sum, n_sum = np.zeros((nodes, len(chosen), scan.bins)), np.zeros((nodes, len(chosen), scan.bins), np.int64)
        place = np.full(1 if scan.routes is None else len(scan.routes[0]), -1, np.int64)
        place[scan.wanted] = np.arange(nodes)
        error, held_rows = 0.0, 0
        for batch in batches:
            held = batch.column("held").to_numpy(zero_copy_only=False)
            y, p = batch.column("y").to_numpy(), batch.column("p").to_numpy(zero_copy_only=False).copy()
            bins = _bin_matrix(batch.column("bins"), scan.width)
            for tree in scan.trees:
                p += tree[5][_by_bin(tree, bins)]
            if scan.loss:
                error += float(((y - p)[held] ** 2).sum())
                held_rows += int(held.sum())
            seen = ~held
            if scan.subsample < 1:
                seen &= _draw(batch.column("h").to_numpy(), scan.tree) < scan.subsample
            at = _by_bin(scan.routes, bins) if scan.routes is not None else np.zeros(len(y), np.int64)
            g = np.rint((p - y) * scan.scale)
            mine = np.flatnonzero(seen & (place[at] >= 0))
            if len(mine):  # a feature at a time: its column, its keys and its cells stay in the processor's cache
                start, weight, columns = place[at[mine]] * scan.bins, g[mine], np.ascontiguousarray(bins[mine].T)
                for j, feature in enumerate(chosen):
                    key = start + columns[feature]
                    g_sum[:, j] += np.bincount(key, weight, nodes * scan.bins).reshape(nodes, -1)
                    n_sum[:, j] += np.bincount(key, minlength=nodes * scan.bins).reshape(nodes, -1)
        g_sum, n_sum = g_sum.reshape(nodes, cells), n_sum.reshape(nodes, cells)
        for i in range(len(scan.wanted)):
            for block, at in enumerate(range(0, cells, _BLOCK)):
                yield row(i * blocks + block, np.r_[g_sum[i, at:at + _BLOCK], n_sum[i, at:at + _BLOCK]])
        if scan.loss:
            yield row(-1, np.array([error, held_rows]))

    def row(key: int, numbers: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key], pa.int32()), pa.array([numbers.astype(np.float64).tobytes()], pa.binary())], names=["key", "part"])

    def added(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(p.as_py()) for p in group.column("part"))
        return pa.table({"key": group.column("key").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})

    blocks = -(-len(scan.features) * scan.bins // _BLOCK)
    parts = rows.mapInArrow(run, "key int, part binary").groupBy("key").applyInArrow(added, "key int, part binary")
    found = {r["key"]: np.frombuffer(r["part"]) for r in parts.collect()}  # CELLS cells
    out, wide = {}, (len(scan.features), scan.bins)
    for i, node in enumerate(scan.wanted):
        halves = [np.split(found[i * blocks + block], 2) for block in range(blocks)]
        g, n = np.zeros((scan.width, scan.bins)), np.zeros((scan.width, scan.bins), np.int64)
        g[scan.features] = np.concatenate([h[0] for h in halves]).reshape(wide) / scan.scale
        n[scan.features] = np.concatenate([h[1] for h in halves]).reshape(wide)
        out[node] = (g, n)
    error, held_rows = found.get(-1, (0.0, 0.0))
    return out, float(error / held_rows) if held_rows else math.nan


def stops(losses: list[float], patience: int, tolerance: float) -> bool:
    """Whether the last loss is no gain over any of the ``patience`` before it."""
    return patience > 0 and len(losses) > patience and all(losses[-1] + tolerance >= x for x in losses[-1 - patience:-1])


@dataclass
class BinnedRows:
    """A written table (key, y, bins, kept columns) and what its bin numbers mean."""

    rows: DataFrame
    thresholds: list[np.ndarray]
    width: int
    tasks: int  # that a scan is worth


def bin_rows(dataset: DataFrame, features: str, label: str, key: str, max_bins: int = MAX_BINS, keep: tuple[str, ...] = ()) -> BinnedRows:
    """Rows with a label, their features as bin numbers; thresholds come from all of these rows."""
    vectors = dataset.select(F.col(key).alias("key"), F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x"), *keep)
    vectors = vectors.where(F.col("y").isNotNull() & ~F.isnan("y"))
    width, n = vectors.agg(F.max(F.size("x")), F.count(F.lit(1))).first()
    if not n:
        raise ValueError("no rows to fit on")
    thresholds, tasks = _thresholds(vectors, width, max_bins), max(1, math.ceil(n * (width + 64) / TASK_BYTES))
    binned = _binned(vectors, thresholds)
    if tasks > vectors.rdd.getNumPartitions():  # splits as they come are few or uneven, and every scan waits for the longest
        cores = dataset.sparkSession.sparkContext.defaultParallelism
        binned = binned.repartition(min(tasks, max(4 * cores, math.ceil(tasks * TASK_BYTES / WRITE_BYTES))))
    return BinnedRows(materialise(binned, "binned").coalesce(tasks), thresholds, width, tasks)


def _added(rows: DataFrame, trees: list[Tree], width: int) -> DataFrame:
    """Rows with the trees' values added to their predictions."""
    arrays, at = [t.arrays() for t in trees], rows.columns.index("p")

    def run(batches):
        for batch in batches:
            p = batch.column("p").to_numpy(zero_copy_only=False).copy()
            bins = _bin_matrix(batch.column("bins"), width)
            for tree in arrays:
                p += tree[5][_by_bin(tree, bins)]
            yield batch.set_column(at, "p", pa.array(p))

    return rows.mapInArrow(run, rows.schema)


# ---- boosting ----

class _Spread:
    """Rows in a table, counted by a job; what it counts is added up on the driver."""

    def __init__(self, rows: DataFrame, thresholds: list[np.ndarray], width: int, bins: int, tasks: int):
        self.rows, self.thresholds, self.width, self.bins, self.tasks = rows, thresholds, width, bins, tasks
        self.per = max(1, CELLS // (width * bins))

    def add(self, trees: list[Tree]) -> None:
        self.rows = materialise(_added(self.rows, trees, self.width), "boosted").coalesce(self.tasks)

    def largest_error(self) -> float:
        return self.rows.agg(F.max(F.abs(F.col("y") - F.col("p")))).first()[0] or 0.0

    def root(self, trees: list[Tree], number: int, subsample: float, features: np.ndarray, scale: float, loss: bool):
        """Histogram of all rows that a tree sees, and the error of the held-out rows under the trees since they were written."""
        self.scan = _Scan([t.arrays() for t in trees], None, [0], number, subsample, features, self.width, self.bins, scale, loss)
        found, error = _counts(self.rows, self.scan)
        return found[0], error

    def count(self, grower: _Grower, wanted: list[int]) -> None:
        routes = grower.routes(self.thresholds)
        index = {path: i for i, path in enumerate(routes.path)}
        self.scan.loss, self.scan.routes = False, routes.arrays()
        for a in range(0, len(wanted), self.per):
            self.scan.wanted = [index[path] for path in wanted[a:a + self.per]]
            found, _ = _counts(self.rows, self.scan)
            for path in wanted[a:a + self.per]:
                grower.counted(path, found[index[path]])


class _Held:
    """Rows in the arrays of one task; each open node knows its rows, so that a tree reads a row once a level."""

    def __init__(self, y, p, h, held, bin_numbers: np.ndarray, bins: int):
        self.y, self.p, self.h, self.held, self.bin_numbers, self.bins = y, p, h, held, bin_numbers, bins
        self.now, self.known = p.copy(), 0  # predictions, and how many of the trees since the last ``add`` are in them

    def add(self, trees: list[Tree]) -> None:
        self._follow([t.arrays() for t in trees])
        self.p, self.known = self.now.copy(), 0

    def _follow(self, trees: list) -> None:
        for tree in trees[self.known:]:
            self.now += tree[5][_by_bin(tree, self.bin_numbers)]
        self.known = len(trees)

    def largest_error(self) -> float:
        return float(np.abs(self.y - self.p).max())

    def root(self, trees: list[Tree], number: int, subsample: float, features: np.ndarray, scale: float, loss: bool):
        self._follow([t.arrays() for t in trees])
        error = float(((self.y - self.now)[self.held] ** 2).sum()) / int(self.held.sum()) if loss and self.held.any() else math.nan
        seen = ~self.held
        if subsample < 1:
            seen &= _draw(self.h, number) < subsample
        self.g = np.rint((self.now - self.y) * scale) / scale  # whole numbers of 1 / scale, a power of two
        self.features, self.seen = features, self.bin_numbers[:, features]
        self.rows = {1: np.flatnonzero(seen)}
        return self._histogram(self.rows[1]), error

    def _histogram(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width, chosen = self.bin_numbers.shape[1], len(self.features)
        cells, start = chosen * self.bins, np.arange(chosen) * self.bins
        g_sum, n_sum, step = np.zeros(cells), np.zeros(cells, np.int64), max(1, GATHER // chosen)
        for a in range(0, len(rows), step):
            some = rows[a:a + step]
            key = (self.seen[some] + start).ravel()
            g_sum += np.bincount(key, np.repeat(self.g[some], chosen), cells)
            n_sum += np.bincount(key, minlength=cells)
        if chosen == width:
            return g_sum.reshape(width, -1), n_sum.reshape(width, -1)
        g, n = np.zeros((width, self.bins)), np.zeros((width, self.bins), np.int64)
        g[self.features], n[self.features] = g_sum.reshape(chosen, -1), n_sum.reshape(chosen, -1)
        return g, n

    def _part(self, grower: _Grower, path: int) -> np.ndarray:
        """The rows of a node: those of its parent are dealt to both children when the first of them is asked for."""
        if path not in self.rows:
            parent, split = self._part(grower, path // 2), grower.nodes[path // 2].split
            right = self.bin_numbers[parent, split.feature] > split.bin
            first = path & ~1
            self.rows[first], self.rows[first + 1] = parent[~right], parent[right]
            del self.rows[path // 2]
        return self.rows[path]

    def _split(self, grower: _Grower, path: int) -> _Split | None:
        node, rows = grower.nodes[path], self._part(grower, path)
        if grower.p["featuresPerNode"] == "all":
            return split_of_rows(self.seen[rows], self.g[rows], self.features, node, grower.p)
        features = np.flatnonzero(grower.allowed(path))
        return split_of_rows(self.bin_numbers[rows[:, None], features], self.g[rows], features, node, grower.p)

    def count(self, grower: _Grower, wanted: list[int]) -> None:
        """Small nodes, and nodes with few features each, are split by their rows; of others a parent's histogram gives that of the larger child."""
        for path in wanted:
            if grower.p["featuresPerNode"] != "all" or 2 * grower.nodes[path ^ 1].n <= self.bins:
                for child in (path, path ^ 1):
                    grower.nodes[child].split = self._split(grower, child)
                grower.nodes[path // 2].histogram = None
            else:
                grower.counted(path, self._histogram(self._part(grower, path)))


def _boosted(rows: "_Spread | _Held", p: dict, thresholds: list[np.ndarray], width: int, n: int, bins: int) -> tuple[list[Tree], list[float]]:
    """The trees, and the held-out errors, of ``n`` rows that are not held out."""
    usable = np.arange(bins) < np.array([len(t) for t in thresholds])[:, None]
    draw = np.random.default_rng(p["seed"])
    trees: list[Tree] = []
    written, losses, scale = 0, [], None
    for number in range(p["maxIter"] + 1):
        if number - written >= REWRITE:
            rows.add(trees[written:])
            written, scale = number, None
        if scale is None:
            room = rows.largest_error() * (1 + p["stepSize"]) ** REWRITE  # errors may grow meanwhile
            scale = 2.0 ** (min(_BITS, 52 - math.ceil(math.log2(n + 1))) - math.ceil(math.log2(room))) if room > 0 else 1.0
        features = np.sort(draw.choice(width, max(1, math.ceil(width * p["featuresPerTree"] - 1e-9)), replace=False))
        if number == p["maxIter"] and not p["patience"]:
            break
        found, loss = rows.root(trees[written:], number, p["subsample"], features, scale, bool(p["patience"]))
        if p["patience"] and trees:
            losses.append(loss)
            if stops(losses, p["patience"], p["tolerance"]):
                break
        if number == p["maxIter"]:
            break
        grower = _Grower(p, usable, features, number)
        grower.plant(found)
        while paths := grower.plan()[1]:
            rows.count(grower, grower.open(paths))
        trees.append(grower.finished(thresholds))
    return trees, losses


def _bins(thresholds: list[np.ndarray]) -> int:
    return max(2, 1 + max(map(len, thresholds)))


def _boosted_by_jobs(rows: DataFrame, p: dict, thresholds: list[np.ndarray], width: int, n: int, tasks: int) -> tuple[list[Tree], list[float]]:
    bins = _bins(thresholds)
    return _boosted(_Spread(rows, thresholds, width, bins, tasks), p, thresholds, width, n, bins)


def _boosted_in_a_task(rows: DataFrame, p: dict, thresholds: list[np.ndarray], width: int, n: int, tasks: int) -> tuple[list[Tree], list[float]]:
    def run(batches):
        parts = [(b.column("y").to_numpy(), b.column("p").to_numpy(zero_copy_only=False), b.column("h").to_numpy(),
                  b.column("held").to_numpy(zero_copy_only=False), _bin_matrix(b.column("bins"), width)) for b in batches]
        if parts:
            bins = _bins(thresholds)
            held = _Held(*map(np.concatenate, zip(*parts)), bins)
            parts.clear()
            trees, losses = _boosted(held, p, thresholds, width, n, bins)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*range(len(trees)), len(trees)], pa.int32()), pa.array([*(json.dumps(asdict(t)) for t in trees), json.dumps(losses)], pa.string())],
                names=["number", "tree"])

    found = [r["tree"] for r in sorted(rows.coalesce(1).mapInArrow(run, "number int, tree string").collect(), key=lambda r: r["number"])]  # one model
    return [Tree(**json.loads(t)) for t in found[:-1]], json.loads(found[-1])


# ---- estimator and model ----

class BoostedTrees(Estimator, _Settings, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted regression trees on a vector column; squared error, so the hessian of a row is 1.

    ``growth="level"`` splits every node of a level that has an allowed split, down to ``maxDepth``; ``growth="leaf"``
    always splits the leaf with the largest gain, until there are ``numLeaves``.  With ``patience`` a share of rows,
    drawn by their key, is held out, and boosting ends when their error has not fallen by ``tolerance`` below any of
    the last ``patience`` errors; all trees up to there are kept.  Rows without a label take no part; a missing
    value counts as smaller than all others.
    """

    @keyword_only
    def __init__(self, **settings):
        super().__init__()
        self._defaults()
        self._set(**self._input_kwargs)

    def transformSchema(self, schema: StructType) -> StructType:
        if not isinstance(schema[self.getFeaturesCol()].dataType, VectorUDT):
            raise TypeError(f"{self.getFeaturesCol()} must be a vector")
        if not isinstance(schema[self.getLabelCol()].dataType, NumericType):
            raise TypeError(f"{self.getLabelCol()} must be a number")
        p = self._values()
        if p["growth"] not in ("level", "leaf") or p["featuresPerNode"] not in ("all", "sqrt") or not 2 <= p["maxBins"] <= MAX_BINS:
            raise ValueError("growth is level or leaf, featuresPerNode all or sqrt, maxBins from 2 to 256")
        if p["growth"] == "leaf" and p["numLeaves"] < 2:
            raise ValueError("growth by leaf needs numLeaves")
        if p["growth"] == "level" and p["maxDepth"] < 1:
            raise ValueError("growth by level needs maxDepth")
        return StructType(schema.fields).add(self.getPredictionCol(), "double")

    def _values(self) -> dict:
        return {x.name: self.getOrDefault(x) for x in self.params}

    def _fit(self, dataset: DataFrame) -> "BoostedTreesModel":
        self.transformSchema(dataset.schema)
        return self.fit_binned(bin_rows(dataset, self.getFeaturesCol(), self.getLabelCol(), self.setting("keyCol"), self.setting("maxBins")))

    def fit_binned(self, binned: "BinnedRows", where: Column | None = None) -> "BoostedTreesModel":
        """A model of the rows, or of those that meet a condition on the kept columns; several fits may share the bins."""
        p, thresholds, width = self._values(), binned.thresholds, binned.width
        if p["growth"] == "level":
            p["numLeaves"] = 0
        held = (fold_of(F.col("key"), round(1 / p["validation"]), seed="validation") == 0) if p["patience"] else F.lit(False)
        rows = binned.rows if where is None else binned.rows.where(where)
        rows = rows.select("y", F.xxhash64("key", F.lit(p["seed"])).alias("h"), held.alias("held"), "bins")
        if p["patience"]:  # each round would take the digest of every key again
            rows = materialise(rows, "held").coalesce(binned.tasks)
        base, n = rows.where("NOT held").agg(F.avg("y"), F.count(F.lit(1))).first()
        if not n:
            raise ValueError("no rows to fit on")
        rows = rows.withColumn("p", F.lit(float(base)))
        boost = _boosted_in_a_task if binned.tasks * TASK_BYTES <= LOCAL_BYTES else _boosted_by_jobs
        trees, losses = boost(rows, p, thresholds, width, n, binned.tasks)
        model = BoostedTreesModel(float(base), trees, losses, width)
        return self._copyValues(model)


class BoostedTreesModel(Model, _Settings, MLWritable, MLReadable):
    """Trees over a base value; adds the prediction column to a frame with the vector column."""

    def __init__(self, base: float = 0.0, trees: list[Tree] | None = None, losses: list[float] | None = None, width: int = 0):
        super().__init__()
        self._defaults()
        self.base, self.trees, self.losses, self.width = base, trees or [], losses or [], width

    @property
    def featureImportances(self):
        """Share of all gains that each feature's splits have."""
        from pyspark.ml.linalg import Vectors

        total = np.zeros(self.width)
        for tree in self.trees:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    total[feature] += gain
        return Vectors.dense(total / total.sum() if total.sum() else total)

    def transformSchema(self, schema: StructType) -> StructType:
        if not isinstance(schema[self.getFeaturesCol()].dataType, VectorUDT):
            raise TypeError(f"{self.getFeaturesCol()} must be a vector")
        return StructType(schema.fields).add(self.getPredictionCol(), "double")

    def _scores(self, staged: bool):
        trees, base, width = [t.arrays() for t in self.trees], self.base, self.width

        @F.arrow_udf("array<double>" if staged else "double")
        def score(x: pa.Array) -> pa.Array:
            matrix = _matrix(x, width)
            p, stages = np.full(len(matrix), base), []
            for tree in trees:
                p = p + tree[5][_by_value(tree, matrix)]
                if staged:
                    stages.append(p)
            return number_rows(np.array(stages).T if stages else np.empty((len(p), 0))) if staged else pa.array(p)

        return score(vector_to_array(self.getFeaturesCol()))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        self.transformSchema(dataset.schema)
        return dataset.withColumn(self.getPredictionCol(), self._scores(False))

    def evaluateEachIteration(self, dataset: DataFrame) -> list[float]:
        """Mean squared error after each tree, in one pass over the rows."""
        y = F.col(self.getLabelCol()).cast("double")
        staged = dataset.where(y.isNotNull()).select(y.alias("y"), self._scores(True).alias("p"))
        errors = [F.avg(F.pow(F.col("y") - F.col("p")[i], 2)) for i in range(len(self.trees))]
        return list(staged.agg(*errors).first()) if errors else []

    def nodes(self, spark) -> DataFrame:
        """One row a node: tree, path, feature and threshold (of splits), gain, rows and value."""
        rows = [(i, t.path[j], *((t.feature[j], t.threshold[j], t.gain[j]) if t.feature[j] >= 0 else (None, None, None)), t.rows[j], t.value[j])
                for i, t in enumerate(self.trees) for j in range(len(t.path))]
        return spark.createDataFrame(rows, "tree int, path long, feature int, threshold double, gain double, rows long, value double")

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: BoostedTreesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark, m = self.sparkSession, self.model
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"base": m.base, "losses": m.losses, "width": m.width})
        rows = [(i, json.dumps(asdict(t))) for i, t in enumerate(m.trees)]
        spark.createDataFrame(rows, "number int, tree string").coalesce(1).write.parquet(f"{path}/trees")


class _ModelReader(MLReader):
    def load(self, path: str) -> BoostedTreesModel:
        spark = self.sparkSession
        about = DefaultParamsReader.loadMetadata(path, spark)
        rows = spark.read.parquet(f"{path}/trees").orderBy("number").collect()  # the trees of one model
        model = BoostedTreesModel(about["base"], [Tree(**json.loads(r["tree"])) for r in rows], about["losses"], about["width"])
        model._resetUid(about["uid"])
        DefaultParamsReader.getAndSetParams(model, about)
        return model
