"""Approximate nearest neighbours over balanced posting lists.

Centroids come from balanced k-means on a bounded sample and are searched through a graph that every task holds in
memory.  A vector joins the lists of all centroids that are nearly as near as its nearest one, unless a list that it
has joined lies closer to that centroid; so vectors at a boundary are found from both sides.  A query reads the lists
whose centroids are within a ratio of its nearest centroid's distance.  The ratio is set by recall: a few sampled
queries are compared with all rows, and their true neighbours have to be in the lists that they read.
Long lists are cut into chunks, and so are the queries that read one, so no task holds all of either.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewright.session import materialise

SAMPLE = 10_000  # vectors that centroids and graph are fitted on
LISTS = 0.8  # times the root of the number of vectors: centroids and list lengths grow alike
MOST_LISTS = 2048
REPLICAS, BOUNDARY = 2, 1.03  # a vector joins so many lists at most, whose centroids are at most so much farther
LINKS = 24  # neighbours of a centroid in the graph
CHUNK = 8192  # vectors of a list that a task compares at once
QUERY_CHUNK = 8192  # queries of a list that a task compares at once
QUERIES, RECALL = 128, 0.97  # sampled queries whose true neighbours among all rows set the ratio, and the share to be reached


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances; where the product form would cancel, from the differences."""
    size = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None]
    square = size - 2 * (a @ b.T)
    i, j = np.nonzero(square < 1e-6 * size)
    for at in range(0, len(i), 1 << 16):
        x, y = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
        square[x, y] = ((a[x] - b[y]) ** 2).sum(axis=1)
    return np.sqrt(np.maximum(square, 0))


def balanced_centroids(x: np.ndarray, lists: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """k-means in which a list that is too long looks farther away, more so from round to round."""
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), lists, replace=False)].copy()
    penalty = np.zeros(lists)
    for k in range(rounds):
        d = _distances(x, centroids)
        near = (d + penalty).argmin(axis=1)
        size = np.bincount(near, minlength=lists)
        penalty += 0.05 * d.min(axis=1).mean() * np.clip(size * lists / len(x) - 1, -1, 2)
        for dim in range(x.shape[1]):
            total = np.bincount(near, x[:, dim], lists)
            centroids[:, dim] = np.where(size > 0, total / np.maximum(size, 1), centroids[:, dim])
    return centroids


@dataclass
class Lists:
    """Centroids, the graph over them, and how far beyond the nearest one a query reads."""

    centroids: np.ndarray
    links: np.ndarray
    entries: np.ndarray
    ratio: float = 1.0

    def nearest(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Distances and numbers of some ``beam`` near centroids of each row, nearest first: best-first search on the graph."""
        n, total = len(x), len(self.centroids)
        beam = min(beam, total)

        def distance(ids: np.ndarray) -> np.ndarray:
            gap = self.centroids[ids]
            gap -= x[:, None]
            return np.sqrt(np.einsum("nkd,nkd->nk", gap, gap))

        rows = np.arange(n)[:, None]
        seen = np.zeros((n, total), bool)
        ids = np.broadcast_to(self.entries, (n, len(self.entries))).copy()
        seen[rows, ids] = True
        dist, open_ = distance(ids), np.ones(ids.shape, bool)
        while True:
            rank = np.where(open_, dist, np.inf)
            pick = np.argsort(rank, axis=1)[:, :4]
            useful = np.isfinite(np.take_along_axis(rank, pick, 1))
            if not useful.any():
                break
            np.put_along_axis(open_, pick, False, 1)
            fresh = self.links[np.take_along_axis(ids, pick, 1)].reshape(n, -1)
            fresh = np.where(np.repeat(useful, self.links.shape[1], axis=1), fresh, fresh[:, :1])
            order = np.sort(fresh, axis=1)
            new = ~seen[rows, order] & np.concatenate([np.ones((n, 1), bool), order[:, 1:] != order[:, :-1]], axis=1)
            new &= np.repeat(useful.any(axis=1)[:, None], order.shape[1], axis=1)
            seen[rows, order] = True
            far = np.where(new, distance(order), np.inf)
            ids, dist = np.concatenate([ids, order], axis=1), np.concatenate([dist, far], axis=1)
            open_ = np.concatenate([open_, new], axis=1)
            keep = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, open_ = (np.take_along_axis(a, keep, 1) for a in (ids, dist, open_))
        order = np.argsort(dist, axis=1, kind="stable")
        return np.take_along_axis(dist, order, 1), np.take_along_axis(ids, order, 1)

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every list that a vector joins."""
        return _by_rows(self._homes, x)

    def _homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dist, ids = self.nearest(x, 32)
        chosen = np.zeros((len(x), min(REPLICAS, ids.shape[1])), np.int64)
        chosen[:, 0], count = ids[:, 0], np.ones(len(x), np.int64)
        rows, lists = [np.arange(len(x))], [ids[:, 0]]
        for k in range(1, ids.shape[1]):
            fine = np.isfinite(dist[:, k]) & (dist[:, k] <= BOUNDARY * dist[:, 0]) & (count < chosen.shape[1])
            for j in range(chosen.shape[1]):
                between = np.sqrt(((self.centroids[ids[:, k]] - self.centroids[chosen[:, j]]) ** 2).sum(axis=1))
                fine &= (j >= count) | (between > dist[:, k] * 0.5)
            at = np.flatnonzero(fine)
            chosen[at, count[at]] = ids[at, k]
            count[at] += 1
            rows.append(at)
            lists.append(ids[at, k])
        return np.concatenate(rows), np.concatenate(lists)

    def probes(self, x: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of every list that a query reads: all within the ratio, and more until ``least`` vectors are in them."""
        return _by_rows(lambda part: self._probes(part, sizes, least), x)

    def _probes(self, x: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        beam = 64
        while True:
            dist, ids = self.nearest(x, beam)
            inside = dist <= self.ratio * dist[:, :1]
            before = np.cumsum(np.where(np.isfinite(dist), sizes[ids], 0), axis=1)
            short = np.concatenate([np.ones((len(x), 1), bool), before[:, :-1] < least], axis=1)
            take = (inside | short) & np.isfinite(dist)
            if beam >= len(self.centroids) or not take[:, -1].any():
                row, at = np.nonzero(take)
                return row, ids[row, at]
            beam *= 2


def _by_rows(run, x: np.ndarray, most: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Results of ``run`` on some rows at a time, as a search holds the vectors of all centroids that it looks at."""
    parts = [run(x[a:a + most]) for a in range(0, max(1, len(x)), most)]
    return np.concatenate([row + k * most for k, (row, _) in enumerate(parts)]), np.concatenate([found for _, found in parts])


def fit_lists(x: np.ndarray, total: int, seed: int = 3) -> Lists:
    """Centroids and graph from a sample of ``total`` vectors."""
    lists = int(max(1, min(MOST_LISTS, len(x) // 8, math.ceil(LISTS * math.sqrt(total)))))
    x = np.unique(x, axis=0)
    lists = min(lists, len(x))
    centroids = balanced_centroids(x, lists)
    d = _distances(centroids, centroids)
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :max(1, min(LINKS, lists - 1))]
    rng = np.random.default_rng(seed)
    far = rng.integers(0, lists, (lists, 4))  # long links keep the graph in one piece
    ring = ((np.arange(lists) + 1) % lists)[:, None]
    found = Lists(centroids, np.concatenate([near, far, ring], axis=1) if lists > 1 else np.zeros((1, 1), np.int64), np.unique(rng.integers(0, lists, 8)))
    return found


def true_neighbours(rows: DataFrame, queries: np.ndarray, ids: np.ndarray, k: int) -> DataFrame:
    """q, v, score: the exact ``k`` nearest rows of each of a few queries, by number. Tasks keep the best ``k`` of theirs."""
    shared = rows.sparkSession.sparkContext.broadcast((queries, ids))

    def task(batches):
        (queries, ids), best, kept = shared.value, None, None
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                own, x = np.asarray(part.column(0)), _matrix(part.column(1))
                score = np.where(own[None] == ids[:, None], np.inf, _distances(queries, x))
                vectors = np.broadcast_to(x, (len(ids), *x.shape))
                if best is not None:
                    score, vectors = np.concatenate([best, score], axis=1), None
                near = np.argsort(score, axis=1, kind="stable")[:, :k]
                old = 0 if best is None else best.shape[1]
                picked = x[np.maximum(near - old, 0)]
                if kept is not None:
                    before = np.take_along_axis(kept, np.minimum(near, old - 1)[:, :, None], 1)
                    picked = np.where((near < old)[:, :, None], before, picked)
                best, kept = np.take_along_axis(score, near, 1), picked
        if best is not None:
            fine = np.isfinite(best)
            q, _ = np.nonzero(fine)
            yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(list(kept[fine]), pa.list_(pa.float64())), pa.array(best[fine])], names=["q", "v", "score"])

    found = rows.mapInArrow(task, "q long, v array<double>, score double")
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("score"))).where(F.col("rank") <= k).drop("rank")


def set_ratio(index: Lists, queries: np.ndarray, q: np.ndarray, neighbours: np.ndarray) -> None:
    """The smallest ratio at which the wanted share of ``neighbours`` of queries ``q`` is in lists that these read."""
    if len(index.centroids) == 1 or not len(q):
        return
    reach = _distances(queries, index.centroids)
    reach = reach / np.maximum(reach.min(axis=1, keepdims=True), 1e-12)
    row, home = index.homes(neighbours)
    needed = np.full(len(q), np.inf)
    np.minimum.at(needed, row, reach[q[row], home])
    needed.sort()
    index.ratio = float(needed[min(len(needed) - 1, math.ceil(RECALL * len(needed)))]) * (1 + 1e-6)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v: rows with an id whose vector has finite components only and is not zero, of the commonest length."""
    v = F.col(vector_col).cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.forall("v", fine) & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length[0] if length else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.empty((0, 0))


def nearest_neighbours(vectors: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found for every row where ``is_query`` holds.

    Nearness is the Euclidean distance in double precision on the given vectors; ties go to the smaller id.  Rows
    without an id, and vectors that are null, zero or hold null or non-finite components, or have another length than
    most, take no part.  A candidate is any row with another id; rows with one id count once, by the nearest of them.
    All candidates are returned where there are fewer than ``k``.  Other columns are ignored.
    Answers come from the posting lists alone.  A query whose lists hold fewer than ``k`` others, as many rows may share an
    id, reads all lists.
    """
    spark = vectors.sparkSession
    rows = materialise(usable(vectors, id_col, vector_col), "vectors")
    total = rows.count()
    packed = rows.orderBy(F.xxhash64("id"), "v").limit(SAMPLE).toArrow()
    sample = _matrix(packed.column("v"))
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lists = fit_lists(sample, total)
    if len(lists.centroids) > 1:
        some = rows.orderBy(F.xxhash64(F.lit("query"), "id"), "v").limit(QUERIES).toArrow()  # drawn without regard to the sample
        truth = true_neighbours(rows, queries := _matrix(some.column("v")), np.asarray(some.column("id")), k).toArrow()
        set_ratio(lists, queries, np.asarray(truth.column("q")), _matrix(truth.column("v")))
    index = spark.sparkContext.broadcast(lists)  # at most 2,048 centroids

    def place(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                row, home = index.value.homes(_matrix(part.column(1)))
                yield pa.RecordBatch.from_arrays([pa.array(home), *(part.column(c).take(pa.array(row)) for c in (0, 1))], names=["list", "id", "v"])

    postings = materialise(rows.mapInArrow(place, "list long, id long, v array<double>"), "postings")
    sizes = np.zeros(len(index.value.centroids), np.int64)
    for r in postings.groupBy("list").count().collect():
        sizes[r[0]] = r[1]
    found = _read(rows.where(is_query), postings, index, sizes, k, (k + 1) * REPLICAS)
    few = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    short = materialise(rows.where(is_query).join(few, F.col("id") == F.col("query_id"), "left_anti"), "short")
    if total > k and short.limit(1).count():
        again = _read(short, postings, index, sizes, k, int(sizes.sum()) + 1)
        found = found.join(short.select(F.col("id").alias("query_id")).distinct(), "query_id", "left_anti").unionByName(again)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("vec_id").alias(id_col), "score")


def _read(queries: DataFrame, postings: DataFrame, index, sizes: np.ndarray, k: int, least: int) -> DataFrame:
    """query_id, vec_id, score: the ``k`` nearest of the lists that each query reads, which hold ``least`` vectors at least."""
    spark = queries.sparkSession
    readers = np.zeros(len(sizes), np.int64)  # queries that read each list; at most all of them do
    if queries.count() > QUERY_CHUNK:
        shared_sizes = spark.sparkContext.broadcast(sizes)

        def count_readers(batches):
            total = np.zeros(len(shared_sizes.value), np.int64)
            for batch in batches:
                for a in range(0, batch.num_rows, 1024):
                    _, at = index.value.probes(_matrix(batch.slice(a, 1024).column(1)), shared_sizes.value, least)
                    total += np.bincount(at, minlength=len(total))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["list", "n"])

        for r in queries.mapInArrow(count_readers, "list long, n long").groupBy("list").agg(F.sum("n").alias("n")).collect():
            readers[r[0]] = r[1]
    parts = np.maximum(1, -(-readers // QUERY_CHUNK))
    chunks = spark.sparkContext.broadcast((sizes, np.maximum(1, -(-sizes // CHUNK))))

    def probe(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                row, at = index.value.probes(_matrix(part.column(1)), chunks.value[0], least)
                n = chunks.value[1][at]
                row, at = np.repeat(row, n), np.repeat(at, n)
                piece = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(piece), *(part.column(c).take(pa.array(row)) for c in (0, 1))], names=["list", "piece", "id", "v"])

    def nearest_of(own: np.ndarray, x: np.ndarray, q: int, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact distances of the k nearest rows, each id once, other than row ``q``."""
        score = np.sqrt(((x - vector) ** 2).sum(axis=1))
        fine = np.flatnonzero(own != q)
        order = fine[np.lexsort((own[fine], score[fine]))] if len(fine) <= 4 * k else _first(score, own, fine, 2 * k)
        _, first = np.unique(own[order], return_index=True)
        if len(first) < k and len(order) < len(fine):  # many rows of one id
            order = fine[np.lexsort((own[fine], score[fine]))]
            _, first = np.unique(own[order], return_index=True)
        best = order[np.sort(first)[:k]]
        return own[best], score[best]

    def compare(group: pa.Table) -> pa.Table:
        side = np.asarray(group.column("side"))
        ids, v = np.asarray(group.column("id")), _matrix(group.column("v"))
        own, x = ids[side == 1], v[side == 1]
        found = [(q, *nearest_of(own, x, q, vector)) for q, vector in zip(ids[side == 0], v[side == 0])]
        return pa.table({
            "query_id": pa.array(np.concatenate([np.full(len(i), q) for q, i, _ in found] or [np.empty(0)]).astype(np.int64)),
            "vec_id": pa.array(np.concatenate([i for _, i, _ in found] or [np.empty(0)]).astype(np.int64)),
            "score": pa.array(np.concatenate([s for _, _, s in found] or [np.empty(0)]).astype(np.float64))})

    pieces = F.lit([int(n) for n in chunks.value[1]]) if (chunks.value[1] > 1).any() else None
    spread = F.lit(0).cast("long") if pieces is None else F.pmod(F.xxhash64("id"), F.element_at(pieces, (F.col("list") + 1).cast("int")))
    left = queries.mapInArrow(probe, "list long, piece long, id long, v array<double>").withColumn("side", F.lit(0))
    right = postings.withColumns({"piece": spread, "side": F.lit(1)})
    # Each part of a list's queries meets all vectors of the list.
    split = F.element_at(F.lit([int(n) for n in parts]), (F.col("list") + 1).cast("int")) if (parts > 1).any() else None
    left = left.withColumn("part", F.lit(0) if split is None else F.pmod(F.xxhash64(F.lit("part"), "id"), split).cast("int"))
    right = right.withColumn("part", F.lit(0) if split is None else F.explode(F.sequence(F.lit(0), split - 1)))
    found = left.unionByName(right).groupBy("list", "piece", "part").applyInArrow(compare, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return materialise(best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank"), "found")


def _first(score: np.ndarray, ids: np.ndarray, fine: np.ndarray, k: int) -> np.ndarray:
    """The k smallest scores, all ties at the last one considered."""
    least = np.partition(score[fine], k - 1)[k - 1]
    near = fine[score[fine] <= least]
    return near[np.lexsort((ids[near], score[near]))[:k]]
