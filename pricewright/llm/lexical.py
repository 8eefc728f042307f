"""Ranked lexical search: the best documents of every item, by branch and bound over a tree of document vectors.

A document keeps only terms that some item has, as (term, tf).  Terms are numbered by falling document frequency, so
that documents with the same common terms share the upper part of a path, as in an FP-tree.  Nodes with more than
``BUCKET`` documents are branched; below them documents lie together in buckets.  Every node knows the largest tf of
each term and the smallest m of its documents, which bounds the score of all of them.  An item descends depth first
into the child with the best bound and leaves out what cannot reach its tenth best document so far.

A task builds one tree for each ``SHARD`` postings that it reads and carries every item's best documents from tree to
tree; Spark merges the best of all tasks.  Document frequencies, N and L are those of all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm.batches import slices, utf8
from pricewright.session import materialise

BUCKET = 256  # documents below which a subtree is not branched
SHARD = 1_500_000  # postings of one tree
BLOCK_BYTES = 8 << 20  # item texts that one pass over the documents serves
_PIECE = 4 << 20  # bytes of a text that are split at once
_MERGE = 64  # groups in which the best of all tasks are merged first
_LAST = np.iinfo(np.int64).max  # stands for a null id, which comes after all others

_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """Terms of a text in lists of bounded size: runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased."""
    data, at = (text or b"").translate(_TERM), 0
    while at < len(data):
        end = data.find(b" ", at + _PIECE) if at + _PIECE < len(data) else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def vectors(docs: DataFrame, numbers: dict[bytes, int], key: str, text: str) -> DataFrame:
    """id, n, terms, tfs of every document with a term: all terms counted in n, those of ``numbers`` listed."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)  # terms of one block of items

    def run(batches):
        get = shared.value.get
        for batch in batches:
            for part in slices(batch, "text"):
                total, listed, found = [], [], []
                for value in part.column(1).to_pylist():
                    counts, n = Counter(), 0
                    for words in terms(value):
                        counts.update(map(get, words))
                        n += len(words)
                    counts.pop(None, None)
                    total.append(n)
                    listed.append(len(counts))
                    found.append(counts)
                ends = np.cumsum([0, *listed]).astype(np.int32)
                flat = [np.fromiter((x for c in found for x in part_of(c)), np.int32, ends[-1]) for part_of in (dict.keys, dict.values)]
                lists = [pa.ListArray.from_arrays(ends, values) for values in flat]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), *lists], names=["id", "n", "terms", "tfs"])

    rows = docs.select(F.col(key).cast("long").alias("id"), utf8(text).alias("text"))
    return rows.mapInArrow(run, "id long, n long, terms array<int>, tfs array<int>").where("n > 0")


def saturation(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's share of its weight, in millionths: grows with tf, falls with m."""
    return 1_000_000_000 * tf // np.maximum(1000 * tf + 8 * m, 1)


class DocumentTree:
    """Documents in the order of their paths; buckets of neighbours; branched nodes over runs of buckets."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, lengths: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_terms: int, bucket: int):
        """Terms of each document ascend; ids of null are ``_LAST``."""
        ends = np.r_[0, np.cumsum(lengths)]
        wire = terms.astype(">u4").tobytes()
        paths = [wire[4 * a:4 * b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        order = np.array(sorted(range(len(ids)), key=lambda i: (paths[i], ids[i])), dtype=np.int64)
        self.ids, self.m = ids[order], m[order]
        lengths = lengths[order]
        at = np.repeat(ends[order] - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(int(lengths.sum()))
        flat, tf, doc = terms[at], tfs[at].astype(np.int64), np.repeat(np.arange(len(ids)), lengths)
        starts = np.r_[0, np.cumsum(lengths)]
        nodes, cuts = self._branch(flat, starts, lengths, bucket)
        self.cuts = cuts
        self._postings(flat, tf, doc, n_terms)
        self._bounds(nodes, flat, tf, doc, n_terms)

    @staticmethod
    def _branch(flat, starts, lengths, bucket) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Ranges of documents of the branched nodes, and where buckets begin."""
        nodes, marks, todo = [], [0, len(lengths)], [(0, len(lengths), 0)]
        while todo:
            low, high, depth = todo.pop()
            if high - low <= bucket:
                continue
            ending = lengths[low:high] <= depth
            step = np.where(ending, -1, flat[np.minimum(starts[low:high] + depth, max(len(flat) - 1, 0))])
            edges = low + np.flatnonzero(np.r_[True, step[1:] != step[:-1], True])
            if len(edges) == 2 and not ending[0]:  # one child: the path goes on
                todo.append((low, high, depth + 1))
                continue
            nodes.append((low, high))
            for a, b, value in zip(edges[:-1].tolist(), edges[1:].tolist(), step[edges[:-1] - low].tolist()):
                marks.append(a)
                if value < 0:  # equal paths that end here
                    marks.extend(range(a, b, bucket))
                else:
                    todo.append((a, b, depth + 1))
        marks, kept = sorted(set(marks)), [0]
        for here, after in zip(marks[1:], marks[2:] + [None]):  # small neighbours share a bucket
            if after is None or after - kept[-1] > bucket:
                kept.append(here)
        return nodes, np.array(kept, dtype=np.int64)

    def _postings(self, flat, tf, doc, n_terms) -> None:
        order = np.argsort(flat, kind="stable")
        self.doc, self.share = doc[order], saturation(tf, self.m[doc])[order]
        bucket = np.searchsorted(self.cuts, self.doc, side="right") - 1
        at = flat[order].astype(np.int64) * (len(self.cuts) - 1) + bucket
        # where the postings of a term in a bucket begin
        self.begin = np.searchsorted(at, np.arange(n_terms * (len(self.cuts) - 1) + 1))

    def _bounds(self, nodes, flat, tf, doc, n_terms) -> None:
        """Children of every branched node, and for all buckets and nodes the bound of each term and the smallest id."""
        n = len(self.cuts) - 1
        most = np.zeros((n, n_terms), np.int64)
        np.maximum.at(most.reshape(-1), (np.searchsorted(self.cuts, doc, side="right") - 1) * n_terms + flat, tf)
        least_m, least_id = np.minimum.reduceat(self.m, self.cuts[:-1]), np.minimum.reduceat(self.ids, self.cuts[:-1])
        # a node has the buckets that begin in it; equal runs of buckets are one node
        spans = {tuple(np.searchsorted(self.cuts[:-1], node).tolist()) for node in nodes} | {(0, n)}
        spans = sorted((a, b) for a, b in spans if b - a > 1 or (a, b) == (0, n))
        spans.sort(key=lambda s: (s[0], -s[1]))
        self.children: dict[int, list[int]] = {n + i: [] for i in range(len(spans))}
        open_spans: list[int] = []
        covered = [[] for _ in spans]
        for i, (a, b) in enumerate(spans):
            while open_spans and spans[open_spans[-1]][1] <= a:
                open_spans.pop()
            if open_spans:
                covered[open_spans[-1]].append(i)
            open_spans.append(i)
        for i, (a, b) in enumerate(spans):
            at = a
            for j in [*covered[i], None]:
                stop = b if j is None else spans[j][0]
                self.children[n + i].extend(range(at, stop))
                if j is not None:
                    self.children[n + i].append(n + j)
                    at = spans[j][1]
        self.root = n
        most = np.concatenate([most, *[most[a:b].max(axis=0, keepdims=True) for a, b in spans]])
        least_m = np.r_[least_m, [least_m[a:b].min() for a, b in spans]]
        self.least_id = np.r_[least_id, [least_id[a:b].min() for a, b in spans]]
        self.bound = saturation(most, least_m[:, None]).astype(np.int32)  # below a million each

    def _scores(self, bucket: int, item: np.ndarray, weights: np.ndarray) -> tuple[int, np.ndarray]:
        at = item * (len(self.cuts) - 1) + bucket
        begins = self.begin[at]
        sizes = self.begin[at + 1] - begins
        found = np.repeat(begins - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(int(sizes.sum()))
        low = int(self.cuts[bucket])
        scores = np.zeros(int(self.cuts[bucket + 1]) - low, np.int64)
        np.add.at(scores, self.doc[found] - low, np.repeat(weights, sizes) * self.share[found])
        return low, scores

    def best(self, item: np.ndarray, weights: np.ndarray, k: int, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` best of this tree and of (scores, ids), which are ordered; only scores above 0."""
        bounds = self.bound[:, item].astype(np.int64) @ weights
        stack = [self.root]
        while stack:
            node = stack.pop()
            most = int(bounds[node])
            if most <= 0 or (len(scores) == k and (most < scores[-1] or (most == scores[-1] and self.least_id[node] > ids[-1]))):
                continue
            if node in self.children:
                stack.extend(sorted(self.children[node], key=bounds.__getitem__))  # the best is looked at first
                continue
            low, own = self._scores(node, item, weights)
            keep = np.flatnonzero(own >= max(1, int(scores[-1]) if len(scores) == k else 1))
            if len(keep):
                scores, ids = np.r_[scores, own[keep]], np.r_[ids, self.ids[low + keep]]
                order = np.lexsort((ids, -scores))[:k]
                scores, ids = scores[order], ids[order]
        return scores, ids


def _searcher(shared, k: int, shard: int, bucket: int):
    """A task: trees of its rows, and at its end the best documents of every item."""
    def run(batches):
        order, weights, numbers, items, n_docs, n_all = shared.value
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(items)
        held, size = [], 0

        def search() -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            ids = rows["id"].fill_null(_LAST).to_numpy()
            n = rows["n"].to_numpy()
            wide = 90 * int(n.max()) * n_docs >= 1 << 63
            m = np.array([10 + 90 * int(x) * n_docs // n_all for x in n], np.int64) if wide else 10 + 90 * n * n_docs // n_all
            lists = rows["terms"].combine_chunks()
            lengths = np.diff(lists.offsets.to_numpy())
            places, tfs = order[lists.flatten().to_numpy()], rows["tfs"].combine_chunks().flatten().to_numpy()
            rising = np.lexsort((places, np.repeat(np.arange(len(ids)), lengths)))
            tree = DocumentTree(ids, m, lengths, places[rising], tfs[rising], len(weights), bucket)
            for i, item in enumerate(items):
                best[i] = tree.best(item, weights[item], k, *best[i])

        for batch in batches:
            at = 0
            while at < batch.num_rows:  # cut by postings
                sizes = np.cumsum(np.diff(batch.column(2).slice(at).offsets.to_numpy()))
                rows = max(1, int(np.searchsorted(sizes, shard - size, side="right")))
                held.append(batch.slice(at, rows))
                size += int(sizes[min(rows, len(sizes)) - 1])
                at += rows
                if size >= shard or at < batch.num_rows:
                    search()
                    held, size = [], 0
        if held:
            search()
        sizes = [len(s) for s, _ in best]
        scores, ids = (np.concatenate([b[j] for b in best]) if best else np.empty(0, np.int64) for j in (0, 1))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(numbers, sizes), pa.int64()), pa.array(np.full(len(ids), TaskContext.get().partitionId()), pa.int32()),
            pa.array(ids, pa.int64(), mask=ids == _LAST), pa.array(scores, pa.int64())], names=["item", "part", "id", "score"])

    return run


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(docs: DataFrame, items: list, k: int, key: str, text: str, shard: int, bucket: int) -> DataFrame:
    """item, rank, id, score for items (number, text) of bounded size."""
    spark = docs.sparkSession
    own = [sorted({w for part in terms(value) for w in part}) for _, value in items]
    numbers = {w: i for i, w in enumerate(sorted({w for words in own for w in words}))}
    rows = materialise(vectors(docs, numbers, key, text), "vectors")
    n_docs, n_all = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()  # one short row a term of the block
    df = np.zeros(len(numbers), np.int64)
    for term, n in counted:
        df[term] = n
    by_frequency = np.argsort(-df, kind="stable")
    order = np.empty(len(df), np.int32)
    order[by_frequency] = np.arange(len(df), dtype=np.int32)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(n) + 1))) for n in df[by_frequency]], np.int64)
    shared = spark.sparkContext.broadcast((order, weights, np.array([i for i, _ in items], np.int64), [np.sort(order[[numbers[w] for w in words]]).astype(np.int64) for words in own], n_docs, n_all))
    found = rows.where(F.size("terms") > 0).mapInArrow(_searcher(shared, k, shard, bucket), "item long, part int, id long, score long")
    merged = _ranked(found.withColumn("part", F.pmod("part", F.lit(_MERGE))), ["item", "part"], k).drop("rank")
    return _ranked(merged, ["item"], k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", item_key: str = "item_id", text: str = "text",
           shard: int = SHARD, bucket: int = BUCKET) -> DataFrame:
    """item_key, rank, key, score: the ``k`` best documents of every row of ``items``, all documents being candidates.

    Only scores above 0 are answers, so an item without a term that some document has gives no row; nor do null or
    empty texts of either side.  Equal scores are ranked by id, null ids last.  Every row is a document or an item of its
    own, also with a repeated or null id.  Texts of any length are read whole, in pieces.  Empty tables give
    no rows; other columns are ignored, whatever their names.

    Items are served in blocks of some ``BLOCK_BYTES`` of text, with one pass over the documents for each.
    """
    spark = docs.sparkSession
    numbered = materialise(items.select(F.monotonically_increasing_id().alias("item"), F.col(item_key).alias("item_key"), F.col(text).cast("binary").alias("text")), "items")
    size = numbered.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    parts = []
    for block in range(blocks):
        chosen = numbered.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).where("text IS NOT NULL")
        rows = [(r["item"], bytes(r["text"])) for r in chosen.select("item", "text").collect()]  # some BLOCK_BYTES
        if rows:
            parts.append(_block(docs, rows, k, key, text, shard, bucket))
    kind = docs.schema[key].dataType
    if not parts:
        parts = [spark.createDataFrame([], "item long, part int, id long, score long, rank int")]
    found = reduce(DataFrame.unionByName, parts)
    return found.join(numbered.select("item", "item_key"), "item").select(F.col("item_key").alias(item_key), "rank", F.col("id").cast(kind).alias(key), "score")
