"""Retrieval packing: windows of tokens filled with lexically near documents.

Documents are tokenised once into a table and dealt into shards by content: two weighted min-hashes over the tokens that
documents share, rare ones first, order all documents, and the order is cut into shards of like size, through a group of
like documents where it is large.  Each shard holds an inverted index with BM25 weights over token ids, which a seed
asks with all its tokens; document frequencies and the mean length are those of the whole corpus.  A window starts
with what is left of a seed document; the unused documents nearest to the seed follow until one of them is cut by the
window's end, and that one seeds the next window.  The last tokens of a shard go to sequences of powers of two, so
nothing is padded.
"""

from __future__ import annotations

import json
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.llm.batches import map_slices, release, small_batches, utf8
from pricewright.session import materialise

SHARD_TOKENS = 1 << 20  # tokens of a shard on average
SHARD_SAMPLE = 32  # sampled documents a shard, by which the order is cut
RARITY = 4  # power of the idf by which tokens come early in the orders
COMMON = 0.2  # share of a shard's documents from which a token has a row of weights
KEEP = 0.85  # share of free documents at which a shard drops the weights of those that are taken
NEVER = "<|never|>"  # a special token that is not allowed in any text: without one, the encoder looks for it at every byte
FASTER = {  # the same splits with less backtracking, as tiktoken writes this pattern
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+":
    r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"}
K1, B = 1.2, 0.75


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


def byte_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """The vocabulary with bytes for the characters that stand for them; words of other characters are left out."""
    symbols = byte_symbols()
    return {bytes(symbols[c] for c in word): i for word, i in vocabulary.items() if all(c in symbols for c in word)}


class Tokens:
    """Token ids of texts as bytes of unsigned 16-bit numbers, for a byte-level vocabulary in a tokenizer file.

    Ids are ranks of merges, so the merges need no list of their own.  ``ranks``: ``byte_ranks``, where they are known.
    """

    def __init__(self, vocabulary: dict[str, int], pattern: str, ranks: dict[bytes, int] | None = None):
        import tiktoken

        ranks = byte_ranks(vocabulary) if ranks is None else ranks
        self.encoder = tiktoken.Encoding(
            "corpus", pat_str=FASTER.get(pattern, pattern), mergeable_ranks=ranks, special_tokens={NEVER: max(ranks.values()) + 1})

    def __call__(self, text: str) -> bytes:
        return self.encoder.encode_to_numpy(text, disallowed_special=()).astype(np.uint16).tobytes()


def read_vocabulary(path: str) -> dict[str, int]:
    with open(path, encoding="utf-8") as file:
        return json.load(file)["model"]["vocab"]


def tokenise(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[str, int], pattern: str, end: int = 0) -> DataFrame:
    """id, ids (unsigned 16-bit), place (a hash of id and ids): each text's tokens, then ``end``; a null text is empty."""
    if max(vocabulary.values()) > 0xFFFF:
        raise ValueError("token ids above 65,535 do not fit")
    shared = docs.sparkSession.sparkContext.broadcast((byte_ranks(vocabulary), pattern))  # a vocabulary file
    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col))
    encoder: list[Tokens] = []
    stop = np.array([end], np.uint16).tobytes()

    def run(part: pa.RecordBatch) -> dict:
        if not encoder:
            ranks, split = shared.value
            encoder.append(Tokens({}, split, ranks))
        ids = [encoder[0]((t or b"").decode("utf-8", "replace")) + stop for t in part.column(1).to_pylist()]
        return {"id": part.column(0), "ids": pa.array(ids, pa.binary()), "n_tokens": np.array([len(x) // 2 for x in ids], np.int64)}

    found = map_slices(rows, text_col, "id long, ids binary, n_tokens long", run)
    return found.withColumn("place", F.when(F.col("id").isNull(), F.xxhash64("ids")).otherwise(F.xxhash64("id")))


def _terms(ids: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, token) of a list of tokens, in order, and how often each comes."""
    key = np.sort((doc.astype(np.uint64) << np.uint64(16)) | ids)
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return (key[first] >> np.uint64(16)).astype(np.int64), (key[first] & np.uint64(0xFFFF)).astype(np.int64), np.diff(np.r_[first, len(key)])


def document_frequencies(tokens: DataFrame, size: int) -> np.ndarray:
    """In how many documents each token id comes, over all of them; at most 65,536 numbers."""

    def task(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                parts = [np.frombuffer(x, np.uint16) for x in batch.column(0).slice(a, 512).to_pylist()]
                doc = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                total += np.bincount(_terms(np.concatenate(parts), doc)[1], minlength=size)
        release()
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["term", "n"])

    out = np.zeros(size, np.int64)
    for r in tokens.select("ids").mapInArrow(task, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r[0]] = r[1]
    return out


def sketches(count: np.ndarray, idf: np.ndarray, seed: int = 7) -> np.ndarray:
    """Two random orders of the token ids: a token comes the earlier, the rarer it is; those of fewer than two documents last.

    Documents have the same first token in an order about as often as their sets agree, each token weighted by that power of its idf.
    """
    rng = np.random.default_rng(seed)
    late = rng.exponential(size=(2, len(idf))) / np.maximum(idf, 1e-9) ** RARITY
    return np.argsort(np.argsort(np.where(count < 2, np.inf, late), axis=1, kind="stable"), axis=1, kind="stable")


def route(ids: list[bytes], place: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """The number by which documents are ordered: 16 bits of each first token, then 31 bits of ``place``."""
    lengths = np.array([len(x) // 2 for x in ids], np.int64)
    tokens = np.frombuffer(b"".join(ids), np.uint16)
    begins = np.cumsum(np.r_[0, lengths[:-1]])  # every document has its end token
    first, second = (np.minimum.reduceat(order[tokens], begins).astype(np.int64) for order in orders)
    return (first << 47) | (second << 31) | ((place >> 33) & 0x7FFFFFFF)


def routes(tokens: DataFrame, shared) -> DataFrame:
    """n_tokens and ``route`` of each of ``tokens``."""

    def task(batches):
        for n_tokens, found in _routed(batches, shared, "n_tokens"):
            yield pa.RecordBatch.from_arrays([n_tokens, pa.array(found)], names=["n_tokens", "route"])

    return tokens.select("ids", "place", "n_tokens").mapInArrow(task, "n_tokens long, route long")


def _routed(batches, shared, *names: str):
    """Columns of some rows at a time, and their routes; memory is given back at the end of the task."""
    for batch in batches:
        for a in range(0, batch.num_rows, 512):
            part = batch.slice(a, 512)
            found = route(part.column("ids").to_pylist(), np.asarray(part.column("place")), shared.value)
            yield *(part.column(n) for n in names), found
    release()


def shard_cuts(tokens: DataFrame, shared, total: int, shards: int) -> list[int]:
    """Routes at which shards begin, after the first: some ``SHARD_SAMPLE`` sampled documents a shard, longer ones likelier."""
    rate = SHARD_SAMPLE * shards / total
    drawn = F.pmod(F.xxhash64(F.lit("shard"), "place"), F.lit(1 << 31)) / F.lit(float(1 << 31))
    some = routes(tokens.where(drawn < rate * F.col("n_tokens")), shared).select("route", "n_tokens").orderBy("route").toPandas()
    upto = np.cumsum(np.maximum(some["n_tokens"].to_numpy(), 1 / rate))
    if not len(upto):
        return []
    at = np.searchsorted(upto, upto[-1] * np.arange(1, shards) / shards)
    return np.unique(some["route"].to_numpy()[at]).tolist()


class Shard:
    """BM25 over the documents of one shard: rows of weights for tokens of many documents, lists for the others."""

    def __init__(self, parts: list[np.ndarray], idf: np.ndarray, mean: float):
        lengths = np.array([len(p) for p in parts], np.int64)
        doc, term, n = _terms(np.concatenate(parts), np.repeat(np.arange(len(parts)), lengths))
        norm = K1 * (1 - B + B * lengths / mean)
        weight = idf[term] * n * (K1 + 1) / (n + norm[doc])
        self.by_doc = np.searchsorted(doc, np.arange(len(parts) + 1))
        self.term = term
        common = np.bincount(term, minlength=len(idf)) >= COMMON * len(parts)
        self.row = np.where(common, np.cumsum(common) - 1, -1)
        self.column = np.arange(len(parts))  # the documents of the rows' columns
        row = self.row[term]
        many = row >= 0
        self.rows = np.zeros((int(common.sum()), len(parts)))  # at most 1 / COMMON numbers a posting
        self.rows[row[many], doc[many]] = weight[many]
        doc, term, weight = doc[~many], term[~many], weight[~many]
        order = np.argsort(term, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.by_term = np.searchsorted(term[order], np.arange(len(idf) + 1))

    def keep(self, free: np.ndarray) -> None:
        """Drops the weights of documents that are not ``free``: they score 0 from now on, the others as before."""
        kept = free[self.doc]
        self.by_term = np.r_[0, np.cumsum(kept)][self.by_term]
        self.doc, self.weight = self.doc[kept], self.weight[kept]
        kept = free[self.column]
        self.rows, self.column = self.rows[:, kept], self.column[kept]

    def scores(self, seed: int) -> np.ndarray:
        terms = self.term[self.by_doc[seed]:self.by_doc[seed + 1]]
        row = self.row[terms]
        found = np.zeros(len(self.by_doc) - 1)
        found[self.column] = self.rows[row[row >= 0]].sum(axis=0)
        terms = terms[row < 0]
        begin = self.by_term[terms]
        n = self.by_term[terms + 1] - begin
        upto = np.cumsum(n)
        at = np.repeat(begin - (upto - n), n)
        at += np.arange(len(at))  # the lists of the terms, one after the other
        return found + np.bincount(self.doc[at], self.weight[at], len(found))


def _ranked(score: np.ndarray):
    """Documents of positive score, best first; all of them, but few are sorted before they are wanted."""
    near = np.flatnonzero(score > 0)
    if len(near) > 64:
        part = np.argpartition(-score[near], 64)
        best, near = near[part[:64]], near[part[64:]]
        yield from best[np.lexsort((best, -score[best]))].tolist()
    yield from near[np.lexsort((near, -score[near]))].tolist()


def fill(parts: list[np.ndarray], idf: np.ndarray, mean: float, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; sequences are whole windows, then powers of two."""
    shard = Shard(parts, idf, mean)
    lengths = [len(p) for p in parts]
    free, cursor = np.ones(len(parts), bool), 0
    left = held = len(parts)  # documents that are free, and that were when the shard last dropped the others
    pieces, sequence, offset = [], 0, 0
    waiting = iter(())  # neighbours of the window's seed, nearest first
    while True:
        doc = next((w for w in waiting if free[w]), None) if offset else None
        if doc is None:  # a new window, or no neighbour is left
            while cursor < len(parts) and not free[cursor]:
                cursor += 1
            if cursor == len(parts):
                break
            doc = cursor
        free[doc] = False
        left -= 1
        start, crossed = 0, offset == 0
        while start < lengths[doc]:
            length = min(lengths[doc] - start, window - offset)
            pieces.append((doc, start, length, sequence, offset))
            start, offset = start + length, offset + length
            if offset == window:
                sequence, offset, crossed = sequence + 1, 0, True
        if offset and crossed:  # what is left of this document starts a window: it is the seed
            if left < KEEP * held:
                held = left
                shard.keep(free)
            waiting = _ranked(np.where(free, shard.scores(doc), 0))
    return _tail(pieces, window)


def _tail(pieces: list[tuple[int, int, int, int, int]], window: int) -> list[tuple[int, int, int, int, int]]:
    """Cuts an unfinished last sequence into sequences of powers of two, largest first."""
    if not pieces:
        return pieces
    last = pieces[-1][3]
    rest = [p for p in pieces if p[3] == last]
    total = sum(p[2] for p in rest)
    if total == window:
        return pieces
    out = [p for p in pieces if p[3] != last]
    sequence, offset, size = last, 0, 1 << (total.bit_length() - 1)
    for doc, start, length, _, _ in rest:
        while length:
            if offset == size:
                total -= size
                sequence, offset, size = sequence + 1, 0, 1 << (total.bit_length() - 1)
            take = min(length, size - offset)
            out.append((doc, start, take, sequence, offset))
            start, length, offset = start + take, length - take, offset + take
    return out


def pack(docs: DataFrame, vocabulary: dict[str, int], pattern: str, id_col: str = "doc_id", text_col: str = "text", window: int = 1024,
         end: int = 0, shard_tokens: int = SHARD_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids if asked for.

    Every token of every document, with ``end`` after it, is in exactly one piece; a sequence has ``window`` tokens or a
    power of two, so it needs no padding.  Null and empty texts are the end token alone.  Rows are packed one by one, so
    repeated rows and repeated or null ids give pieces of their own.  Other columns are ignored.  ``start`` counts in
    the row's own tokens.  Sequence ids are unique but not consecutive.
    """
    spark = docs.sparkSession
    small_batches(spark)
    tokens = materialise(tokenise(docs, id_col, text_col, vocabulary, pattern, end), "tokens")
    rows, total = tokens.agg(F.count("*"), F.sum("n_tokens")).first()
    count = document_frequencies(tokens, max(vocabulary.values()) + 1)
    idf = np.log1p((rows - count + 0.5) / (count + 0.5))
    shared = spark.sparkContext.broadcast((idf, (total or 1) / max(1, rows)))
    shards = max(1, math.ceil((total or 0) / shard_tokens))
    orders = spark.sparkContext.broadcast(sketches(count, idf))
    cuts = spark.sparkContext.broadcast(np.array(shard_cuts(tokens, orders, total, shards) if shards > 1 else [], np.int64))

    def _run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("place", "ascending"), ("id", "ascending"), ("ids", "ascending")])
        parts = [np.frombuffer(x, np.uint16) for x in group.column("ids").to_pylist()]
        base = group.column("shard")[0].as_py() << 32
        pieces = fill(parts, *shared.value, window)
        doc, start, length, sequence, offset = (np.array(x, np.int64) for x in zip(*pieces))
        wide = [parts[d][a:a + n].astype("<u4").tobytes() for d, a, n, _, _ in pieces]
        out = {
            id_col: group.column("id").take(pa.array(doc)), "start": start, "length": length,
            "ids_crc32": np.array([zlib.crc32(w) for w in wide], np.int64),
            "doc_tokens": np.array([len(p) for p in parts], np.int64)[doc], "sequence_id": base + sequence, "offset": offset}
        if with_ids:
            out["ids"] = pa.array([np.frombuffer(w, "<u4").astype(np.int32) for w in wide], pa.list_(pa.int32()))
        return pa.table(out)

    def run(group: pa.Table) -> pa.Table:
        try:
            return _run(group)
        finally:
            release()

    def deal(batches):  # in one step with the routes: a second one would need a second worker a core
        for *columns, found in _routed(batches, orders, "place", "id", "ids"):
            shard = np.searchsorted(cuts.value, found, side="right").astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard), *columns], names=["shard", "place", "id", "ids"])

    dealt = tokens.select("place", "id", "ids").mapInArrow(deal, "shard long, place long, id long, ids binary")
    schema = f"`{id_col}` long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return dealt.groupBy("shard").applyInArrow(
        run, schema + (", ids array<int>" if with_ids else ""))
