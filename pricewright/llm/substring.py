"""Substring dedup: Rabin-Karp hashes of every window of words, counted in Spark, merged into removal intervals.

Documents are dealt into batches that follow the order of their ids, so "a smaller id" is an earlier batch or an
earlier row of the same one.  A batch sends each distinct window hash once, sorted and written as gaps; the task
that owns a range of hashes answers each later batch with the hashes that an earlier batch has too.  A window that
a third of all documents share is thus one entry per batch.  Texts are shuffled once, for both passes.

Hashes have 64 bits: a window is taken for another with a probability of (number of windows) / 2**64.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.llm.batches import SLICE_BYTES, release, rolling, small_batches, split_words, utf8, window_starts, word_codes

BATCH_BYTES = 4 << 20  # text of a batch on average
RANGE_WINDOWS = 1 << 20  # windows of a range of hashes on average
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def pack(values: np.ndarray) -> bytes:
    """Ascending distinct unsigned 64-bit values as the first one and gaps of as few bytes as the largest needs."""
    gaps = np.diff(values)
    size = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    return bytes([size]) + values[:1].tobytes() + gaps.view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def unpack(data: bytes) -> np.ndarray:
    size = data[0]
    gaps = np.frombuffer(data, np.uint8, offset=9).reshape(-1, size)
    wide = np.zeros((len(gaps) + 1, 8), np.uint8)
    wide[0] = np.frombuffer(data, np.uint8, 8, 1)
    wide[1:, :size] = gaps
    return np.cumsum(wide.view(np.uint64).ravel(), dtype=np.uint64)


def _codes(texts: list[bytes | None], limit: int = SLICE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """``word_codes`` of the texts, of which no more than ``limit`` bytes, but at least one text, are split into words at a time."""
    part = np.cumsum([len(t or b"") for t in texts], dtype=np.int64) // limit
    cuts = [*np.flatnonzero(np.r_[True, part[1:] != part[:-1]]).tolist(), len(texts)] if texts else [0]
    codes, ends = [np.empty(0, np.uint64)], [np.zeros(1, np.int64)]
    for a, b in zip(cuts, cuts[1:]):
        found, upto = word_codes(split_words(texts[a:b]))
        codes.append(found)
        ends.append(ends[-1][-1] + upto[1:])
    return np.concatenate(codes), np.concatenate(ends)


def _windows(texts: list[bytes | None], width: int):
    """Hash of every window, the word at which it starts, and where the texts end among the words."""
    codes, ends = _codes(texts)
    starts = window_starts(ends, width)
    return rolling(codes, width)[starts] if len(starts) else np.empty(0, np.uint64), starts, ends


def in_batches(docs: DataFrame, id_col: str, text_col: str, batch_bytes: int, carry: list[str]) -> tuple[DataFrame, int, int]:
    """batch, id, text, carry (a struct); the number of batches with ids; bytes of text. Rows without an id come in later batches."""
    size, = docs.agg(F.sum(F.octet_length(text_col))).first()
    count = max(1, math.ceil((size or 0) / batch_bytes))
    bounds = docs.select(F.col(id_col).cast("double").alias("x")).approxQuantile("x", [k / count for k in range(1, count)], 0.25 / count) if count > 1 else []
    bounds = sorted({b for b in bounds})
    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"), F.struct(*[F.col(c) for c in carry] or [F.lit(None).cast("int").alias("none")]).alias("carry")).withColumn("x", F.col("id").cast("double"))
    if bounds:
        from pyspark.ml.feature import Bucketizer  # here, so that no worker loads it and pandas with it

        rows = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="x", outputCol="place", handleInvalid="keep").transform(rows)
    else:
        rows = rows.withColumn("place", F.lit(0))
    real = len(bounds) + 1
    batch = F.when(F.col("id").isNull(), real + F.pmod(F.xxhash64("text"), F.lit(real))).otherwise(F.col("place")).cast("int")
    return rows.select(batch.alias("batch"), "id", "text", "carry"), real, size or 0


def removal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50, separator: str | None = None,
            carry: list[str] | None = None, batch_bytes: int = BATCH_BYTES, range_windows: int = RANGE_WINDOWS) -> DataFrame:
    """One row per document: id, n_words, starts, ends (removed words, as intervals of word positions), text (the rest).

    A word goes if a window of ``width`` consecutive words covers it whose words, in that order, also start in a
    document with a smaller id.  Windows are judged on the input.  Without ``separator`` the rest keeps its own white
    space; with it, the kept words are joined by it.  Null, empty and short texts have no window; a null text stays
    null unless joined, then it is empty.  Rows without an id count as later than all others and not as earlier than
    each other; rows of one id do not remove each other's words.  Columns named in ``carry`` come along, others do not.
    """
    small_batches(docs.sparkSession)
    rows, real, size = in_batches(docs, id_col, text_col, batch_bytes, carry or [])
    bits = max(0, math.ceil(math.log2(max(1, size / 6 / range_windows))))

    def _send(group: pa.Table) -> pa.Table:
        found, _, _ = _windows(group.column("text").to_pylist(), width)
        found = np.unique(found)
        where = (found >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(found), np.int64)
        cuts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]]) if len(found) else np.empty(0, np.int64)
        batch = group.column("batch")[0].as_py()
        return pa.table({
            "span": pa.array(where[cuts], pa.int32()), "batch": pa.array([batch] * len(cuts), pa.int32()),
            "hashes": pa.array([pack(found[a:b]) for a, b in zip(cuts, np.r_[cuts[1:], len(found)])], pa.binary())})

    def _answer(group: pa.Table) -> pa.Table:
        group = group.sort_by("batch")
        parts = [unpack(x.as_py()) for x in group.column("hashes")]
        hashes = np.concatenate(parts)
        batch = np.repeat(np.asarray(group.column("batch")), [len(p) for p in parts])
        order = np.argsort(hashes, kind="stable")  # ascending batches within a hash
        hashes, batch = hashes[order], batch[order]
        again = np.r_[False, hashes[1:] == hashes[:-1]]
        first = np.maximum.accumulate(np.where(again, 0, np.arange(len(hashes))))
        again &= batch[first] < real
        hashes, batch = hashes[again], batch[again]
        order = np.argsort(batch, kind="stable")
        hashes, batch = hashes[order], batch[order]
        cuts = np.flatnonzero(np.r_[True, batch[1:] != batch[:-1]]) if len(batch) else np.empty(0, np.int64)
        return pa.table({
            "batch": pa.array(batch[cuts], pa.int32()),
            "hashes": pa.array([pack(hashes[a:b]) for a, b in zip(cuts, np.r_[cuts[1:], len(hashes)])], pa.binary())})

    def _cut(group: pa.Table, answers: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        texts = group.column("text").to_pylist()
        found, starts, ends = _windows(texts, width)
        covered = np.zeros(int(ends[-1]) + 1, np.int32)
        if len(found):
            owner = np.searchsorted(ends, starts, side="right") - 1
            ids = np.asarray(group.column("id").fill_null(0))[owner]  # rows without an id are in batches of their own
            order = np.argsort(found, kind="stable")
            same = np.r_[False, found[order][1:] == found[order][:-1]]
            first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
            gone = np.zeros(len(found), bool)
            gone[order] = ids[order] > ids[order][first]
            if answers.num_rows:
                earlier = np.sort(np.concatenate([unpack(x.as_py()) for x in answers.column("hashes")]))
                at = np.minimum(np.searchsorted(earlier, found), len(earlier) - 1)
                gone |= earlier[at] == found
            np.add.at(covered, starts[gone], 1)
            np.add.at(covered, starts[gone] + width, -1)
        covered = np.cumsum(covered[:-1]) > 0
        begins, stops, rest = [], [], []
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            mask = covered[a:b]
            words = [] if separator is None else (texts[i] or b"").split()
            if not mask.any():
                begins.append([])
                stops.append([])
                rest.append(texts[i] if separator is None else separator.encode().join(words))
                continue
            edge = np.flatnonzero(np.diff(np.r_[False, mask, False]))
            begins.append(edge[::2].tolist())
            stops.append(edge[1::2].tolist())
            if separator is not None:
                rest.append(separator.encode().join([w for w, x in zip(words, mask.tolist()) if not x]))
            else:
                places = [m.span() for m in _WORD.finditer(texts[i])]
                kept, at = [], 0
                for x, y in zip(begins[-1], stops[-1]):
                    kept.append(texts[i][at:places[x][0]])
                    at = places[y][0] if y < len(places) else places[y - 1][1]
                rest.append(b"".join([*kept, texts[i][at:]]))
        return pa.table({
            "id": group.column("id"), "n_words": pa.array(np.diff(ends), pa.int64()),
            "starts": pa.array(begins, pa.list_(pa.int32())), "ends": pa.array(stops, pa.list_(pa.int32())),
            "text": pa.array(rest, pa.binary()).cast(pa.string()), "carry": group.column("carry")})

    # a worker that waits for its next group holds no words of the last one
    def send(group: pa.Table) -> pa.Table:
        try:
            return _send(group)
        finally:
            release()

    def answer(group: pa.Table) -> pa.Table:
        try:
            return _answer(group)
        finally:
            release()

    def cut(group: pa.Table, answers: pa.Table) -> pa.Table:
        try:
            return _cut(group, answers)
        finally:
            release()

    sent = rows.groupBy("batch").applyInArrow(send, "span int, batch int, hashes binary")
    answers = sent.groupBy("span").applyInArrow(answer, "batch int, hashes binary")
    out = rows.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        cut, "id long, n_words long, starts array<int>, ends array<int>, text string, carry " + rows.schema["carry"].dataType.simpleString())
    return out.select(F.col("id").alias(id_col), "n_words", "starts", "ends", F.col("text").alias(text_col),
                      *[F.col("carry").getField(c).alias(c) for c in carry or []])
