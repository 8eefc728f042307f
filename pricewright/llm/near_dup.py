"""MinHash near-duplicates: SuperMinHash signatures, banding, verification on full shingle sets, grouping.

Texts with equal shingle sets are one class from the start, so copies never meet in a band.  Per band value
only links to the smallest class are tried first, which joins most of a large group with few comparisons.
Where members of a band value are still in different components, every pair of them whose signatures agree
often enough is compared, in blocks; no partner is skipped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.llm.batches import mix, map_slices, release, shingle_sets, small_batches, split_words, utf8
from pricewright.llm.components import components
from pricewright.session import materialise

SLOTS, ROWS = 128, 4  # 32 bands of 4 slots: a pair of similarity 0.8 shares none with probability 5e-8
BLOCK = 512
AT_ONCE = 64  # texts of a block that are words at once
SLICE = 1 << 20  # text whose signatures are made at once: 128 bytes a word besides
FILE_ROWS, FILE_WIDE = 100_000, 5_000  # rows of a file on average, of a few numbers each or with signatures
_R_BITS = 25
_EMPTY = np.uint32(0xFFFFFFFF)


def superminhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` unsigned values per set; slots agree with the sets' Jaccard similarity.

    Each element visits the slots in its own pseudo-random order (a Fisher-Yates shuffle) and offers its
    j-th slot the value j + r.  All elements of all sets move from rank to rank together; a set is done as
    soon as every slot has a value, since later ranks only offer larger ones.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    out = np.full(len(sets) * slots, _EMPTY, np.uint32)
    if sizes.sum() == 0:
        return out.reshape(len(sets), slots)
    elements = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = None
    for rank in range(slots):
        x = mix(elements + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        value = np.uint32(rank << _R_BITS) | (x & np.uint64((1 << _R_BITS) - 1)).astype(np.uint32)
        place = rank + (((x >> np.uint64(32)) * np.uint64(slots - rank)) >> np.uint64(32)).astype(np.int64)
        if order is None:
            slot = place
        else:
            rows = np.arange(len(elements))
            slot = order[rows, place].astype(np.int64)
            order[rows, place] = order[:, rank]
        np.minimum.at(out, owner * slots + slot, value)
        open_sets = (out.reshape(-1, slots) == _EMPTY).any(axis=1)
        active = open_sets[owner]
        if not active.any():
            break
        if order is None:
            elements, owner, place = elements[active], owner[active], place[active]
            order = np.broadcast_to(np.arange(slots, dtype=np.uint8), (len(elements), slots)).copy()
            order[np.arange(len(elements)), place] = 0
        elif active.mean() < 0.8:
            elements, owner, order = elements[active], owner[active], order[active]
    return out.reshape(len(sets), slots)


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    n, slots = signatures.shape
    parts = signatures.reshape(n, slots // rows, rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(slots // rows, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return key.view(np.int64)


def features(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """Per document: set size, a 128-bit key of the set, its band keys and its signature (16 bits a slot)."""

    def run(part: pa.RecordBatch) -> dict:
        sets = shingle_sets(split_words(part.column(1).to_pylist(), lower=True), width)
        signatures = superminhash(sets)
        bands = band_keys(signatures)
        again = [mix(s + np.uint64(0x632BE59BD9B4E019)) for s in sets]
        short = (signatures & np.uint32(0xFFFF)).astype(np.uint16)
        return {
            "id": part.column(0),
            "n_shingles": np.array([len(s) for s in sets], dtype=np.int64),
            "set_a": np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64),
            "set_b": np.array([s.sum(dtype=np.uint64) for s in again], np.uint64).view(np.int64),
            "bands": pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * bands.shape[1], pa.int32()), pa.array(bands.ravel())),
            "signature": pa.array([x.tobytes() for x in short], pa.binary()),
        }

    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col))
    return map_slices(rows, text_col, "id long, n_shingles long, set_a long, set_b long, bands array<long>, signature binary", run, SLICE)


def verify(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union, on the full sets of both texts."""
    right = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    both = right.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    last: dict = {}

    def run(part: pa.RecordBatch) -> dict:
        a = part.column(0).to_pylist()
        right_sets = shingle_sets(split_words(part.column(3).to_pylist(), lower=True), width)
        left, keep = part.column(2), []
        for i, (one, other) in enumerate(zip(a, right_sets)):
            if one not in last:
                last.clear()  # pairs of one a arrive together
                last[one] = shingle_sets(split_words([left[i].as_py()], lower=True), width)[0]
            keep.append(_similar(last[one], other, percent))
        kept = pa.array(keep, pa.bool_())
        return {"a": part.column(0).filter(kept), "b": part.column(1).filter(kept)}

    return map_slices(both.select("a", "b", "text_a", "text_b"), "text_b", "a long, b long", run)


def blocks(mixed: DataFrame) -> DataFrame:
    """Deals the members of each mixed band value into blocks: odd members (side 0) against all members (side 1).

    ``mixed``: key, band, id, component, signature, bands, and ``odd`` for members outside the largest component of
    their band value.  A block has some 512 members a side at most, however many share the value.
    """
    sizes = mixed.groupBy("key").agg(
        F.ceil(F.count("*") / BLOCK).cast("int").alias("n_all"), F.ceil(F.sum(F.col("odd").cast("int")) / BLOCK).cast("int").alias("n_odd"))
    rows = mixed.join(sizes, "key").withColumn("place", F.xxhash64("id"))
    lists = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    left = rows.where("odd").withColumns({"side": F.lit(0), "i": F.pmod("place", "n_odd").cast("int"), "j": F.explode(lists("n_all"))})
    right = rows.withColumns({"side": F.lit(1), "j": F.pmod("place", "n_all").cast("int"), "i": F.explode(lists("n_odd"))})
    columns = ["key", "i", "j", "side", "band", "id", "component", "signature", "bands"]
    return left.select(columns).unionByName(right.select(columns))


def _near(group: pa.Table, percent: int, best: int | None):
    """For each odd member of a block: (its row, rows of its partners); the two sides of the block; their ids.

    Partners are in another component, agree in as many slots as the similarity makes likely, less six standard
    deviations, and share no earlier band, as the pair then belongs to that band's value.
    """
    share = percent / 100
    least = math.floor(SLOTS * share - 6 * math.sqrt(SLOTS * share * (1 - share)))
    side = np.asarray(group.column("side"))
    sides = [group.filter(pa.array(side == k)) for k in (0, 1)]
    if not all(t.num_rows for t in sides):
        return [], sides, [[], []]
    band = group.column("band")[0].as_py()
    ids = [np.asarray(t.column("id")) for t in sides]
    parts = [np.asarray(t.column("component")) for t in sides]
    signs = [np.frombuffer(b"".join(t.column("signature").to_pylist()), np.uint16).reshape(-1, SLOTS) for t in sides]
    keys = [np.asarray(t.column("bands").combine_chunks().flatten()).reshape(t.num_rows, -1) for t in sides]
    found = []
    for x in range(len(ids[0])):
        agree = np.where(parts[1] != parts[0][x], (signs[1] == signs[0][x]).sum(axis=1), 0)
        near = np.flatnonzero(agree >= least)
        near = near[(keys[1][near, :band] != keys[0][x, :band]).all(axis=1)]
        if best is not None and len(near) > best:
            near = near[np.argsort(-agree[near], kind="stable")[:best]]
        if len(near):
            found.append((x, near))
    return found, sides, ids


def likely_pairs(dealt: DataFrame, percent: int, best: int) -> DataFrame:
    """Up to ``best`` partners of each odd member and block, those whose signatures agree most: a round that leaves little."""

    def block(group: pa.Table) -> pa.Table:
        found, _, ids = _near(group, percent, best)
        a = np.concatenate([np.full(len(near), ids[0][x]) for x, near in found]) if found else np.empty(0, np.int64)
        b = np.concatenate([ids[1][near] for _, near in found]) if found else np.empty(0, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return dealt.groupBy("key", "i", "j").applyInArrow(block, "a long, b long").distinct()


def residual_links(dealt: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links of all remaining pairs.  Texts go to the blocks that need them, and only links come out, not pairs."""
    kind = "key long, i int, j int, side int, band int, id long, component long, signature binary, bands array<long>"

    def needed(group: pa.Table) -> pa.Table:
        found, sides, _ = _near(group, percent, None)
        rows = [np.array([x for x, _ in found], np.int64), np.unique(np.concatenate([near for _, near in found])) if found else np.empty(0, np.int64)]
        return pa.concat_tables([t.take(pa.array(r)) for t, r in zip(sides, rows)])

    def check(group: pa.Table) -> pa.Table:
        found, sides, ids = _near(group, percent, None)
        sets = [_sets(t.column("text"), width) for t in sides]
        links = [(int(ids[0][x]), int(ids[1][y])) for x, near in found for y in near.tolist() if _similar(sets[0][x], sets[1][y], percent)]
        del sets
        if group.nbytes >= SLICE:  # a worker that waits holds nothing of a large block
            release()
        return pa.table({"a": pa.array([min(p) for p in links], pa.int64()), "b": pa.array([max(p) for p in links], pa.int64())})

    rows = materialise(dealt.groupBy("key", "i", "j").applyInArrow(needed, kind), "near-needed")
    return rows.join(texts, "id").groupBy("key", "i", "j").applyInArrow(check, "a long, b long").distinct()


def _sets(texts: pa.ChunkedArray, width: int) -> list[np.ndarray]:
    return [s for a in range(0, len(texts), AT_ONCE) for s in shingle_sets(split_words(texts.slice(a, AT_ONCE).to_pylist(), lower=True), width)]


def _similar(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted sets."""
    small, large = (one, other) if len(one) <= len(other) else (other, one)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * common >= percent * (len(one) + len(other) - common)


def _files(rows: int, each: int) -> int:
    """Files for so many rows: a file a shuffle partition, with a few rows each, costs more than its rows."""
    return max(1, math.ceil(rows / each))


def _most_pairs(mixed: DataFrame, best: int | None) -> int:
    """No fewer pairs than the blocks of ``mixed`` give: of each odd member with all others, or ``best`` in each block."""
    n = F.count("*")
    each = n if best is None else best * F.ceil(n / BLOCK)
    return mixed.groupBy("key").agg((F.sum(F.col("odd").cast("long")) * each).alias("n")).agg(F.sum("n")).first()[0] or 0


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable over links), kept, class_id.

    Words are lower-cased in A-Z only.  A set holds the distinct ``width``-word shingles of the whole text; a text
    with fewer words is one shingle.  Documents are linked when 100 * intersection >= ``percent`` * union.  Null or
    blank texts have an empty set, link with nothing and stay.  Rows with one id are one document, with the greatest of
    their texts; rows without an id are left out, as nothing can point at them.  Other columns are ignored.  An empty
    table gives an empty result.
    """
    small_batches(docs.sparkSession)
    clean = docs.where(F.col(id_col).isNotNull()).select(id_col, text_col)
    if clean.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        clean = materialise(clean.groupBy(id_col).agg(F.max(text_col).alias(text_col)), "near-documents")
    table = materialise(features(clean, id_col, text_col, width), "near-features")
    classes = materialise(
        table.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles")
        .agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("signature").alias("signature")), "near-classes",
        files=_files(table.count(), FILE_WIDE))
    rows = classes.select("id", F.posexplode("bands").alias("band", "key"))
    shared = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("hub")).where("n > 1")
    members = materialise(rows.join(shared.select("key", "hub"), "key"), "near-members", files=_files(classes.count() * (SLOTS // ROWS), FILE_ROWS))
    n_members = members.count()
    wanted = members.select("id").distinct()
    texts = clean.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text"))
    sized = texts.join(wanted, "id", "left_semi")

    star = members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    links = materialise(verify(star, sized, width, percent).distinct(), "near-links", files=_files(n_members, FILE_ROWS))
    for best in (4, None):
        label = components(links)
        placed = members.join(label, "id", "left").select("key", "band", "id", F.coalesce("component", "id").alias("component"))
        parts = placed.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(
            F.count("*").alias("parts"), F.max_by("component", F.struct("n", "component")).alias("main")).where("parts > 1")
        mixed = placed.join(parts.select("key", "main"), "key").join(classes.select("id", "signature", "bands"), "id").withColumn(
            "odd", F.col("component") != F.col("main")).drop("main")
        mixed = materialise(mixed, "near-mixed", files=_files(n_members, FILE_WIDE))
        most = links.count() + _most_pairs(mixed, best)
        dealt = blocks(mixed)
        found = residual_links(dealt, sized, width, percent) if best is None else verify(likely_pairs(dealt, percent, best), sized, width, percent)
        links = materialise(links.unionByName(found).distinct(), "near-links", files=_files(most, FILE_ROWS))
    label = components(links).withColumnRenamed("id", "class_id")
    names = classes.select("set_a", "set_b", "n_shingles", F.col("id").alias("class_id")).join(label, "class_id", "left")
    return table.select("id", "n_shingles", "set_a", "set_b").join(names, ["set_a", "set_b", "n_shingles"], "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.coalesce("component", "class_id", "id").alias("component_id"),
        (F.col("id") == F.coalesce("component", "class_id", "id")).alias("kept"),
        F.coalesce("class_id", "id").alias("class_id"))
