"""Near-duplicates and substring dedup against brute force, and their edge cases."""

import hashlib
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.llm.batches import rolling, small_batches, split_words, word_codes
from pricewright.llm.components import components
from pricewright.llm.near_dup import BLOCK, SLOTS, _most_pairs, near_duplicates, superminhash
from pricewright.llm.substring import _codes, pack, removal, unpack
from pricewright.session import shared_folder

DOCS = "doc_id long, text string, id long, a string, b string, key int, component long, batch int, carry int"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 0, None, "x", 1, None, 2, 3) for i, t in rows], DOCS)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def brute_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = words(lower(t or ""))
        sets[i] = {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed, n=60):
    """Copies, near copies of near copies, short and blank texts."""
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["The", "the", "É", "é", "x y"]
    texts = []
    for _ in range(n):
        pick = rnd.random()
        if texts and pick < 0.25:
            texts.append(rnd.choice(texts))
        elif texts and pick < 0.7:
            w = rnd.choice(texts).split(" ")
            for _ in range(rnd.randint(1, 3)):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            texts.append(" ".join(w))
        else:
            texts.append(" ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 8, 40, 90]))))
    texts += [None, "", " \n\t", "w1", "W1", "w1 w2 w3", "W1  w2\nw3", "É é"]
    return list(zip(rnd.sample(range(-5, 400), len(texts)), texts))


@pytest.mark.parametrize("seed, width", [(1, 4), (2, 5), (3, 4)])
def test_near_duplicates_match_brute_force(spark, seed, width):
    rows = corpus(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(frame(spark, rows), width=width).collect()}
    assert got == brute_components(rows, width, 80)


def test_a_large_group_of_near_copies(spark):
    """Each copy changes other words, so many pairs are below the threshold, yet all hang together or are found apart."""
    rnd = random.Random(4)
    base = [f"b{k}" for k in range(60)]
    rows = [(k, " ".join(w if rnd.random() > 0.02 else f"n{rnd.randrange(10 ** 6)}" for w in base)) for k in range(250)]
    rows += [(1000 + k, " ".join(base)) for k in range(200)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(frame(spark, rows), width=4).collect()}
    assert got == brute_components(rows, 4, 80)


def test_near_duplicates_edges(spark):
    assert near_duplicates(frame(spark, [])).collect() == []
    long = " ".join(f"w{k % 977}" for k in range(30_000))
    got = {r["doc_id"]: r for r in near_duplicates(frame(spark, [(7, long), (3, long), (None, long), (5, None), (9, "a b"), (9, "a c")])).collect()}
    assert sorted(got) == [3, 5, 7, 9]
    assert got[7]["component_id"] == 3 and not got[7]["kept"] and got[3]["kept"]
    assert got[5]["n_shingles"] == 0 and got[5]["kept"] and got[9]["n_shingles"] == 1


def test_signatures_agree_as_often_as_sets_do():
    rng = np.random.default_rng(0)
    for share in (0.2, 0.5, 0.8):
        hits = []
        for _ in range(60):
            x = rng.integers(0, 2 ** 63, 300).astype(np.uint64)
            common = round(300 * share)
            one = superminhash([x[:150 + common // 2], x[150 - common // 2:]])
            j = common / 300
            hits.append((one[0] == one[1]).mean() - j)
        assert abs(np.mean(hits)) < 0.02
    assert (superminhash([np.empty(0, np.uint64)]) == 0xFFFFFFFF).all() and superminhash([x[:1]]).shape == (1, SLOTS)


def test_components(spark):
    rnd = random.Random(3)
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(rnd.randrange(2000, 2400), rnd.randrange(2000, 2400)) for _ in range(200)]
    label = {}

    def find(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    links = spark.createDataFrame([e for e in edges if e[0] != e[1]], "a long, b long").repartition(7)
    got = {r["id"]: r["component"] for r in components(links).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}
    assert components(links.limit(0)).collect() == []


def brute_removal(rows, width):
    first = {}
    tokens = [(i, words(t)) for i, t in rows]
    for i, w in tokens:
        for k in range(len(w) - width + 1):
            if i is not None:
                x = tuple(w[k:k + width])
                first[x] = min(first.get(x, i), i)
    out = []
    for i, w in tokens:
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            least = first.get(tuple(w[k:k + width]))
            if least is not None and (i is None or i > least):
                gone[k:k + width] = [True] * width
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width, batch, span", [(5, 400, 20), (50, 4 << 20, 1 << 20), (3, 2000, 100)])
def test_removal_matches_brute_force(spark, width, batch, span):
    rnd = random.Random(width)
    rows = corpus(width, 80)
    passage = " ".join(f"p{k}" for k in range(70))
    rows += [(500 + k, f"a{k} {passage} b{k}" + (f" {passage}" if k % 3 == 0 else "")) for k in range(12)]
    rows += [(None, passage), (None, "q1 q2 q3 q4 q5 q6"), (None, "q1 q2 q3 q4 q5 q6"), (505, "z " + passage), (505, passage)]
    rnd.shuffle(rows)
    found = removal(frame(spark, rows), width=width, separator=" ", batch_bytes=batch, range_windows=span)
    got = [(r["doc_id"], r["n_words"], sum(b - a for a, b in zip(r["starts"], r["ends"])), r["text"]) for r in found.collect()]
    assert sorted(got, key=repr) == brute_removal(rows, width)


def test_removal_keeps_white_space_and_columns(spark):
    rows = [(1, "a b c d e"), (2, " x\ta b  c d\n e  y\n"), (3, None), (4, ""), (5, "a b c d")]
    got = {r["doc_id"]: r for r in removal(frame(spark, rows), width=4, carry=["id", "batch", "carry"]).collect()}
    assert got[2]["text"] == " x\te  y\n" and got[2]["carry"] == 3 and got[2]["batch"] == 2
    assert got[3]["text"] is None and got[4]["text"] == "" and got[5]["text"] == "" and got[1]["text"] == "a b c d e"
    assert removal(frame(spark, [])).collect() == []


def test_packed_hashes():
    rng = np.random.default_rng(1)
    for n, top in ((1, 2 ** 64 - 1), (2, 2 ** 64 - 1), (5000, 2 ** 64 - 1), (300, 400)):
        x = np.unique(rng.integers(0, top, n, dtype=np.uint64))
        assert (unpack(pack(x)) == x).all()


def test_window_hashes_do_not_depend_on_their_place():
    codes = np.random.default_rng(2).integers(0, 2 ** 63, 400).astype(np.uint64)
    whole = rolling(codes, 50)
    assert all(whole[k] == rolling(codes[k:k + 50], 50)[0] for k in range(0, 350, 7))


def test_digest(spark):
    text = "a b  c"
    got = removal(frame(spark, [(1, text)]), separator=" ").select(F.sha2(F.col("text").cast("binary"), 256)).first()[0]
    assert got == hashlib.sha256(b"a b c").hexdigest()


def test_files_follow_the_rows_and_not_the_shuffle_partitions(spark):
    """A file a partition, with a few links each, made thousands of files of a small group of copies."""
    rows = corpus(7, 200)
    held = {"spark.sql.shuffle.partitions": "30", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    folder = Path(shared_folder(spark).removeprefix("file://")) / "pricewright"
    old = set(folder.iterdir()) if folder.exists() else set()
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = {r["doc_id"]: r["component_id"] for r in near_duplicates(frame(spark, rows)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: c for i, (_, c) in brute_components(rows, 5, 80).items()}
    written = {p: len(list(p.glob("part-*.parquet"))) for p in set(folder.iterdir()) - old}
    few = {p.name: n for p, n in written.items() if p.name.startswith(("forest-", "near-classes-", "near-members-", "near-mixed-", "near-links-"))}
    assert len(few) >= 8 and set(few.values()) == {1}


@pytest.mark.parametrize("best", [4, None])
def test_no_more_pairs_than_counted(spark, best):
    rows = [(1, k % 3 == 0) for k in range(BLOCK + 1)] + [(2, True), (2, False)]
    odd = sum(o for k, o in rows if k == 1)
    mixed = spark.createDataFrame(rows, "key long, odd boolean")
    assert _most_pairs(mixed, best) == (odd * 4 * 2 + 4 if best else odd * (BLOCK + 1) + 2)
    assert _most_pairs(mixed.limit(0), best) == 0


def test_codes_of_slices_are_those_of_all_texts():
    texts = [t.encode() if t is not None else None for _, t in corpus(11)] + [None, b"", b" \t "]
    whole = word_codes(split_words(texts))
    for limit in (1, 40, 1 << 20):
        codes, ends = _codes(texts, limit)
        assert codes.dtype == np.uint64 and codes.tolist() == whole[0].tolist() and ends.tolist() == whole[1].tolist()
    assert [x.tolist() for x in _codes([])] == [[], [0]]


def test_workers_of_substring_removal_load_no_pandas():
    code = "import sys, pricewright.llm.substring; sys.exit('pandas' in sys.modules or 'pyspark.ml' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2]).returncode == 0


def test_arrow_batches_are_bounded_by_bytes(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        small_batches(spark)
        long = spark.range(40).repartition(1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
        sizes = [r[0] for r in long.mapInArrow(lambda batches: (type(b).from_pydict({"n": [b.nbytes]}) for b in batches), "n long").collect()]
        assert len(sizes) >= 8 and max(sizes) <= 6 << 20
        spark.conf.set(name, "16m")
        small_batches(spark)
        assert spark.conf.get(name) == "16m"  # the session's own bound stays
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
