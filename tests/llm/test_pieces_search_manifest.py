"""Piece encoding against the sentencepiece library, lexical search and Merkle manifests against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as wire

from pricewright.llm import manifest as M
from pricewright.llm.lexical import search, terms
from pricewright.llm.pieces import Decoder, Encoder, encode, read_model
from pricewright.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = " abcde▁\n\t中文ß̀é😀�\x00Ａ１ﬁ　\xa0ሀ."


def odd_texts(n=800):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return texts + ["", " ", "  ", "   a  b ", "a" * 5000, "中" * 3000, " " * 300, "ab" * 4000 + " " * 50, "x y" * 20]


def changed_model(tmp_path, name, change):
    model = wire.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    change(model)
    path = str(tmp_path / f"{name}.model")
    with open(path, "wb") as file:
        file.write(model.SerializeToString())
    return path


def folding(squeeze):
    def change(model):
        rules = wire.ModelProto()
        rules.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc").serialized_model_proto())
        model.normalizer_spec.precompiled_charsmap = rules.normalizer_spec.precompiled_charsmap
        model.normalizer_spec.remove_extra_whitespaces = squeeze
    return change


def without_bytes(model):
    folding(True)(model)
    model.trainer_spec.byte_fallback = False
    for piece in model.pieces:
        piece.type = 1 if piece.type == 6 else piece.type


def user_pieces(model):
    for i in (400, 5000, 12000):
        model.pieces[i].type = 4


CHANGES = {"as it is": lambda model: None, "character map": folding(False), "map and squeezed spaces": folding(True), "no byte pieces": without_bytes, "user pieces": user_pieces}


@pytest.mark.parametrize("name", CHANGES)
def test_pieces_equal_the_library(tmp_path, name):
    path = changed_model(tmp_path, name, CHANGES[name])
    library, model = sentencepiece.SentencePieceProcessor(model_file=path), read_model(path)
    encoder, decoder = Encoder(model), Decoder(model)
    texts = odd_texts()
    for text, (ids, starts, ends) in zip(texts, encoder(texts)):
        want = library.encode(text) + [model.end]
        assert ids.tolist() == want, text
        assert decoder(want) == library.decode(want), text
        spans = [(p.begin, p.end) for p in library.encode(text, return_type="proto").pieces]
        assert list(zip(starts.tolist(), ends.tolist()))[:-1] == spans, text
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.choice([rng.randrange(len(model.pieces)), rng.randrange(300), model.end, 1]) for _ in range(rng.randint(0, 8))]
        assert decoder(ids) == library.decode(ids), ids


def test_long_texts_are_cut_without_a_trace(monkeypatch):
    from pricewright.llm import pieces

    model = read_model(MODEL)
    text = " ".join(odd_texts(200))
    whole = Encoder(model)([text])[0]
    monkeypatch.setattr(pieces, "BLOCK", 50)
    cut = Encoder(model)([text])[0]
    assert all((a == b).all() for a, b in zip(whole, cut))


def test_models_of_other_kinds_are_refused(tmp_path):
    def unigram(model):
        model.trainer_spec.model_type = 1
    with pytest.raises(ValueError):
        read_model(changed_model(tmp_path, "unigram", unigram))


def test_sentencepiece_query(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_sentencepiece"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == set(texts) and len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]]) + [2]
        assert r["n_tokens"] == len(ids) and r["spanned_bytes"] == len(texts[r["doc_id"]].encode())
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_encode_edges(spark):
    table = spark.createDataFrame([(1, None, "x", 1), (2, "", "x", 1), (None, "a b", "x", 1), (2, "", "x", 1)], "doc_id long, text string, ids string, starts int")
    model = read_model(MODEL)
    got = sorted((r["key"] or 0, r["ids"], r["starts"], r["ends"], r["decoded"]) for r in encode(table, F.col("doc_id"), model).collect())
    assert got[1:] == [(1, [2], [0], [0], ""), (2, [2], [0], [0], ""), (2, [2], [0], [0], "")]
    assert got[0][4] == "a b" and got[0][3][-2:] == [3, 3]
    assert encode(table.limit(0), F.col("doc_id"), model).collect() == []


# ---- lexical search ----

def brute_search(docs, items, k=10):
    """Plain scores of all pairs; docs and items are (id, text)."""
    def words(text):
        return [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
    bags = [(i, words(t)) for i, t in docs]
    n_docs, n_all = sum(bool(w) for _, w in bags), sum(len(w) for _, w in bags)
    out = []
    for item, text in items:
        found = []
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in w for _, w in bags) + 1))) for t in set(words(text))}
        for i, w in bags:
            m = 100 - 90 + 90 * len(w) * n_docs // n_all if n_all else 0
            score = sum(x * (1_000_000_000 * w.count(t) // (1000 * w.count(t) + 8 * m)) for t, x in weights.items() if t in w)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -score) for rank, (score, null, i) in enumerate(sorted(found)[:k], 1)]
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[3], r[2] is None, r[2] or 0))


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("bucket, shard", [(4, 60), (3, 100_000), (256, 40)])
def test_search_equals_brute_force(spark, seed, bucket, shard):
    rng = random.Random(seed)
    vocabulary = ["a", "B", "c1", "ñu", "ß", "中文", "e", "the", "THE", "x-y", "é_f", "q"]
    texts = [" ".join(rng.choice(vocabulary[:rng.randint(2, 12)]) for _ in range(rng.randint(0, 25))) for _ in range(150)]
    texts += [texts[3]] * 30 + ["a b"] * 20 + [None, "", "--", "zzz " * 300]
    docs = [(i if i % 40 else None, t) for i, t in enumerate(texts)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 9)))) for i in range(12)] + [(90, None), (91, ""), (92, "unseen words"), (3, "a q ñu"), (None, "the b")]
    frame = spark.createDataFrame([(i, t, "c", 1) for i, t in docs], "doc_id long, text string, item string, rank int").repartition(3)
    wanted = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in search(frame, wanted, bucket=bucket, shard=shard).select("item_id", "rank", "doc_id", "score").collect()]
    assert order(got) == order(brute_search(docs, items))


def test_search_in_blocks_and_edges(spark, monkeypatch):
    from pricewright.llm import lexical

    docs = spark.createDataFrame([(1, "a b c"), (2, "b c d"), (3, "e")], "doc_id int, text string")
    items = spark.createDataFrame([(f"i{i}", t) for i, t in enumerate(["a", "b d", "e e", "c", "none"])], "item_id string, text string")
    one = sorted(map(tuple, search(docs, items).collect()))
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 3)
    assert sorted(map(tuple, search(docs, items).collect())) == one and {r[0] for r in one} == {"i0", "i1", "i2", "i3"}
    assert search(docs.limit(0), items).collect() == [] and search(docs, items.limit(0)).collect() == []


def test_terms_of_long_texts(monkeypatch):
    from pricewright.llm import lexical

    text = " ".join(f"w{i}, Ä{i}" for i in range(500)).encode()
    whole = [w for part in terms(text) for w in part]
    monkeypatch.setattr(lexical, "_PIECE", 64)
    assert [w for part in terms(text) for w in part] == whole and len(whole) == 1000


# ---- manifest ----

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    """Root, subroots, and per row (id, leaf, subroot, root, siblings digest, folded root), by plain trees."""
    def leaf(row):
        return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
        return levels

    def walk(levels, at):
        for level in levels[:-1]:
            a = at // 16 * 16
            yield level[a:at], level[at + 1:a + 16]
            at //= 16

    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[name] = climb([leaf(r) for r in groups[name]])
    top = climb([trees[n][-1][0] for n in names])
    out = []
    for j, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            steps = [*walk(trees[name], i), *walk(top, j)]
            shown = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                shown = (*row[:4], re.sub("[A-Z]", lambda m: m.group().lower(), row[4]))
            node = leaf(shown)
            for left, right in steps:
                node = h(*left, node, *right)
            siblings = h(*[x for left, right in steps for x in left + right])
            out.append((row[0], leaf(row), trees[name][-1][0], top[-1][0], siblings, node, node == top[-1][0]))
    return out


def manifest_rows(spark, tmp_path, rows):
    kinds = "doc_id long, source string, lang string, n_chars long, text string, pos int, run string, tree int"
    spark.createDataFrame([(*r, 1, "x", 2) for r in rows], kinds).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    return [tuple(r) for r in QUERIES["op13_merkle_manifest"](spark, str(tmp_path)).collect()]


def by_repr(rows):
    return sorted(rows, key=repr)


def test_manifest_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    sources = [None, "", "a", "b", "é", "Z", *[f"s{i}" for i in range(30)]]
    rows = [(rng.choice([None, -5, 3, 7, 2**40]) if rng.random() < 0.2 else rng.randrange(-10**6, 10**6), rng.choice(sources), rng.choice([None, "en"]),
             rng.choice([None, 5]), rng.choice([None, "", "Text Ä", "lower", "Ünder"])) for _ in range(700)]
    rows += [(i, "big", "en", 1, f"T{i}") for i in range(600)] + [rows[0]] * 20 + [(9, "big", None, None, "x")] * 40 + [(9, "big", None, i, "y") for i in range(30)]
    rows += [((1 << 62) + i * 10**15, "sparse", None, None, "s") for i in range(40)] + [(-(1 << 63), "sparse", None, None, None), ((1 << 63) - 1, "sparse", None, None, None)]
    assert by_repr(manifest_rows(spark, tmp_path, rows)) == by_repr(brute_manifest(rows))


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", 1, "Abc")], [(1, None, None, None, None)] * 17, [(i, "a", None, None, "X" * 100_000) for i in range(17)]])
def test_small_manifests(spark, tmp_path, rows):
    assert by_repr(manifest_rows(spark, tmp_path, rows)) == by_repr(brute_manifest(rows))


def test_directory_has_several_levels(spark, monkeypatch):
    monkeypatch.setattr(M, "FAN", 4)
    rng = random.Random(5)
    keys = rng.sample(range(-10**5, 10**5), 300)
    rows = spark.createDataFrame([(i, "t", k, f"{k}") for i, k in enumerate(keys)], "row long, tree string, key long, leaf string")
    got = {r["key"]: r["pos"] for r in M.ranked(rows).collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}
