"""Nearest neighbours, retrieval packing, WARC and mixing against brute force, and their edge cases."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricewright.llm import neighbours as N
from pricewright.llm import packing as P
from pricewright.llm import warc as W
from pricewright.llm.mixing import MARGINS, mix, rake
from pricewright.llm.packing import Shard, Tokens, fill, pack, read_vocabulary
from pricewright.llm.queries import QUERIES, vocabulary
from pricewright.llm.warc import LoserTree, capture_index, read_archives, records, round_trip, url_key, write_archives
from pricewright.session import new_table_path

SF = "/root/testdata/sf0.01"


def exact(ids, x, q, k):
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    d[ids == ids[q]] = np.inf
    order = np.lexsort((ids, d))[:k]
    return ids[order], d[order]


def test_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").toPandas()
    x, ids = np.stack(rows.embedding).astype(float), rows.vec_id.to_numpy()
    got = QUERIES["op6_nearest_neighbours"](spark, "/root/testdata/sf0.1").toPandas()
    hits = 0
    queries = np.flatnonzero(ids % 100 == 0)
    for q in queries:
        mine = got[got.query_id == ids[q]].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11)) and (np.diff(mine.score) >= 0).all()
        distance = {i: np.sqrt(((v - x[q]) ** 2).sum()) for i, v in zip(ids, x)}
        assert np.allclose([distance[v] for v in mine.vec_id], mine.score, atol=1e-12, rtol=0)
        hits += len(set(exact(ids, x, q, 10)[0]) & set(mine.vec_id))
    assert hits / (10 * len(queries)) >= 0.9


def test_neighbours_edges(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 16)
    kinds = "vec_id long, embedding array<float>, id int, v string, list int, piece int, side int"
    rng = np.random.default_rng(1)
    good = [(k, [float(v) for v in rng.normal(size=4)]) for k in range(120)] + [(200 + k, [1.0, 0.0, 0.0, 0.0]) for k in range(60)]
    bad = [(300, None), (400, [0.0] * 4), (500, [1.0, None, 0.0, 0.0]), (600, [float("nan"), 1.0, 1.0, 1.0]), (700, [float("inf"), 1.0, 1.0, 1.0]), (800, [1.0, 2.0]), (None, [1.0, 1.0, 1.0, 1.0]), (900, [])]
    table = spark.createDataFrame([(i, v, 1, "v", 2, 3, 4) for i, v in good + bad + [good[0]]], kinds)
    got = N.nearest_neighbours(table, F.col("id") % 100 == 0).toPandas()
    assert sorted(set(got.query_id)) == [0, 100, 200] and not set(got.vec_id) & {b[0] for b in bad}
    assert got[got.query_id == 200].sort_values("rank").vec_id.tolist() == list(range(201, 211))  # ties to the smaller id
    assert 0 not in got[got.query_id == 0].vec_id.tolist() and not got.duplicated(["query_id", "vec_id"]).any()
    few = N.nearest_neighbours(table.where("vec_id < 4"), F.lit(True)).toPandas()
    assert few.groupby("query_id").size().tolist() == [3] * 4
    assert N.nearest_neighbours(table.limit(0), F.lit(True)).collect() == []
    assert N.nearest_neighbours(table.where("vec_id = 300"), F.lit(True)).collect() == []


def clustered(spark, seed, groups, each, size, spread, dims=16):
    """Vectors in groups: centres of ``size``, members some ``spread`` around them."""
    rng = np.random.default_rng(seed)
    x = np.repeat(rng.normal(size=(groups, dims)) * size, each, axis=0) + rng.normal(size=(groups * each, dims)) * spread
    x, ids = x[rng.permutation(len(x))], np.arange(len(x))
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>").repartition(8)
    return frame, ids, x


def recall(spark, frame, ids, x, step):
    got = N.nearest_neighbours(frame, F.col("id") % step == 0).toPandas()
    assert not got.duplicated(["query_id", "vec_id"]).any() and len(got) == 10 * len(ids[::step])
    return sum(len(set(exact(ids, x, q, 10)[0]) & set(got[got.query_id == ids[q]].vec_id)) for q in range(0, len(ids), step)) / len(got)


def test_recall_of_the_lists(spark, monkeypatch):
    """20,000 vectors in overlapping groups; queries of a list in parts."""
    monkeypatch.setattr(N, "QUERY_CHUNK", 16)
    found = recall(spark, *clustered(spark, 1, 400, 50, 1.0, 0.7), 100)
    print("recall of the lists", found)
    assert found >= 0.9


@pytest.mark.parametrize("size, spread", [(1e3, 1e-5), (1e5, 1e-4), (1e6, 1.0), (1e-3, 1e-9)])
def test_near_copies_far_from_the_origin(spark, size, spread):
    found = recall(spark, *clustered(spark, 2, 30, 200, size, spread), 100)
    print("recall", size, spread, found)
    assert found >= 0.9


def test_rows_that_share_an_id_do_not_hide_others(spark):
    rng = np.random.default_rng(6)
    rows = [(7, [1.0 + 1e-9 * k, 0.0]) for k in range(400)] + [(k, rng.normal(size=2).tolist()) for k in range(1000, 1040)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = N.nearest_neighbours(table, F.col("id") == 7).toPandas()
    assert got.vec_id.is_unique or (got.groupby(["query_id", "rank"]).size() >= 1).all()
    x = np.array([v for k, v in rows if k >= 1000])
    want = {1000 + int(i) for i in np.argsort(((x - [1.0, 0.0]) ** 2).sum(axis=1))[:10]}
    assert set(got.vec_id) == want


@pytest.fixture(scope="module")
def byte_vocabulary():
    return read_vocabulary(vocabulary("byte_bpe_50k.json"))


def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_tokens_equal_the_library(spark, byte_vocabulary):
    mine, other, rnd = Tokens(byte_vocabulary, public_tokenizers.PATTERN), library(), random.Random(5)
    letters = list("ab  the'sl \n\n\t\x1c\xa0 é梦12#.<|endoftext|>")
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(5000)] + ["a <|endoftext|> b", "", " ", "x" * 300]
    texts += [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for t in texts:
        assert np.frombuffer(mine(t), np.uint16).tolist() == other.encode(t, add_special_tokens=False).ids


def check_pieces(got, texts, window):
    """``got``: pieces by document key; every id in one piece, sequences gapless and without padding."""
    other = library()
    for key, text in texts.items():
        ids = other.encode(text or "", add_special_tokens=False).ids + [0]
        mine = got[got.doc_id == key].sort_values("start")
        assert (mine.doc_tokens == len(ids)).all() and mine.length.sum() == len(ids) and (mine.length > 0).all()
        assert (mine.start == mine.length.cumsum() - mine.length).all()
        for row in mine.itertuples():
            assert zlib.crc32(np.array(ids[row.start:row.start + row.length], "<u4").tobytes()) == row.ids_crc32
    got = got.sort_values(["sequence_id", "offset"])
    sizes = got.groupby("sequence_id").length.sum()
    assert (got.offset == got.groupby("sequence_id").length.cumsum() - got.length).all()
    assert all(n == window or (n < window and n & (n - 1) == 0) for n in sizes)


@pytest.mark.parametrize("window, shard", [(1024, 1 << 20), (64, 4000)])
def test_packing(spark, byte_vocabulary, window, shard):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = pack(docs, byte_vocabulary, public_tokenizers.PATTERN, window=window, shard_tokens=shard).toPandas()
    check_pieces(got, {r["doc_id"]: r["text"] for r in docs.collect()}, window)


def test_packing_edges(spark, byte_vocabulary):
    kinds = "doc_id long, text string, shard int, place string, ids int, n_tokens int, id int"
    rows = [(1, None), (2, ""), (3, "word " * 3000), (4, " \n "), (None, "x y")]
    table = spark.createDataFrame([(i, t, 1, "p", 2, 3, 4) for i, t in rows], kinds)
    got = pack(table, byte_vocabulary, public_tokenizers.PATTERN, with_ids=True).toPandas()
    check_pieces(got, dict(rows[:-1]), 1024)
    assert (got.ids.map(len) == got.length).all() and got[got.doc_id.isna()].length.sum() == 3
    twice = pack(spark.createDataFrame([(7, "a b c", 1, "p", 2, 3, 4)] * 2, kinds), byte_vocabulary, public_tokenizers.PATTERN).toPandas()
    assert twice.length.sum() == 2 * 4
    assert pack(table.limit(0), byte_vocabulary, public_tokenizers.PATTERN).collect() == []


def test_windows_are_filled_with_neighbours():
    a, b = [np.arange(10 * k, 10 * k + 8, dtype=np.uint16) for k in (1, 50)]
    parts = [np.r_[a, [300 + k]].astype(np.uint16) if k % 2 else np.r_[b, [300 + k]].astype(np.uint16) for k in range(8)]
    pieces = fill(parts, np.ones(1000), 9.0, 36)
    groups = [{d % 2 for d, _, _, s, _ in pieces if s == q} for q in (0, 1)]
    assert all(len(g) == 1 for g in groups)


def test_neighbours_far_apart_share_windows_across_shards(spark, byte_vocabulary):
    rnd = random.Random(3)
    words = sorted(w[1:] for w in byte_vocabulary if w.startswith("Ġ") and w[1:].isascii() and w[1:].isalpha() and len(w) > 4)
    rnd.shuffle(words)
    common, own = words[:400], words[400:]
    rows = []
    for group in range(100):
        mine = own[60 * group:60 * group + 60]
        rows += [(group + 1000 * k, " ".join(rnd.sample(mine, 45) + rnd.sample(common, 45))) for k in range(4)]
    rows += [(10_000 + k, " ".join(own[6000:6090])) for k in range(200)]  # one large group of copies
    table = spark.createDataFrame(rows, "doc_id long, text string")

    def together(shard_tokens):
        got = pack(table, byte_vocabulary, public_tokenizers.PATTERN, window=512, shard_tokens=shard_tokens).toPandas()
        check_pieces(got, dict(rows), 512)
        where = got.groupby("doc_id").sequence_id.agg(set).to_dict()
        planted = [d for d in where if d < 10_000]
        share = sum(any(where[d] & where[e] for e in range(d % 1000, 4000, 1000) if e != d) for d in planted) / len(planted)
        return share, got.groupby(got.sequence_id // 2 ** 32).length.sum()

    (whole, _), (several, sizes) = together(1 << 20), together(6000)
    print("planted neighbours in one window: one shard", whole, "shards", len(sizes), several)
    assert len(sizes) >= 6 and sizes.max() < 3 * 6000
    assert several >= 0.6 * whole and several > 0.3  # by a hash of the id, 0.08


def test_seeds_are_asked_with_all_tokens():
    seed = np.arange(1, 101, dtype=np.uint16)  # 100 distinct tokens; the last are the commonest
    idf = np.linspace(5, 1, 200)
    score = Shard([seed, np.arange(90, 130, dtype=np.uint16), np.arange(130, 170, dtype=np.uint16)], idf, 60.0).scores(0)
    assert score[1] > 0 and score[2] == 0


def test_scores_of_free_documents_stay_when_others_are_taken():
    rng = np.random.default_rng(4)
    parts = [np.r_[rng.integers(1, 30, 12), rng.integers(30, 400, rng.integers(0, 40))].astype(np.uint16) for _ in range(60)]
    idf = np.linspace(0.1, 6, 500)
    mean = np.mean([len(p) for p in parts])

    def plain(seed):
        terms = np.unique(parts[seed])
        n = np.array([[np.sum(p == t) for t in terms] for p in parts])
        norm = P.K1 * (1 - P.B + P.B * np.array([len(p) for p in parts]) / mean)
        return (idf[terms] * n * (P.K1 + 1) / (n + norm[:, None])).sum(axis=1)

    shard, free = Shard(parts, idf, mean), np.ones(60, bool)
    assert 0 < len(shard.rows) and 0 < len(shard.doc)  # tokens of many documents and others
    for taken in ([], [0, 7, 8], range(20, 50), range(60)):
        free[list(taken)] = False
        held = shard.rows.size + len(shard.doc)
        shard.keep(free)
        assert shard.rows.size + len(shard.doc) < held or not len(taken)  # less to look through
        for seed in (0, 7, 33, 59):
            assert np.allclose(shard.scores(seed), np.where(free, plain(seed), 0), rtol=1e-12, atol=0)


def test_the_encoder_does_not_look_for_special_tokens_at_every_byte(byte_vocabulary):
    mine, other, rnd = Tokens(byte_vocabulary, public_tokenizers.PATTERN), library(), random.Random(9)
    assert mine.encoder.special_tokens_set == {P.NEVER}  # an empty set matches everywhere
    assert public_tokenizers.PATTERN in P.FASTER
    pieces = [" ", "  ", "\n", "\t", "\u3000", "\x85", "\x1c", "'", "'s", "'LL", "'ll", "é", "7", "x", "Word", "…", "\U0001f600", P.NEVER]
    texts = ["".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25))) for _ in range(4000)] + [" " * 500 + "x", "x" + " " * 500]
    for t in texts:
        assert np.frombuffer(mine(t), np.uint16).tolist() == other.encode(t, add_special_tokens=False).ids
    assert Tokens({}, public_tokenizers.PATTERN, P.byte_ranks(byte_vocabulary))(texts[0]) == mine(texts[0])


def test_loser_tree():
    rnd = random.Random(0)
    for n in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rnd.randint(0, 40) for _ in range(rnd.randint(0, 30))) for _ in range(n)]
        assert list(LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "d", "r") for i, u, h in rows], "page_id long, url string, html string, id int, digest string, first string")


def test_warc_round_trip(spark):
    body = "<p>é\r\n\r\nWARC/1.1\r\n\r\n</p>"
    rows = [(5, "http://a.example/x y", body), (3, "http://b.example/", body), (9, None, None), (8, "", ""), (4, "u\r\nContent-Length: 3", "z" * 100_000), (None, "x", "y"), (6, "http://a.example/", "q"), (6, "http://c.example/", "r")]
    path = new_table_path(spark, "warc")
    write_archives(pages(spark, rows), path, archive_bytes=50_000)
    got = {r["id"]: r for r in read_archives(spark, path, with_payload=True).collect()}
    assert sorted(got) == [3, 4, 5, 6, 8, 9]
    assert got[3]["record_type"] == "response" and got[3]["payload"] == body.encode() and got[3]["refers_to"] is None
    assert got[5]["record_type"] == "revisit" and got[5]["refers_to"] == 3 and got[5]["payload_bytes"] == len(body.encode())
    assert got[9]["refers_to"] == 8 and got[9]["payload_bytes"] == 0 and got[4]["payload_bytes"] == 100_000
    for row in got.values():
        text = next(h for i, _, h in rows if i == row["id"]) or ""
        if row["id"] != 6:
            assert row["payload_digest"] == base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()
    loose = {r["id"]: r["record_type"] for r in round_trip(pages(spark, rows), least=1000).collect()}
    assert set(loose.values()) == {"response"}
    assert round_trip(pages(spark, [])).collect() == []
    with pytest.raises(ValueError):
        list(records(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nabcd\r\n\r\n"))


def test_capture_index_is_globally_ordered(spark):
    rnd = random.Random(6)
    rows = [(k, "http://hot.example/" if k % 3 == 0 else f"https://www.s{rnd.randrange(30)}.example:80/p{rnd.randrange(9)}", f"body {k % 70}") for k in range(400)]
    path = new_table_path(spark, "warc")
    write_archives(pages(spark, rows), path, archive_bytes=300)
    found = read_archives(spark, path)
    for run_rows in (7, 1000):
        got = capture_index(found, span_rows=60, run_rows=run_rows).orderBy("position").collect()
        keys = [(r["url_key"], r["date"], r["id"]) for r in got]
        assert keys == sorted(keys) and len(keys) == 400 and len({r["span"] for r in got}) > 3
        assert [r["position"] for r in got] == list(range(400)) and [r["span"] for r in got] == sorted(r["span"] for r in got)
    assert capture_index(found.limit(0)).collect() == []
    shown = spark.range(1).select(url_key(F.lit("HTTP://www.News.Example.com:80/A?b=C#d")).alias("x"), url_key(F.lit("a.b")).alias("y")).first()
    assert tuple(shown) == ("com,example,news)/A?b=C", "b,a)/")


def test_archives_are_cut_by_bytes(spark):
    """Many small pages before some large ones: no archive holds more than its size and one record."""
    rows = [(k, f"http://s.example/{k}", "x" * (20 if k < 2000 else 50_000)) for k in range(2030)]
    path = new_table_path(spark, "warc")
    write_archives(pages(spark, rows).coalesce(1), path, archive_bytes=100_000)
    sizes = [r[0] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("length").collect()]
    assert max(sizes) < 100_000 + 51_000 and len(sizes) > 8
    assert read_archives(spark, path).count() == 2030


def test_op8_takes_its_rows_from_the_merged_index(spark, monkeypatch):
    merged = []
    monkeypatch.setattr(W, "SPAN_ROWS", 40)
    monkeypatch.setattr(W, "capture_index", lambda found, real=W.capture_index: merged.append(real(found, W.SPAN_ROWS)) or merged[-1])
    got = QUERIES["op8_warc"](spark, SF).collect()
    order = merged[0].orderBy("span", "position").collect()
    keys = [(r["url_key"], r["date"], r["id"]) for r in order]
    assert keys == sorted(keys) and len({r["span"] for r in order}) > 3
    want = {(r["id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"], r["position"], r["url_key"], r["date"]) for r in order}
    assert {tuple(r) for r in got} == want and len(got) == len(order) == spark.read.parquet(f"{SF}/pages.parquet").count()


def brute_rake(cells, rounds, temper):
    t = np.array([c[3] for c in cells], float)
    w = t / t.sum()
    for _ in range(rounds):
        for m in range(3):
            values = sorted({c[m] for c in cells}, key=repr)
            mass = {v: sum(x for c, x in zip(cells, t) if c[m] == v) ** temper for v in values}
            total = sum(mass.values())
            has = {v: sum(x for c, x in zip(cells, w) if c[m] == v) for v in values}
            w = np.array([x * mass[c[m]] / total / has[c[m]] for c, x in zip(cells, w)])
    return w


def test_raking_matches_numpy(spark):
    rnd = random.Random(8)
    cells = [(s, g, t, rnd.randint(1, 900)) for s in ("a", "b", None) for g in ("x", None, "y") for t in ("p", "q") if rnd.random() < 0.85]
    table = spark.createDataFrame(cells, "source string, language string, topic string, tokens long")
    got = {tuple(r[m] for m in MARGINS): r["weight"] for r in rake(table, rounds=5).collect()}
    want = brute_rake(cells, 5, 0.7)
    assert all(abs(got[c[:3]] - w) < 1e-12 for c, w in zip(cells, want)) and len(got) == len(cells)
    given = {"source": {"a": 3, "b": 1}, "language": {None: 1, "x": 1, "y": 2}}
    raked = rake(table, given, rounds=40).collect()
    assert sum(r["weight"] for r in raked if r["source"] == "a") == pytest.approx(0.75, abs=0.01)
    assert sum(r["weight"] for r in raked if r["source"] is None) == 0


def test_mixture_meets_targets(spark):
    rows = mix(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")).toPandas()
    assert rows.probability.between(0, 1).all() and rows.probability.max() == 1 and len(rows) == 10_000
    drawn = rows[rows.sampled]
    expected = (rows.n_tokens * rows.probability).groupby(rows.language).sum()
    share = expected / expected.sum()
    tokens = rows.groupby("language").n_tokens.sum() ** 0.7
    assert np.allclose(share.sort_index(), (tokens / tokens.sum()).sort_index(), atol=0.01)
    real = drawn.groupby("language").n_tokens.sum()
    assert np.allclose((real / real.sum()).sort_index(), share.sort_index(), atol=0.06)


def test_a_rare_cell_does_not_shrink_a_mixture_of_a_given_share(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text", "lang", "source")
    rare = docs.unionByName(spark.createDataFrame([(10 ** 9, "one two three four five", "en", "rare")], docs.schema))
    kept = {}
    for name, table, share in (("default", docs, None), ("default with a rare source", rare, None), ("half", docs, 0.5), ("half with a rare source", rare, 0.5)):
        rows = mix(table, share=share).toPandas()
        assert rows.probability.between(0, 1).all()
        kept[name] = (rows.n_tokens * rows.probability).sum() / rows.n_tokens.sum()
        if share:  # cells that are not taken whole keep their proportions
            cells = rows[(rows.probability < 1) & (rows.n_tokens > 0)].groupby(list(MARGINS)).agg(p=("probability", "first"), w=("weight", "first"), t=("n_tokens", "sum"))
            assert np.allclose(cells.p * cells.t / cells.w, (cells.p * cells.t / cells.w).iloc[0], rtol=1e-4)
    print("kept shares", kept)
    assert kept["half"] == pytest.approx(0.5, abs=1e-6) and kept["half with a rare source"] == pytest.approx(0.5, abs=1e-6)
    few = spark.createDataFrame([(1, "a b", "en", "x")], docs.schema)
    assert [r["probability"] for r in mix(few, share=1.0).collect()] == [1.0] and mix(few.limit(0), share=0.5).collect() == []


def test_mixture_edges(spark):
    kinds = "doc_id long, text string, lang string, source string, id int, topic string, weight int, tokens int"
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "a b " * 50_000, "en", "a"), (4, "x", None, "a"), (4, "x", None, "a"), (None, "y z", "de", "b")]
    table = spark.createDataFrame([(*r, 1, "t", 2, 3) for r in rows], kinds)
    got = mix(table).collect()
    assert len(got) == 6 and {r["doc_id"]: r["n_tokens"] for r in got} == {1: 0, 2: 0, 3: 100_000, 4: 1, None: 2}
    assert not any(r["sampled"] for r in got if r["n_tokens"] == 0)
    assert len({(r["probability"], r["sampled"]) for r in got if r["doc_id"] == 4}) == 1
    assert {r["topic"] for r in mix(table, topic=F.col("topic")).collect()} == {"t"}
    assert mix(table.limit(0)).collect() == []
    assert all(r["probability"] <= 1 for r in mix(table, budget=1e9).collect())


def test_packing_runs_one_python_step_a_task(spark, byte_vocabulary, capsys):
    """Two steps in a row need two workers a core."""
    docs = spark.createDataFrame([(i, f"word{i} and more") for i in range(20)], "doc_id long, text string")
    pack(docs, byte_vocabulary, public_tokenizers.PATTERN, shard_tokens=32).explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
