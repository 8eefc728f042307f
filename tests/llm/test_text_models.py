"""Quality rules, the two classifiers and token counts: brute force, held-out accuracy, edge cases."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from pricewright.llm import perplexity as P
from pricewright.llm.language import BUCKET_BITS, DIMENSION, LanguageModel, _calibrate, fit_language, identify, subwords, train
from pricewright.llm.passages import WIDTH, PassageModel, encode, fit_quality, score_quality
from pricewright.llm.queries import QUERIES, vocabulary
from pricewright.llm.token_counts import MARK, PieceCounter, count_tokens, read_pieces

SF = "/root/testdata/sf0.01"
EDGES = "doc_id long, text string, lang string, key string, score int, l string, language int, n int"
LONG = " ".join(["lorem", "ipsum", "dolor", "###"] * 20_000)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "k", 1, "l", 2, 3) for i, t, g in rows], EDGES)


def expected_rules(text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            lines += line in seen
            seen.add(line)
    times = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {k + j for k in range(len(w) - 2) if times[tuple(w[k:k + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(covered)


def test_rules_match_brute_force():
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab #|é\n\t\x0b  <x ") for _ in range(rnd.randint(0, 120))) for _ in range(400)] + [None, "", LONG, "a a a", "a a a a", "\n\n a\n a"]
    found = P.rules([None if t is None else t.encode() for t in texts])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert [tuple(int(found[n][k]) for n in names) for k in range(len(texts))] == [expected_rules(t) for t in texts]


CORPUS = ["the cat sat on the mat. " * 5, "a dog, a log, a fog 12", "Пёс спит. Кот спит, 猫が寝る 🙂🙂", "the cat, the dog\n\nthe log", None, "", "x\0y"]


def units(text):
    """Units of a text, found apart from the table of the operator: three to stand before it, then its code units."""
    classes = {c: marks[0] for marks in (" \t\x0b\x0c\r", ".!?…", ",;:", "'’\"“”«»", "()[]{}-–—/", "#*$%&|<>", "_=+@~^`\\") for c in marks}
    out = [0, 0, 0]
    for c in text or "":
        c = "\x01" if c == "\0" else classes.get(c, "0" if c.isdigit() and ord(c) < 1 << 16 else c.lower())
        raw = c.encode("utf-16-le")
        out += [int.from_bytes(raw[k:k + 2], "little") for k in range(0, len(raw), 2)]
    return out


class Plain:
    """Modified Kneser-Ney over dictionaries of tuples."""

    def __init__(self, texts):
        counts = collections.Counter(tuple(u[k - 3:k + 1]) for u in map(units, texts) for k in range(3, len(u)))
        levels = {4: counts}
        for order in (3, 2, 1):
            levels[order] = collections.Counter(g[1:] for g in levels[order + 1])
        self.levels, self.discount, self.followers = levels, {}, {}
        for order, level in levels.items():
            c1, c2, c3, c4 = (max(1, sum(n == k for n in level.values())) for k in (1, 2, 3, 4))
            y = c1 / (c1 + 2 * c2)
            raw = 1 - 2 * y * c2 / c1, 2 - 3 * y * c3 / c2, 3 - 4 * y * c4 / c3
            self.discount[order] = [min(max(d, 0), top) for d, top in zip(raw, (0.95, 1.9, 2.85))]
            self.followers[order] = collections.defaultdict(list)
            for g, n in level.items():
                self.followers[order][g[:-1]].append(n)

    def __call__(self, gram):
        order = len(gram)
        if order == 0:
            return 1 / (len(self.levels[1]) + 1)
        seen = self.followers[order].get(gram[:-1])
        if seen is None:
            return self(gram[1:])
        cut = lambda n: self.discount[order][min(n, 3) - 1]
        spare = max(1e-6, sum(map(cut, seen)) / sum(seen))
        n = self.levels[order][gram]
        return ((n - cut(n)) / sum(seen) if n else 0) + spare * self(gram[1:])


def packed(gram):
    code = sum(unit << 16 * (3 - k) for k, unit in enumerate(gram))
    return code - (1 << 64) if code >= 1 << 63 else code


def test_kneser_ney_equals_a_plain_version(spark):
    docs = spark.createDataFrame([(t,) for t in CORPUS], "text string")
    model, plain = P.fit_kneser_ney(docs), Plain(CORPUS)
    assert {r["gram"]: r["n"] for r in P.count_grams(docs, "text").collect()} == {packed(g): n for g, n in plain.levels[4].items()}
    for order in (1, 2, 3, 4):
        got = {r["gram"]: r["logp"] for r in model.orders[order - 1].collect()}
        assert got == pytest.approx({packed((0,) * (4 - order) + g): np.log(plain(g)) for g in plain.levels[order]}, abs=1e-9)
    rnd = random.Random(4)
    known = sorted(g[0] for g in plain.levels[1])
    wanted = {tuple(rnd.choice([*known, 0x5B57, 0xFFFD]) for _ in range(4)) for _ in range(400)}
    for g in sorted(plain.levels[4])[:60]:  # unseen units after seen contexts, and the other way round
        wanted |= {(*g[:3], 0x5B57), (*g[:2], 0x5B57, g[3]), (0x5B57, *g[1:])}
    frame = spark.createDataFrame([(packed(g),) for g in wanted], "gram long")
    got = {r["gram"]: r["logp"] for r in model.scores(frame).collect()}
    assert got == pytest.approx({packed(g): np.log(plain(g)) for g in wanted}, abs=1e-9)


def test_probabilities_add_up(spark):
    model, plain = P.fit_kneser_ney(spark.createDataFrame([(t,) for t in CORPUS], "text string")), Plain(CORPUS)
    every = [*(g[0] for g in plain.levels[1]), 0x5B57]  # one unit that the corpus lacks
    for history in ((0, 0, 0), tuple(map(ord, "the")), tuple(map(ord, "zzz")), (0x5B57,) * 3):
        frame = spark.createDataFrame([(packed((*history, u)),) for u in every], "gram long")
        assert sum(np.exp(r["logp"]) for r in model.scores(frame).collect()) == pytest.approx(1, abs=4e-6)  # four weights of at least 1e-6


def plain_bands(rows, width, floor):
    """language -> lower, upper from (language, log perplexity): medians are the lower ones of rounded values."""
    middle = lambda v: sorted(v)[(len(v) + 1) // 2 - 1]
    out = {}
    for language in {g for g, v in rows if v is not None}:
        values = [int(np.floor(v / P.STEP + 0.5)) for g, v in rows if g == language and v is not None]
        half = max(floor, middle([abs(v - middle(values)) for v in values]) * P.STEP * width)
        out[language] = middle(values) * P.STEP - half, middle(values) * P.STEP + half
    return out


def test_verdicts_equal_a_plain_version(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    rows = [(r[0], r[1], r[2]) for r in docs.collect()]
    plain = Plain([t for _, t, _ in rows])
    means = {}
    for i, text, _ in rows:
        u = units(text)
        means[i] = -sum(np.log(plain(tuple(u[k - 3:k + 1]))) for k in range(3, len(u))) / (len(u) - 3) if len(u) > 3 else None
    limits = plain_bands([(g, means[i]) for i, _, g in rows], 4.0, 0.04)
    got = {r["key"]: r for r in P.quality(docs, F.col("doc_id"), F.col("lang")).collect()}
    assert len(got) == len(rows)
    for i, text, language in rows:
        n_words, _, _, _, repeat = expected_rules(text)
        failed = n_words < 50 or 100 * repeat > 50 * n_words
        room = 1 / max(len(units(text)) - 3, 1) ** 0.5
        inside = means[i] is not None and limits[language][0] - room <= means[i] <= limits[language][1] + room
        assert got[i]["log_perplexity"] == pytest.approx(means[i], abs=1e-5)
        assert (got[i]["base_failed"], got[i]["kept"]) == (failed, inside and not failed)


def test_large_models_are_joined_to_batches(spark, monkeypatch):
    rows = [(k, t, "x") for k, t in enumerate(CORPUS * 3)] + [(90, LONG, None), (None, "the cat", None), (91, None, None)]
    docs = frame(spark, rows).repartition(4, "doc_id")
    scores = P.fit_kneser_ney(docs).orders[3]
    once = lambda: sorted((tuple(r) for r in P.measure(docs, scores, F.col("doc_id"), F.col("lang")).collect()), key=str)
    sent = once()
    monkeypatch.setattr(P, "BROADCAST_GRAMS", 5)
    monkeypatch.setattr(P, "SLICE", 64)
    assert once() == sent and len(sent) == len(rows)
    empty = docs.where("text IS NULL")
    assert [r["log_perplexity"] for r in P.measure(empty, scores, F.col("doc_id"), F.col("lang")).collect()] == [None] * empty.count()


def test_bands_are_medians(spark):
    rows = [("x", v / 100) for v in (100, 101, 102, 103, 150)] + [(None, 2.0), (None, 2.1), (None, None)]
    got = {r["language"]: (r["lower"], r["upper"]) for r in P.bands(spark.createDataFrame(rows, "language string, log_perplexity double"), 2.0, 0.05).collect()}
    assert got["x"] == pytest.approx((1.02 - 0.05, 1.02 + 0.05)) and got[None][0] < 2.0 < got[None][1]


def test_quality_keeps_good_documents_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = P.quality(docs, F.col("doc_id"), F.col("lang")).join(spark.read.parquet(f"{SF}/labels.parquet"), F.col("key") == F.col("doc_id")).toPandas()
    good = found[(found.quality == 1) & ~found.base_failed]
    assert good.kept.mean() > 0.99
    bad = found[(found.quality == 0) & ~found.base_failed]
    assert bad.kept.mean() < 0.9 and not found[found.base_failed].kept.any()
    got = {r["key"]: r for r in P.quality(frame(spark, [(1, None, "en"), (2, "", None), (3, LONG, None), (3, LONG, None), (None, "a b", "x")]), F.col("doc_id"), F.col("lang")).collect()}
    assert got[1]["base_failed"] and got[2]["n_words"] == 0 and got[2]["log_perplexity"] is None
    assert got[3]["n_words"] == 80_000 and got[3]["base_failed"] and got[None]["n_words"] == 2
    assert P.quality(frame(spark, []), F.col("doc_id"), F.col("lang")).collect() == []


def test_quality_bands_reject_bad_documents_of_the_other_half(spark):
    """The bands were chosen on labels with an even id; these are the odd ones."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("doc_id % 2 = 1")
    found = P.quality(docs, F.col("doc_id"), F.col("lang")).join(labels, F.col("key") == F.col("doc_id")).where("NOT base_failed").toPandas()
    good, bad = found[found.quality == 1], found[found.quality == 0]
    print("kept: good", good.kept.mean(), len(good), "bad", bad.kept.mean(), len(bad))
    assert good.kept.mean() > 0.997 and bad.kept.mean() < 0.3


def test_quality_classifier_on_held_out_labels(spark):
    found = QUERIES["op3_quality_classifier"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").toPandas()
    good, bad = found[found.quality == 1].score.to_numpy(), found[found.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None]).mean() > 0.95
    assert (found.predicted == found.quality).mean() > 0.93


def test_passages():
    texts = [None, b"", b" \n ", b"a b a b", b"x " * 200, LONG.encode()]
    x, counts = encode(texts)
    assert counts.tolist() == [1, 1, 1, 1, 4, 1250] and len(x) == counts.sum() and np.isfinite(x).all()
    alone, _ = encode([b"a b a b"])
    assert np.allclose(alone[0], x[3])
    assert alone[0][-6] == 0.5 and alone[0][-5] == 0


def plain_score(model, x):
    """One document: every passage in turn."""
    w = model.weights
    hidden = [np.tanh(row @ w["A"] + w["a"]) for row in (x - model.mean) / model.scale]
    energy = [float(w["w"] @ (np.tanh(h @ w["V"]) / (1 + np.exp(-(h @ w["U"]))))) for h in hidden]
    parts = [np.exp(e - max(energy)) for e in energy]
    document = sum(p / sum(parts) * h for p, h in zip(parts, hidden))
    return 1 / (1 + np.exp(-(float(document @ w["c"]) + w["d"][0])))


def random_model(seed=3, hidden=5, gate=4):
    rng = np.random.default_rng(seed)
    shapes = {"A": (WIDTH, hidden), "a": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,), "c": (hidden,), "d": (1,)}
    return PassageModel(rng.normal(size=WIDTH) / 10, np.full(WIDTH, 0.5), {k: rng.normal(size=v) / 3 for k, v in shapes.items()})


def test_attention_equals_a_plain_version():
    model = random_model()
    texts = [None, b"", b"a b a b", LONG.encode(), " ".join(f"word{k}" for k in range(300)).encode(), "Пёс ### <x>".encode()]
    expected = [plain_score(model, encode([t])[0]) for t in texts]
    assert model.scores(texts) == pytest.approx(expected, abs=1e-6)


def test_gradient_equals_differences():
    model, rng = random_model(), np.random.default_rng(8)
    counts, labels = np.array([1, 4, 2, 7]), np.array([1.0, 0.0, 0.0, 1.0])
    x = rng.normal(size=(counts.sum(), WIDTH))

    def loss():
        p = model.forward(x, counts)[-1]
        return -(labels * np.log(p) + (1 - labels) * np.log(1 - p)).mean()

    for name, grad in model.gradient(x, counts, labels).items():
        weight = model.weights[name]
        for at in [tuple(rng.integers(n) for n in weight.shape) for _ in range(6)]:
            kept, step = weight[at], 1e-6
            weight[at] = kept + step
            above = loss()
            weight[at] = kept - step
            below = loss()
            weight[at] = kept
            assert grad[at] == pytest.approx((above - below) / (2 * step), abs=1e-6)


def test_training_reads_whole_texts(spark):
    """One passage of a hundred tells the label; evenly spaced parts would miss most of them."""
    rnd = random.Random(6)
    rows = []
    for k in range(240):
        passages = [" ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(64)) for _ in range(100)]
        if k % 2:
            passages[rnd.randrange(100)] = "### $$$ " * 32
        rows.append((k, " ".join(passages), "x"))
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(160)], "doc_id long, quality int")
    scores = {r["key"]: r["score"] for r in score_quality(docs, fit_quality(docs, labels), F.col("doc_id")).collect()}
    assert np.mean([(scores[k] > 0.5) == (k % 2 == 0) for k in range(160, 240)]) > 0.9
    twice = docs.unionAll(docs)
    assert fit_quality(twice, labels, passages=2_050).weights["c"] == pytest.approx(fit_quality(docs, labels, passages=2_050).weights["c"])


def test_score_edges(spark):
    docs = frame(spark, [(1, None, "en"), (2, "", None), (3, LONG, None), (3, LONG, None), (None, "a b", "x")])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (None, 1, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    model = fit_quality(docs, labels)
    got = [(r["key"], r["score"]) for r in score_quality(docs, model, F.col("doc_id")).collect()]
    assert len(got) == 5 and all(0 <= s <= 1 for _, s in got) and len({s for k, s in got if k == 3}) == 1
    constant = fit_quality(docs, labels.where("quality = 1"))
    assert {r["score"] for r in score_quality(docs, constant, F.col("doc_id")).collect()} == {1.0}
    assert fit_quality(docs, labels.limit(0)).constant == 0.5 and isinstance(model, PassageModel)
    assert score_quality(docs.limit(0), model, F.col("doc_id")).collect() == []


def test_language_on_held_out_rows(spark):
    found = QUERIES["op4_language_id"](spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.98 and found.score.between(0, 1).all()


def test_language_edges(spark):
    rows = [(k, t, g) for k, (t, g) in enumerate([("the cat and the dog sat", "en"), ("der Hund und die Katze", "de")] * 20)]
    docs = frame(spark, [*rows, (90, None, "en"), (91, "", None), (92, "12 34 !?", "en"), (93, LONG, None), (None, "the cat", None), (94, "日本語", None)])
    model = fit_language(docs)
    assert model.labels == ["de", "en"]
    got = {r["key"]: r for r in identify(docs, model, F.col("doc_id")).collect()}
    assert [got[k]["lang_pred"] for k in (90, 91, 92)] == ["und"] * 3 and got[92]["score"] == 0 and got[92]["rejected"]
    assert got[0]["lang_pred"] == "en" and got[1]["lang_pred"] == "de" and got[None]["lang_pred"] == "en"
    assert got[93]["lang_pred"] in model.labels and got[94]["lang_pred"] in model.labels
    none = fit_language(docs.where("false"))
    assert none.labels == [] and {r["lang_pred"] for r in identify(docs, none, F.col("doc_id")).collect()} == {"und"}
    one = train([b"abc def"] * 3, ["x"] * 3)
    assert isinstance(one, LanguageModel) and one.probabilities([b"abc"]).tolist() == [[1.0]]


def test_language_softmax_equals_a_plain_version():
    model = train(["the cat and the dog sat on the mat".encode(), "der Hund und die Katze".encode(), "le chat et le chien".encode()] * 12, ["en", "de", "fr"] * 12)
    for text in ("the cat", "Ünder  der\n12 Hund", "x", "日本 語!"):
        found, _, counts = subwords([text.encode()])
        rows = np.concatenate(found)
        mean = sum(model.embedding[b] for b in rows) / max(1, len(rows))
        logits = mean @ model.matrix + model.bias
        expected = np.exp(logits / model.temperature) / np.exp(logits / model.temperature).sum()
        assert counts[0] == len(rows) and model.probabilities([text.encode()])[0] == pytest.approx(expected, abs=1e-9)


def test_language_calibration_equals_a_plain_version():
    rng = np.random.default_rng(9)
    words = ["the", "cat", "dog", "der", "Hund", "und"]
    texts = [" ".join(rng.choice(words, 3)).encode() for _ in range(200)]
    truth = rng.integers(0, 2, 200)
    model = LanguageModel(["de", "en"], rng.normal(size=(1 << BUCKET_BITS, DIMENSION)), rng.normal(size=(DIMENSION, 2)), np.zeros(2))
    _calibrate(model, texts, truth)
    logits = np.concatenate([model.logits([t]) for t in texts])

    def chances(temperature):
        return [np.exp(row / temperature - max(row / temperature)) / np.exp(row / temperature - max(row / temperature)).sum() for row in logits]

    loss = {t: -np.mean([np.log(p[y] + 1e-12) for p, y in zip(chances(t), truth)]) for t in np.geomspace(0.1, 10, 60)}
    assert model.temperature == pytest.approx(min(loss, key=loss.get))
    ranked = sorted(((p.max(), p.argmax() == y) for p, y in zip(chances(model.temperature), truth)), key=lambda r: -r[0])
    lowest = [p for k, (p, _) in enumerate(ranked, 1) if sum(not right for _, right in ranked[:k]) <= 0.01 * k]
    assert model.threshold == pytest.approx(min(0.5, lowest[-1] if lowest else 0.5))


def reference(pieces, unknown, byte_fallback):
    tokenizer = Tokenizer(models.Unigram(pieces, unk_id=unknown, byte_fallback=byte_fallback))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement=MARK, prepend_scheme="always", split=True)
    return tokenizer


@pytest.mark.parametrize("with_bytes", [True, False])
def test_token_counts_equal_the_library(spark, with_bytes):
    pieces, unknown = read_pieces(vocabulary("piece_bpe_32k.model"))
    if not with_bytes:
        pieces = [(p if not p.startswith("<0x") else f"none{p}", s) for p, s in pieces]
    rnd = random.Random(1)
    letters = list("abcthe \n\t▁é梦 日🙂<0x41>sunk")
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += ["", " ", "  ", "   a", " a ", "▁", "▁a ▁▁b", "a▁b c", "<s> <unk>x</s>", "🙂🙂🙂 🙂a", "x" * 5000]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    library = reference(pieces, unknown, with_bytes)
    counter = PieceCounter(pieces)
    assert [counter(t) for t in texts] == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_count_ties_and_edges(spark):
    tie = [("<unk>", 0.0), (MARK, -1.0), ("a", -1.0), ("ab", -2.0), ("b", -1.0), ("abc", -3.0), ("c", -1.0), (MARK + "a", -2.0)]
    library, counter = reference(tie, 0, False), PieceCounter(tie)
    for text in ("abc", "a", "ab ab", "cab", "zzab", "zz zz", "abcabc"):
        assert counter(text) == len(library.encode(text, add_special_tokens=False).ids)
    got = {r["key"]: r["n_tokens"] for r in count_tokens(frame(spark, [(1, None, "en"), (2, "", None), (3, "ab", None), (3, "ab", None), (None, "a", "x")]), F.col("doc_id"), tie).collect()}
    assert got[1] == got[2] == 0 and got[3] == counter("ab") and got[None] == counter("a")
    assert count_tokens(frame(spark, []), F.col("doc_id"), tie).collect() == []
