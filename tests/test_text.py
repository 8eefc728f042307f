"""Extraction and cleaning against Python's own regular expressions and stated values."""

import re
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from pricewright import fixed
from pricewright.functions import text as X
from pricewright.operators.parse import parse_detailed, parse_labelled
from pricewright.session import materialise
from pricewright.sources.tables import catalog

LABELLED = [  # id, content, item_name, brand, value, pack_count, description
    (0, "Item Name: Acme Tea, Pack of 12\nBullet Point 1: great taste\nBullet Point 2: organic\nProduct Description: nice\nValue: 12.5\nUnit: Ounce",
     "Acme Tea, Pack of 12", "Acme", 12.5, 1, "great taste organic nice"),
    (1, "item name:   Foo Bar \t\nvalue: 3\nCount: 7", "Foo Bar", "Foo", None, 7, ""),
    (2, "nothing", "", "", None, 1, ""),
    (3, "Item Name:\nBullet Point 1: x\nValue: 1.2.3\nPack: 6", "Bullet Point 1: x", "Bullet", None, 6, "x"),
    (4, "Value: .\nPack  9", "", "", None, 9, ""),
    (5, "", "", "", None, 1, ""),
    (6, None, "", "", None, 1, ""),
    (7, "Item Name: " + "a" * 250, "a" * 250, "a" * 250, None, 1, ""),
    (8, "x" * 5000 + "\nItem Name: late one\nValue: 4.5\nCount: 12" + "\nBullet Point 1: p" * 7, "late one", "late", 4.5, 12, " ".join("p" * 7)),
]


def test_labelled_fields(spark):
    rows = spark.createDataFrame([(r[0], r[1]) for r in LABELLED], "sample_id bigint, catalog_content string")
    got = {r["sample_id"]: r for r in parse_labelled(rows).collect()}
    for sample, _, name, brand, value, pack, description in LABELLED:
        r = got[sample]
        assert (r["item_name"], r["brand"], r["value"], r["pack_count"], r["description"]) == (name, brand, value, pack, description)


def test_trial_cuts_are_asked_for(spark):
    rows = spark.createDataFrame([(r[0], r[1]) for r in LABELLED], "sample_id bigint, catalog_content string")
    got = {r["sample_id"]: r for r in parse_labelled(rows, **fixed.TRIAL_CUTS).collect()}
    assert got[7]["item_name"] == "a" * 200 and got[8]["item_name"] == "" and got[8]["value"] is None


def test_flat_mode_lets_a_field_run_to_the_end_of_the_text(spark):
    text = "Item Name: Acme Tea, Pack of 12\nBullet Point 1: good <b>taste</b>\nBullet Point 2: 5 KG bag\nvalue: 3\nUnit: Ounce"
    rows = spark.createDataFrame([(1, text, "http://x")], "sample_id bigint, catalog_content string, image_link string")
    flat, lines = (parse_detailed(rows, m).first() for m in ("flat", "lines"))
    assert flat["item_name"].endswith("Unit: Ounce") and lines["item_name"] == "Acme Tea, Pack of 12"
    assert lines["bullet_points_text"] == "good taste 5 KG bag"
    assert flat["bullet_points_text"].startswith("good taste Bullet Point 2:")
    for r in (flat, lines):
        assert (r["value"], r["spec_weight_value"], r["spec_weight_unit"], r["spec_pack_count"]) == (3.0, 5.0, "kg", 12)
    assert (lines["unit"], flat["image_link_valid"], flat["image_url_length"]) == ("Ounce", 1, 8)


def test_clean_text_keeps_the_spaces_around_a_tag(spark):
    rows = [("  a \t\n b ",), ("x <b> y",), ("Café — 1",), (None,), ("<a>",)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(X.clean_text(F.col("t"))).collect()]
    assert got == ["a b", "x  y", "Caf  1", "", ""]


def test_word_count_of_an_empty_text_is_zero(spark):
    rows = spark.createDataFrame([("",), (None,), (" a  b ",)], "t string")
    assert [r[0] for r in rows.select(X.word_count(F.col("t"))).collect()] == [0, 0, 2]


def test_categories_match_inside_words(spark):
    rows = spark.createDataFrame([("A GREAT Battery",), ("plain",)], "t string")
    got = [r[0] for r in rows.select(X.detect_categories(F.col("t"))).collect()]
    assert got == [["food", "electronics"], []]


@pytest.mark.parametrize("low,high,expected", [
    (1, 1, ["a", "b", "c"]), (1, 2, ["a", "b", "c", "a b", "b c"]), (2, 3, ["a b", "b c", "a b c"]), (4, 4, []),
])
def test_ngrams(spark, low, high, expected):
    words = F.array(*[F.lit(w) for w in "abc"])
    assert spark.range(1).select(X.ngrams(words, low, high)).first()[0] == expected


def test_strip_accents_is_decomposition_without_marks(spark):
    text = "ÄÖüéèñçẝ é ß ł ²"
    want = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    assert spark.createDataFrame([(text,)], "t string").select(X.strip_accents(F.col("t"))).first()[0] == want


def test_sentiment(spark):
    rows = spark.createDataFrame([("great good tea",), ("tea",), ("",), (None,)], "t string")
    got = [r[0] for r in rows.select(X.sentiment(X.tokens(F.col("t")), fixed.SENTIMENT_LEXICON)).collect()]
    assert got == [pytest.approx(0.75), 0.0, 0.0, 0.0]


def plain_labelled(text):
    """The labelled fields by Python's own expressions, written out here."""
    def number(found):
        try:
            return float(found)
        except (TypeError, ValueError):
            return None

    def first(pattern, flags=0):
        hit = re.search(pattern, text or "", flags)
        return hit.group(1) if hit else None

    name = (first(r"Item Name:\s*([^\n]*)", re.I) or "").strip()
    parts = re.findall(r"(?:Bullet Point|Description).*?:\s*([^\n]+)", text or "", re.I)
    pack = first(r"(?:Pack|Count)[:\s]*(\d+)", re.I)
    return name, (name.split() or [""])[0], number(first(r"Value:\s*([\d.]+)")), int(pack) if pack else 1, " ".join(parts)


def plain_clean(text):
    text = "".join(c for c in re.sub(r"\s+", " ", text or "") if ord(c) < 128)
    return re.sub(r"<[^>]+>", "", text).strip(" ")


def test_every_catalog_row_against_plain_python(spark):
    """No pattern is shared with the library here, so a wrong one cannot pass on both sides."""
    folder = "/root/testdata/sf0.01"
    for r in parse_labelled(catalog(spark, folder)).collect():
        assert (r["item_name"], r["brand"], r["value"], r["pack_count"], r["description"]) == plain_labelled(r["catalog_content"])
    lines = parse_detailed(catalog(spark, folder), "lines").withColumn("cleaned", X.clean_text(F.col("catalog_content")))
    for r in lines.collect():
        text = r["catalog_content"]
        bullets = re.findall(r"Bullet Point \d+:\s*([^\n]+)", text, re.I)
        assert r["bullet_points_text"] == " ".join(plain_clean(b) for b in bullets) and r["cleaned"] == plain_clean(text)
        weight = re.search(r"(\d+(?:\.\d+)?)\s*(oz|lb|g|kg)\b", text, re.I)
        assert (r["spec_weight_value"], r["spec_weight_unit"]) == ((float(weight.group(1)), weight.group(2).lower()) if weight else (None, None))
        pack = re.search(r"(?:Pack\s*of\s*|Count[:\s]*)(\d+)", text, re.I)
        assert r["spec_pack_count"] == (int(pack.group(1)) if pack else None)
        assert r["category_home"] == int(any(w in text.lower() for w in ("home", "kitchen", "decor")))


def test_strip_accents_of_every_assigned_code_point(spark):
    """Alone, and in rows of a hundred, against the library's decomposition without combining marks."""
    import unicodedata

    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) != "Cn" and not 0xE000 <= c < 0xF900 and c < 0xF0000]
    plain = lambda t: "".join(x for x in unicodedata.normalize("NFKD", t) if not unicodedata.combining(x))
    rows = ["".join(chars[a:a + 100]) for a in range(0, len(chars), 100)]
    table = spark.createDataFrame(list(enumerate(rows)), "i int, t string").repartition(8)
    got = {r["i"]: r["p"] for r in table.select("i", X.strip_accents(F.col("t")).alias("p")).collect()}
    for i, row in enumerate(rows):
        assert got[i] == "".join(map(plain, row)), (i, [c for c in row if plain(c) != c][:5])
    assert spark.range(1).select(X.strip_accents(F.lit(None).cast("string"))).first()[0] is None


def test_sentiment_with_modifiers(spark, tmp_path):
    """Sentences worked by hand: good is 0.7 / 0.6, great 0.8 / 0.75, bad -0.7 / 0.67."""
    from pricewright.functions import sentiment as S

    want = {
        "good": (0.7, 0.6), "Very good": (0.91, 0.78), "not good": (-0.35, 0.6), "not a good one": (-0.35, 0.6), "not the good one": (0.7, 0.6),
        "really very good": (1.0, 1.0), "not very good": (-0.455, 0.78), "it isn't good": (-0.35, 0.6), "good!": (0.875, 0.6), "good!!": (1.0, 0.6),
        "really is good": (0.91, 0.78), "really the good": (0.7, 0.6), "very. Good": (0.7, 0.6), "not. Good": (0.7, 0.6), "!": (0.0, 0.0),
        "good but bad": (0.0, 0.635), "very nothing": (0.0, 0.0), "slightly bad; great": ((-0.42 + 0.8) / 2, (0.402 + 0.75) / 2), "": (0.0, 0.0), "Not never good": (-0.35, 0.6),
    }
    rows = spark.createDataFrame([(t,) for t in want] + [(None,)], "t string")
    got = {r["t"]: (r["s_polarity"], r["s_subjectivity"]) for r in S.add_scores(rows, "t", "s").collect()}
    assert got.pop(None) == (0.0, 0.0)
    for text, pair in want.items():
        assert got[text] == pytest.approx(pair), text
    path = tmp_path / "lexicon.csv"
    path.write_text("word,polarity,subjectivity,intensity\nGrand,0.5,0.4,\nhugely,,,2.0\nfine,0.2,0.1,1.5\n")
    own = S.read_lexicon(spark, str(path))
    assert own.words == {"grand": (0.5, 0.4), "fine": (0.2, 0.1)} and own.adverbs == {"hugely": 2.0, "fine": 1.5}
    scored = S.add_scores(spark.createDataFrame([("hugely grand",), ("fine grand",), ("good",)], "t string"), "t", "s", own).collect()
    assert [(round(r["s_polarity"], 9), round(r["s_subjectivity"], 9)) for r in scored] == [(1.0, 0.8), (round((0.2 + 0.75) / 2, 9), round((0.1 + 0.6) / 2, 9)), (0.0, 0.0)]
    with pytest.raises(ValueError):
        S.Lexicon({f"w{i}": (0.0, 0.0) for i in range(S.MOST_WORDS)})


def test_plain_texts_are_not_compared_with_every_odd_character(spark):
    """Words of A to Z cost a small part of what a class of hundreds of ranges takes, and stay as they are."""
    plain = materialise(spark.range(4000).select(F.repeat(F.lit("a plain text without marks "), 30).alias("t")).coalesce(1), "plain")

    def seconds(column):
        took = []
        for _ in range(3):
            start = time.perf_counter()
            plain.select(column.alias("x")).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        return min(took)

    every = F.translate(F.col("t"), X._ACCENTED + X._MARKS, X._BASE)
    assert seconds(X.strip_accents(F.col("t"))) < 1.5 * seconds(every)
    rows = {"a plain text": "a plain text", "\x7f\x9f": "\x7f\x9f", "\xa0": " ", "é": "e", "ﬁ½각": "fi1⁄2" + "각".encode("utf-8").decode(), "\U0001d400": "A", "": ""}
    odd = "ﬁ½각"
    rows[odd] = "".join(c for c in unicodedata.normalize("NFKD", odd) if not unicodedata.combining(c))
    found = spark.createDataFrame([(t,) for t in [*rows, None]], "t string").select("t", X.strip_accents(F.col("t")).alias("x")).collect()
    assert {r["t"]: r["x"] for r in found} == {**rows, None: None}
