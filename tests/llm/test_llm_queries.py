"""Every query of the package against its SQL twin, and the pipeline against brute force."""

import importlib

import duckdb
import pytest
import oracle
from test_dedup import brute_components, brute_removal

import corpus_pipeline
from pricewright.llm.queries import ORACLES, QUERIES
from pricewright.session import materialise

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name, monkeypatch):
    monkeypatch.setattr(oracle, "QUERIES", QUERIES)
    monkeypatch.setattr(oracle, "ORACLES", ORACLES)
    assert oracle.compare(spark, oracle.duck(FOLDER), name, FOLDER) == ""


def test_entry_point_registers_all():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {name[:name.index("_") + 1] for name in names if name.startswith("op")}
    assert "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())


def test_pipeline_stages(spark):
    """Each stage on what the one before kept, compared with a plain version of the same decision."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame([(9001, "12 34 !!", "en", "src0", 8), (9002, None, "en", "src0", 0)], docs.schema)
    docs = materialise(docs.unionByName(extra), "stage")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = materialise(stage(spark, docs, FOLDER), "stage")
        seen[name] = ([tuple(r) for r in before.select("doc_id", "text").collect()], docs)
        if name != "packing":
            assert sorted(docs.columns) == sorted(columns)
    rows, out = seen["language_id"]
    assert {r["doc_id"] for r in out.collect()} == {i for i, t in rows if any(c.isalpha() for c in t or "")}
    rows, out = seen["near_dup"]
    assert {r["doc_id"] for r in out.collect()} == {i for i, (_, c) in brute_components(rows, 5, 80).items() if i == c}
    rows, out = seen["substring_dedup"]
    want = {i: text for i, n, gone, text in brute_removal(rows, 50) if n > gone}
    assert {r["doc_id"]: " ".join(w.decode() for w in r["text"].encode().split()) for r in out.collect()} == want
    rows, out = seen["mixing"]
    source = {i: t for i, t in rows}
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert kept and all(source[i] == t for i, t in kept.items())
    sql = corpus_sql(rows, seen["substring_dedup"][1])
    assert set(kept) == sql
    _, pieces = seen["packing"]
    total = pieces.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert {r["doc_id"] for r in total} == set(kept) and all(r["sum(length)"] == r["max(doc_tokens)"] for r in total)


def corpus_sql(rows, docs):
    """The documents that the mixing twin samples."""
    from pricewright.llm import sql
    from pricewright.llm.mixing import ROUNDS, SHARE, TEMPER

    con = duckdb.connect()
    con.register("stage_docs", docs.toPandas())
    found = con.execute(sql.mixing("stage_docs", ROUNDS, TEMPER, SHARE)).df()
    return set(found[found.sampled].doc_id)


def test_stages_take_odd_rows(spark):
    """Null and repeated ids, null and empty texts, columns of any name, and no rows at all."""
    base = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    texts = [r["text"] for r in base.where("length(text) > 400 AND lang = 'en' AND doc_id IN (1, 3, 9)").collect()]
    rows = [(None, texts[0], "en", "s", 9), (None, texts[0], "en", None, 9), (7000, texts[1], "en", "s", 9), (7000, texts[2], "en", "s", 9),
            (7001, None, None, "s", 0), (7002, "", "en", "s", 0), (None, None, None, None, None)]
    docs = base.unionByName(spark.createDataFrame(rows, base.schema))
    docs = materialise(docs.selectExpr("*", "1 AS key", "'x' AS topic", "2 AS weight", "array(1) AS id", "'r' AS row", "3 AS batch"), "odd")
    steps = corpus_pipeline.STAGES
    found = docs
    for name, stage in steps[:-1]:
        before, found = found, materialise(stage(spark, found, FOLDER), "odd")
        assert found.columns == docs.columns and found.where("key <> 1 OR weight <> 2").count() == 0
        if name == "near_dup":
            assert found.where("doc_id IS NULL").count() == before.where("doc_id IS NULL").count() == 2, before.where("doc_id IS NULL").count()
            assert found.where("doc_id = 7000").count() in (0, 2)
            assert found.where("doc_id IN (7001, 7002)").count() == 0
        if name == "substring_dedup":  # the given document has all windows of its later copies without an id
            assert found.where("doc_id IS NULL").count() == 0
    pieces = steps[-1][1](spark, found, FOLDER)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in found.select("doc_id").distinct().collect()}
    for name, stage in steps:
        assert stage(spark, docs.limit(0), FOLDER).collect() == []
