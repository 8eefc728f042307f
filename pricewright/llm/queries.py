"""One query per operator, over the whole of its table, with its SQL twin where SQL can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.llm import sql as S
from pricewright.llm.language import fit_language, identify
from pricewright.llm.lexical import search
from pricewright.llm.manifest import folded, leaf_digest, proofs, siblings
from pricewright.llm.mixing import ROUNDS, SHARE, TEMPER, mix
from pricewright.llm.near_dup import near_duplicates
from pricewright.llm.neighbours import nearest_neighbours
from pricewright.llm.packing import pack, read_vocabulary
from pricewright.llm.passages import fit_quality, score_quality
from pricewright.llm.perplexity import quality
from pricewright.llm.pieces import encode, read_model
from pricewright.llm.registry import ORACLES, QUERIES, query
from pricewright.llm.substring import removal
from pricewright.llm.token_counts import count_tokens, read_pieces
from pricewright.llm.warc import round_trip

__all__ = ["ORACLES", "QUERIES"]


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_near_dup", S.near_dup("documents", 4))
def op1_near_dup(spark, sf):
    """Near-duplicate classes of all documents: four-word shingles, similarity 0.8."""
    return near_duplicates(table(spark, sf, "documents"), width=4, percent=80)


@query("op5_substring_dedup", S.substring("documents", 50))
def op5_substring_dedup(spark, sf):
    """Windows of 50 words that an earlier document has too are cut from all documents."""
    rest = removal(table(spark, sf, "documents"), width=50, separator=" ")
    n_removed = F.aggregate(F.zip_with("ends", "starts", lambda b, a: (b - a).cast("long")), F.lit(0).cast("long"), lambda x, y: x + y)
    return rest.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def held_out(modulus: int, rest: int):
    """Whether crc32 of the id as text leaves this remainder."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest


@query("op4_language_id")
def op4_language_id(spark, sf):
    """Language of every document; learned from documents outside the held-out quarter only."""
    docs = table(spark, sf, "documents")
    model = fit_language(docs.where(~held_out(4, 2)))
    found = identify(docs, model, F.col("doc_id"))
    return found.withColumnRenamed("key", "doc_id").select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "rejected")


@query("op2_quality_rules")
def op2_quality_rules(spark, sf):
    """Counts of every document and the verdict of rules and perplexity bands."""
    return quality(table(spark, sf, "documents"), F.col("doc_id"), F.col("lang")).withColumnRenamed("key", "doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity", "lower", "upper")


@query("op3_quality_classifier")
def op3_quality_classifier(spark, sf):
    """Quality score of every document; learned from labels outside the held-out fifth only."""
    docs = table(spark, sf, "documents")
    model = fit_quality(docs, table(spark, sf, "labels").where(~held_out(5, 0)))
    found = score_quality(docs, model, F.col("doc_id")).withColumnRenamed("key", "doc_id")
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's vocabulary file on this machine; its content, not its path, goes to the tasks."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op10_token_counts")
def op10_token_counts(spark, sf):
    """Unigram token counts of every document with the pieces and scores of a public vocabulary."""
    pieces, _ = read_pieces(vocabulary("piece_bpe_32k.model"))
    return count_tokens(table(spark, sf, "documents"), F.col("doc_id"), pieces).withColumnRenamed("key", "doc_id")


@query("op6_nearest_neighbours")
def op6_nearest_neighbours(spark, sf):
    """The 10 nearest of every hundredth vector among all vectors, from balanced posting lists."""
    return nearest_neighbours(table(spark, sf, "embeddings"), F.col("id") % 100 == 0)


@query("op7_retrieval_packing")
def op7_retrieval_packing(spark, sf):
    """All documents in sequences of 1,024 tokens, each filled with lexical neighbours."""
    import public_tokenizers

    return pack(table(spark, sf, "documents"), read_vocabulary(vocabulary("byte_bpe_50k.json")), public_tokenizers.PATTERN)


@query("op8_warc", S.warc("pages"))
def op8_warc(spark, sf):
    """All pages written as WARC archives and read back, in the order of the merged capture index: equal payloads are stored once."""
    found = round_trip(table(spark, sf, "pages"))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "position", "url_key", "date")


@query("op9_mixing", S.mixing("documents", ROUNDS, TEMPER, SHARE))
def op9_mixing(spark, sf):
    """Sampling probability of every document: token weights raked to tempered sources, languages and genres."""
    return mix(table(spark, sf, "documents"), share=SHARE)


@query("op13_merkle_manifest", S.manifest("documents"))
def op13_merkle_manifest(spark, sf):
    """Merkle proofs of all documents by source; every fifth, by crc32 of its id, is shown with its text in lower case."""
    docs = table(spark, sf, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = proofs(docs, leaf_digest(*fields, F.col("text")), shown=leaf_digest(*fields, F.when(held_out(5, 0), lowered).otherwise(F.col("text"))))
    checked = found.withColumn("folded_root", folded(F.col("path"), F.col("shown")))
    return checked.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(siblings(F.col("path")).cast("binary"), 256).alias("proof_sha256"), "folded_root",
                          (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op12_lexical_search", S.lexical("documents", "benchmark"))
def op12_lexical_search(spark, sf):
    """The 10 best of all documents for every benchmark item."""
    return search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op11_sentencepiece")
def op11_sentencepiece(spark, sf):
    """Pieces of every document with a public vocabulary, and the text that they decode to."""
    found = encode(table(spark, sf, "documents"), F.col("doc_id"), read_model(vocabulary("piece_bpe_32k.model")))
    numbers = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return found.select(F.col("key").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), F.sha2(numbers.cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), F.array_max("ends").cast("long").alias("spanned_bytes"))
