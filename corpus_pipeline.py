"""The corpus pipeline: five stages over documents, each written and read again before the next.

All stages but the last keep the columns of their input, also those that they know nothing of; the last one gives pieces.
Rows without an id are documents of their own; rows that share an id are near-duplicates together, see each stage.  Null and
empty texts have no letter, so the first stage drops them; an empty table passes all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.llm.language import fit_language, identify
from pricewright.llm.mixing import sample
from pricewright.llm.near_dup import near_duplicates
from pricewright.llm.packing import pack, read_vocabulary
from pricewright.llm.substring import removal
from pricewright.session import materialise


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is too uncertain, go; the others get the language found.

    Every row is judged by its own text.
    """
    model = fit_language(docs)
    others = [c for c in docs.columns if c not in ("text", "lang")]
    found = identify(docs, model, F.struct(*others), with_text=True).where("NOT rejected")
    given = {"text": F.col("text"), "lang": F.col("lang_pred").alias("lang")}
    return found.select(*[given[c] if c in given else F.col("key").getField(c).alias(c) for c in docs.columns])


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8.

    Rows of one id stay or go together, judged by the greatest of their texts; rows without an id stay.
    """
    gone = near_duplicates(docs, width=5, percent=80).where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of 50 words that an earlier document has too are cut; a document of which no word is left goes.

    Rows of one id do not cut each other; rows without an id are later than all others, and do not cut each other.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    carried = {c: f"_{i}" for i, c in enumerate(others)}  # names that no column of the result has
    rest = removal(docs.select("doc_id", "text", *[F.col(c).alias(name) for c, name in carried.items()]), width=50, carry=list(carried.values()))
    left = F.col("n_words") - F.aggregate(F.zip_with("ends", "starts", lambda b, a: b - a), F.lit(0), lambda x, y: x + y)
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long").alias("n_chars")}
    return rest.where(left > 0).select(*[new[c] if c in new else F.col(carried[c]).alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn so that expected tokens meet tempered shares of sources, languages and genres: half of all tokens stay.

    Rows that share an id, or have none, share the number that is drawn, not the probability.
    """
    return sample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1,024 tokens, filled with lexical neighbours; one row per piece."""
    import public_tokenizers

    return pack(docs, read_vocabulary(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN)


STAGES = [("language_id", language_id), ("near_dup", near_dup), ("substring_dedup", substring_dedup), ("mixing", mixing), ("packing", packing)]

#: Language identification, packing and tokens have no SQL; tests/llm compares the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
