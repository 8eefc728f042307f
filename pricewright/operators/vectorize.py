"""TF-IDF: a vocabulary from one shuffle, then row-local vectors."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass

from pyspark.ml.feature import CountVectorizerModel, NGram, StopWordsRemover
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.functions import text as X

MAX_VOCABULARY = 1 << 16  # the vocabulary goes through the driver and into every task


@dataclass(frozen=True)
class TextSettings:
    max_features: int
    min_df: int
    max_df: float
    ngram_range: tuple[int, int] = (1, 2)
    sublinear_tf: bool = True
    stop_words: tuple[str, ...] = ()
    strip_accents: bool = False


# fixed values: vectoriser settings of the two feature sets
LABELLED_TEXT = TextSettings(max_features=1000, min_df=8, max_df=0.85)


def detailed_text(stop_words: list[str]) -> TextSettings:
    return TextSettings(max_features=1500, min_df=10, max_df=0.7, stop_words=tuple(stop_words), strip_accents=True)


def add_tokens(df: DataFrame, text: str, settings: TextSettings, column: str = "tokens") -> DataFrame:
    if not settings.stop_words:
        return df.withColumn(column, X.tokens(F.col(text), accents=not settings.strip_accents))
    raw = df.withColumn("_raw", X.tokens(F.col(text), accents=not settings.strip_accents))
    remover = StopWordsRemover(inputCol="_raw", outputCol=column, stopWords=list(settings.stop_words))
    return remover.transform(raw).drop("_raw")


def add_grams(df: DataFrame, text: str, settings: TextSettings, column: str = "grams") -> DataFrame:
    """All n-grams of the text, shorter ones first."""
    out, parts = add_tokens(df, text, settings, "_tokens"), []
    for n in range(settings.ngram_range[0], settings.ngram_range[1] + 1):
        if n > 1:
            out = NGram(n=n, inputCol="_tokens", outputCol=f"_grams_{n}").transform(out)
        parts.append("_tokens" if n == 1 else f"_grams_{n}")
    return out.withColumn(column, F.concat(*parts)).drop("_tokens", *[p for p in parts if p != "_tokens"])


def term_statistics(df: DataFrame, text: str, settings: TextSettings) -> DataFrame:
    """Corpus count and document frequency of every n-gram.

    Both counts come from one explode and one shuffle on the term, combined on the map side; documents
    are never regrouped, because a document's distinct terms are found in its row.
    """
    grams = add_grams(df.select(text), text, settings).select("grams")
    both = F.concat("grams", F.array_distinct("grams"))  # every use, then every term of the document once
    # The outer form: the inner one adds a filter that computes the grams a second and third time.
    rows = grams.select(F.size("grams").alias("n"), F.posexplode_outer(both).alias("at", "term")).where(F.col("term").isNotNull())
    use = (F.col("at") < F.col("n")).cast("bigint")
    return rows.groupBy("term").agg(F.sum(use).alias("uses"), F.sum(1 - use).alias("docs"))


def vocabulary(df: DataFrame, text: str, settings: TextSettings, n_docs: int) -> DataFrame:
    """The most used terms within the document-frequency bounds; ties go to the smaller term."""
    bounded = term_statistics(df, text, settings).where(
        (F.col("docs") >= settings.min_df) & (F.col("docs") <= settings.max_df * n_docs)
    )
    return bounded.orderBy(F.desc("uses"), "term").limit(settings.max_features)


@dataclass
class TfidfModel:
    """Terms in code-point order with their smoothed idf; small enough for every task by construction."""

    settings: TextSettings
    terms: list[str]
    idf: list[float]
    n_docs: int

    def counts(self, df: DataFrame, text: str, column: str) -> DataFrame:
        """Array of (idx, tf) of the vocabulary terms of each row, ascending by idx, without a shuffle."""
        grams = add_grams(df, text, self.settings, "_grams")
        model = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_grams", outputCol="_counts", minTF=1.0)
        counted = model.transform(grams).withColumn("_counts", F.unwrap_udt("_counts"))  # sparse: what the text holds
        pairs = F.zip_with("_counts.indices", "_counts.values", lambda i, tf: F.struct(i.alias("idx"), tf.alias("tf")))
        return counted.withColumn(column, pairs).drop("_grams", "_counts")

    def transform(self, df: DataFrame, text: str, column: str = "tfidf") -> DataFrame:
        """Array of (idx, weight), L2-normalised; empty for a row without a known term."""
        idf = F.split(F.lit(",".join(map(repr, self.idf))), ",").cast("array<double>")  # folded to a literal

        def weight(p: Column) -> Column:
            tf = 1 + F.log(p["tf"]) if self.settings.sublinear_tf else p["tf"]
            return F.struct(p["idx"].alias("idx"), (tf * F.get(idf, p["idx"])).alias("weight"))

        def unit_length(raw: Column) -> Column:
            norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda acc, p: acc + p["weight"] * p["weight"]))
            return X.let(F.struct(raw.alias("raw"), norm.alias("norm")), lambda s: F.transform(
                s["raw"], lambda p: F.struct(p["idx"].alias("idx"), (p["weight"] / s["norm"]).alias("weight"))
            ))

        counted = self.counts(df, text, "_tf")
        return counted.withColumn(column, X.let(F.transform("_tf", weight), unit_length)).drop("_tf")

    def long_form(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """(key, term, weight) rows."""
        terms = F.split(F.lit("\n".join(self.terms)), "\n")
        entries = self.transform(df.select(key, text), text).select(key, F.inline_outer("tfidf"))
        return entries.where(F.col("idx").isNotNull()).select(key, F.get(terms, F.col("idx")).alias("term"), "weight")

    def state(self) -> dict:
        return {"settings": asdict(self.settings), "terms": self.terms, "idf": self.idf, "n_docs": self.n_docs}

    @staticmethod
    def of(state: dict) -> "TfidfModel":
        lists = {k: tuple(v) if isinstance(v, list) else v for k, v in state["settings"].items()}
        return TfidfModel(TextSettings(**lists), state["terms"], state["idf"], state["n_docs"])

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t, w) for i, (t, w) in enumerate(zip(self.terms, self.idf))]
        return spark.createDataFrame(rows, "idx int, term string, idf double")


def fit_tfidf(df: DataFrame, text: str, settings: TextSettings) -> TfidfModel:
    if settings.max_features > MAX_VOCABULARY:
        raise ValueError(f"max_features is at most {MAX_VOCABULARY}")
    n_docs = df.count()
    kept = {r["term"]: r["docs"] for r in vocabulary(df, text, settings, n_docs).collect()}  # <= max_features rows
    if not kept:
        raise ValueError("no term meets min_df and max_df")
    terms = sorted(kept)
    idf = [math.log((1 + n_docs) / (1 + kept[t])) + 1 for t in terms]
    return TfidfModel(settings, terms, idf, n_docs)
