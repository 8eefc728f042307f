"""Scalar features and the shaping of feature frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewright import fixed
from pricewright.functions import numeric as N
from pricewright.functions import sentiment as S
from pricewright.functions import text as X
from pricewright.operators.quantiles import column_medians

SPEC_COLUMNS = ["value", "spec_weight_value", "spec_pack_count"]
DETAILED_TEXTS = ["item_name", "bullet_points_text", "product_description"]
LABELLED_TEXTS = ["item_name", "description"]


def length_features(df: DataFrame, columns: list[str], suffixes: tuple[str, str]) -> DataFrame:
    """Character length and word count of each text column that is present."""
    chars, words = suffixes
    present = [c for c in columns if c in df.columns]
    return df.withColumns({
        **{f"{c}_{chars}": X.text_length(F.col(c)) for c in present},
        **{f"{c}_{words}": X.word_count(F.col(c)) for c in present},
    })


def labelled_value_features(df: DataFrame, medians: dict[str, float] | None = None) -> DataFrame:
    """Median-filled value, filled pack count, their logs and interactions.

    ``medians`` default to those of ``df`` itself; a column without any value is filled with 0.
    """
    medians = column_medians(df, ["value"]) if medians is None else medians
    filled = F.coalesce(F.col("value"), F.lit(float(medians.get("value", 0.0))))
    pack = F.coalesce(F.col("pack_count"), F.lit(1).cast("bigint"))
    return (
        df.withColumns({
            "value_filled": filled,
            "value_missing": N.is_missing(F.col("value")),
            "pack_count_filled": pack,
        })
        .withColumns({
            "value_log": F.log1p("value_filled"),
            "pack_log": F.log1p("pack_count_filled"),
            "value_x_pack": N.value_x_pack(F.col("value_filled"), F.col("pack_count_filled")),
            "value_per_pack": N.value_per_pack(F.col("value_filled"), F.col("pack_count_filled")),
        })
    )


def detailed_value_features(df: DataFrame, medians: dict[str, float] | None = None) -> DataFrame:
    """Missing flag, median fill and log of value, weight and pack; all NULL stays NULL."""
    present = [c for c in SPEC_COLUMNS if c in df.columns]
    medians = column_medians(df, present) if medians is None else medians
    out = df.withColumns({f"{c}_is_missing": N.is_missing(F.col(c)) for c in present})
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)).cast("double")) for c in present})
    return out.withColumns({f"{c}_log": N.log1p_floor0(F.col(c)) for c in present})


def labelled_sentiment(df: DataFrame, lexicon: dict = fixed.SENTIMENT_LEXICON, max_chars: int | None = None, modifiers: bool = False) -> DataFrame:
    """``sentiment`` of the item name: the mean over words, or with adverbs and negations if ``modifiers``."""
    name = X.first_chars(X.or_empty(F.col("item_name")), max_chars)
    if modifiers:
        return df.withColumn("sentiment", S.scores(name, S.Lexicon(lexicon))["polarity"])
    return df.withColumn("sentiment", X.sentiment(X.tokens(name), lexicon))


def detailed_sentiment(df: DataFrame, lexicon: dict = fixed.SENTIMENT_LEXICON, columns: list[str] = DETAILED_TEXTS, modifiers: bool = False) -> DataFrame:
    """Polarity and subjectivity of each text column that there is."""
    if modifiers:
        for c in columns:
            df = S.add_scores(df, c, f"{c}_sentiment", S.Lexicon(lexicon)) if c in df.columns else df
        return df
    return df.withColumns({
        f"{c}_sentiment_{which}": X.sentiment(X.tokens(F.col(c)), lexicon, which)
        for c in columns if c in df.columns
        for which in ("polarity", "subjectivity")
    })


def add_combined_text(df: DataFrame, detailed: bool, column: str = "combined_text", max_chars: int | None = None) -> DataFrame:
    """The text the vectoriser reads, whole unless cut; fields that are absent count as missing."""
    present = [F.col(c) for c in (DETAILED_TEXTS if detailed else LABELLED_TEXTS) if c in df.columns]
    if detailed:
        text = X.combine_detailed(*present) if present else F.lit("")
    else:
        text = X.combine_labelled(*present)
    return df.withColumn(column, X.first_chars(text, max_chars))


# ---- shape of a feature frame ----

def is_numeric(field: T.StructField, booleans: bool) -> bool:
    return isinstance(field.dataType, T.NumericType) or (booleans and isinstance(field.dataType, T.BooleanType))


def feature_columns(df: DataFrame, exclude: list[str], numeric_only: bool = False, also_in: DataFrame | None = None) -> list[str]:
    """Columns left after the exclusion list, optionally numeric ones present in a second frame too."""
    return [
        f.name for f in df.schema.fields
        if f.name not in exclude
        and (not numeric_only or is_numeric(f, booleans=True))
        and (also_in is None or f.name in also_in.columns)
    ]


def _as_number(field: T.StructField):
    c = F.col(field.name)
    if isinstance(field.dataType, T.BooleanType):
        return c.cast("int")
    if isinstance(field.dataType, (T.StringType, T.NumericType)):
        return c
    return F.lit(0.0)  # dates, arrays and the like do not parse as a number


def sanitize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Every feature column as a finite double; other columns stay as they are."""
    fields = {f.name: f for f in df.schema.fields}
    return df.withColumns({c: N.finite_or_zero(_as_number(fields[c])) for c in columns})


def sanitize_numeric_only(df: DataFrame, columns: list[str]) -> DataFrame:
    """As :func:`sanitize`, but a non-numeric feature column is dropped."""
    kept = [f.name for f in df.schema.fields if f.name in columns and is_numeric(f, booleans=False)]
    return sanitize(df.drop(*[c for c in columns if c not in kept]), kept)


def align_zero_fill(df: DataFrame, fitted: list[str], keep: list[str] = ()) -> DataFrame:
    """The fitted columns in fitted order: missing ones as 0, others dropped."""
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in fitted])


def align_intersection(df: DataFrame, fitted: list[str], keep: list[str] = ()) -> DataFrame:
    return df.select(*keep, *[c for c in fitted if c in df.columns])


def check_same_features(train: list[str], test: list[str]) -> None:
    if len(train) != len(test):
        raise ValueError(f"feature count differs: {len(train)} in training, {len(test)} here")
    if list(train) != list(test):
        raise ValueError("feature names or their order differ from training")
