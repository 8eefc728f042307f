"""Mixing sources to target weights: iterative proportional fitting, then sampling with calibrated probabilities.

Tokens are summed by cell (source, language, topic).  Cell weights start as the cells' shares and are raked in turn to
each margin's target, in rounds over the small table of cells only.  A document's probability is the budget times its
cell's weight over the cell's tokens, so the expected tokens meet the targets.  All of it is DataFrame expressions;
documents are scanned once for their tokens and once for the result, and only narrow columns are joined.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.session import materialise

ROUNDS = 16
SHARE = 0.5  # of the tokens that the query and the pipeline keep
TEMPER = 0.7  # a margin's default target is its token share to this power, normalised
MARGINS = ("source", "language", "topic")
_CUT = 4  # rounds planned at once


def count_words(text: Column) -> Column:
    """Words of ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    first_empty = F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
    last_empty = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return (F.size(parts) - first_empty - last_empty).cast("long")


def genre(text: Column, n_tokens: Column) -> Column:
    """A topic where the corpus names none: what kind of text it is, by a few marks and its length."""
    has = lambda *marks: F.coalesce(F.greatest(*[text.contains(m) for m in marks], F.lit(False)), F.lit(False))
    return (F.when(has(" | "), "table").when(has("!!"), "shout").when(has("###", "$$$", "%%%", "&&&", "***"), "markup")
            .when(n_tokens < 100, "note").when(n_tokens < 1000, "article").otherwise("long"))


def _targets(cells: DataFrame, margin: str, given: Mapping[str, float] | None, temper: float) -> DataFrame:
    """One row per value of the margin with its target share."""
    sums = cells.groupBy(F.col(margin).alias(f"{margin}_value")).agg(F.sum("tokens").alias("t"))
    if given is None:
        weight = F.pow(F.col("t").cast("double"), F.lit(temper))
    else:
        weight = F.lit(0.0)
        for value, share in given.items():
            weight = F.when(F.col(f"{margin}_value").eqNullSafe(F.lit(value)), float(share)).otherwise(weight)
    rows = sums.select(f"{margin}_value", F.when(F.col("t") > 0, weight).otherwise(0.0).alias("x"))
    total = rows.agg(F.sum("x")).first()[0] or 1.0
    return rows.select(f"{margin}_value", (F.col("x") / F.lit(total)).alias(f"{margin}_target"))


def rake(cells: DataFrame, targets: Mapping[str, Mapping[str, float] | None] | None = None, rounds: int = ROUNDS, temper: float = TEMPER) -> DataFrame:
    """``cells`` (source, language, topic, tokens, …) with ``weight``: shares that meet each margin's targets.

    ``targets`` has value -> share by margin, null values under None; values that it leaves out get nothing.  A margin
    without targets is tempered.  The last margin is met exactly, the others as far as the rounds and the empty cells let.
    """
    cells = materialise(cells, "cells")
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    rows = cells.withColumn("weight", F.col("tokens") / F.lit(float(total)))
    for margin in MARGINS:
        wanted = _targets(cells, margin, (targets or {}).get(margin), temper)
        rows = rows.join(wanted, F.col(margin).eqNullSafe(F.col(f"{margin}_value"))).drop(f"{margin}_value")
    for k in range(rounds):
        if k % _CUT == 0:
            rows = materialise(rows, "raked")
        for margin in MARGINS:
            has = F.sum("weight").over(Window.partitionBy(margin))
            rows = rows.withColumn("weight", F.when(has > 0, F.col("weight") * F.col(f"{margin}_target") / has).otherwise(0.0))
    return materialise(rows.drop(*[f"{m}_target" for m in MARGINS]), "raked")


def share_budget(cells: DataFrame, ratio: Column, share: float) -> float:
    """The budget at which ``share`` of the tokens is expected when no probability passes 1.

    Starting from none, the cells that the present budget uses up are fixed and the rest is spread over the others, which
    uses up more of them, until nothing changes; each round is one sum over the table of cells.
    """
    live = cells.where(ratio > 0)
    wanted = share * (live.agg(F.sum("tokens")).first()[0] or 0)
    budget = wanted
    while True:
        full = F.lit(float(budget)) * ratio >= 1
        used, weight = live.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not weight:
            return float(budget)
        again = (wanted - (used or 0)) / weight
        if again <= budget * (1 + 1e-9):
            return float(budget)
        budget = again


def _drawn(seed: str, key: Column) -> Column:
    """A number in [0, 1) from seed and id."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(2.0 ** 32)


def _placed(docs: DataFrame, source_col: str, language_col: str, text_col: str, topic: Column | None, *others: Column) -> DataFrame:
    """source, language, topic, n_tokens and ``others`` of every row."""
    words = count_words(F.col(text_col))
    rows = docs.select(*others, F.col(source_col).alias("source"), F.col(language_col).alias("language"), F.col(text_col).alias("_text"),
                       words.alias("n_tokens"), (F.lit(None).cast("string") if topic is None else topic).alias("topic"))
    if topic is None:
        rows = rows.withColumn("topic", genre(F.col("_text"), F.col("n_tokens")))
    return rows.drop("_text")


def _rates(rows: DataFrame, targets, budget: float | None, rounds: int, temper: float, share: float | None) -> DataFrame:
    """cell_source, cell_language, cell_topic, weight and probability of every cell of ``rows``."""
    cells = rake(rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), targets, rounds, temper)
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    if share is not None:
        budget = share_budget(cells, ratio, share)
    elif budget is None:
        steepest = cells.agg(F.max(ratio)).first()[0]
        budget = 1.0 / steepest if steepest else 0.0
    return cells.select(*[F.col(m).alias(f"cell_{m}") for m in MARGINS], F.round("weight", 12).alias("weight"),
                        F.round(F.least(F.lit(1.0), F.lit(float(budget)) * ratio), 10).alias("probability"))


def _with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    same = [F.col(m).eqNullSafe(F.col(f"cell_{m}")) for m in MARGINS]
    return rows.join(rates, same[0] & same[1] & same[2])


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float] | None] | None = None, id_col: str = "doc_id", source_col: str = "source",
        language_col: str = "lang", text_col: str = "text", topic: Column | None = None, budget: float | None = None,
        rounds: int = ROUNDS, temper: float = TEMPER, seed: str = "mix", share: float | None = None) -> DataFrame:
    """id, source, language, topic, n_tokens, weight, probability, sampled for every row of ``docs``.

    ``weight`` is the cell's share of the mixture's tokens; ``probability`` = budget * weight / tokens of the cell, at most 1.
    ``budget`` counts tokens; by default it is the largest at which no probability passes 1, so the targets hold in
    expectation, and one rare cell may make it small.  ``share`` sets it instead so that this share of all tokens that have
    a weight is expected: cells that this uses up are taken whole, and the others make up for them at one common rate.  A document is sampled if a number drawn from the MD5 of seed and id is below its probability, so the
    choice is repeatable and repeated rows share it.  Null values are values of their own; documents without words,
    and rows without an id, have probability 0 or are drawn as one id.  Other columns are ignored.  An empty table
    gives an empty result.
    """
    rows = materialise(_placed(docs, source_col, language_col, text_col, topic, F.col(id_col).alias("id")), "mix-tokens")
    rates = _rates(rows, targets, budget, rounds, temper, share)
    return _with_rates(rows, rates).select(
        F.col("id").alias(id_col), *MARGINS, "n_tokens", "weight", "probability", (_drawn(seed, F.col("id")) < F.col("probability")).alias("sampled"))


def sample(docs: DataFrame, share: float = SHARE, id_col: str = "doc_id", source_col: str = "source", language_col: str = "lang",
           text_col: str = "text", seed: str = "mix") -> DataFrame:
    """The rows of ``docs``, with all their columns, that :func:`mix` samples.

    Texts meet the table of cells where they are read: nothing is joined by id, so null and repeated ids need no care.
    """
    columns = docs.columns
    rates = _rates(_placed(docs, source_col, language_col, text_col, None), None, None, ROUNDS, TEMPER, share)
    rows = _placed(docs, source_col, language_col, text_col, None, F.struct(*[F.col(c) for c in columns]).alias("row"))
    kept = _with_rates(rows, rates).where(_drawn(seed, F.col(f"row.{id_col}")) < F.col("probability"))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in columns])
