"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

The model is the mean embedding of a text's subwords (byte 2- to 4-grams inside words, with word ends), multiplied
by a matrix: text -> softmax(mean(E[subwords]) @ W + b).  It is trained by stochastic gradient descent in NumPy on
a bounded sample of labelled rows; prediction runs over all rows, one pass, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm.batches import joined, map_slices, release, small_batches, utf8

BUCKET_BITS, DIMENSION = 15, 16
SAMPLE_PER_LABEL = 600  # expected labelled texts per language that training reads
SLICE = 1 << 19
_AT_ONCE = 8  # texts whose subwords the driver lists at once

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LOWER[_SPACE] = 32
_LOWER[48:58] = 48  # digits are alike
_LETTERS = np.zeros(256, bool)
_LETTERS[65:91] = _LETTERS[97:123] = _LETTERS[128:] = True


def subwords(texts: list[bytes | None]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each size: bucket of every subword and the text it is from; and the count of subwords by text.

    Only what is next to a letter counts, so marks and numbers between words do not matter.
    """
    raw, begins = joined(texts, b"  ")
    text = np.repeat(np.arange(len(texts)), np.diff(begins))
    low = _LOWER[raw]
    space, letter = _SPACE[raw], _LETTERS[raw]
    buckets, owners, counts = [], [], np.zeros(len(texts), np.int64)
    for size in (2, 3, 4):
        n = max(0, len(raw) - size + 1)
        code, inner, word = np.zeros(n, np.uint32), np.zeros(n, bool), np.zeros(n, bool)
        for k in range(size):
            code = (code << np.uint32(8)) | low[k:k + n]
            word |= letter[k:k + n]
            if 0 < k < size - 1:
                inner |= space[k:k + n]
        at = np.flatnonzero(word & ~inner)
        code = code[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * size)
        buckets.append((code >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
        owners.append(text[at])
        counts += np.bincount(owners[-1], minlength=len(texts))
    return buckets, owners, counts


@dataclass
class LanguageModel:
    labels: list[str]
    embedding: np.ndarray  # buckets x dimension
    matrix: np.ndarray  # dimension x labels
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0  # texts whose best probability is lower are rejected

    def logits(self, texts: list[bytes | None]) -> np.ndarray:
        wide = self.embedding if len(self.labels) > DIMENSION else self.embedding @ self.matrix
        buckets, owners, counts = subwords(texts)
        total = np.zeros((len(texts), wide.shape[1]))
        for b, o in zip(buckets, owners):
            if len(o):
                first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
                total[o[first]] += np.add.reduceat(wide[b], first, axis=0)
        mean = total / np.maximum(counts, 1)[:, None]
        return (mean @ self.matrix if len(self.labels) > DIMENSION else mean) + self.bias

    def probabilities(self, texts: list[bytes | None]) -> np.ndarray:
        return _softmax(self.logits(texts) / self.temperature)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def train(texts: list[bytes], labels: list[str], epochs: int = 4, rate: float = 0.5, seed: int = 7) -> LanguageModel:
    """Stochastic gradient descent over whole texts and short pieces of them; a fifth of the texts calibrates."""
    names = sorted(set(labels))
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 1 / DIMENSION, (1 << BUCKET_BITS, DIMENSION))
    model = LanguageModel(names, embedding, np.zeros((DIMENSION, len(names))), np.zeros(len(names)))
    if len(names) < 2:
        return model
    order = rng.permutation(len(texts))
    held, used = order[: len(order) // 5], order[len(order) // 5:]
    code = {n: i for i, n in enumerate(names)}
    samples = []
    for i in used.tolist():
        words = texts[i].split()
        samples.append((texts[i], code[labels[i]]))
        for size in (4, 16):
            if len(words) > size:
                at = int(rng.integers(len(words) - size))
                samples.append((b" ".join(words[at:at + size]), code[labels[i]]))
    bags = []
    for a in range(0, len(samples), _AT_ONCE):
        buckets, owners, _ = subwords([s[0] for s in samples[a:a + _AT_ONCE]])
        b, o = np.concatenate(buckets), np.concatenate(owners)
        by = np.argsort(o, kind="stable")
        cuts = np.searchsorted(o[by], np.arange(len(samples[a:a + _AT_ONCE]) + 1))
        for k in range(len(cuts) - 1):
            if cuts[k + 1] > cuts[k]:
                bags.append((*np.unique(b[by[cuts[k]:cuts[k + 1]]], return_counts=True), samples[a + k][1]))
    steps, step = epochs * len(bags), 0
    for _ in range(epochs):
        for i in rng.permutation(len(bags)).tolist():
            at, count, label = bags[i]
            share = count / count.sum()
            hidden = share @ embedding[at]
            error = _softmax((hidden @ model.matrix + model.bias)[None])[0]
            error[label] -= 1
            speed = rate * (1 - step / steps)
            back = model.matrix @ error
            model.matrix -= speed * np.outer(hidden, error)
            model.bias -= 0.1 * speed * error
            embedding[at] -= speed * len(at) ** 0.5 * np.outer(share, back)
            step += 1
    _calibrate(model, [texts[i] for i in held], np.array([code[labels[i]] for i in held], dtype=np.int64))
    return model


def _calibrate(model: LanguageModel, texts: list[bytes], truth: np.ndarray, wrong_share: float = 0.01) -> None:
    """A temperature of least log loss, then the lowest threshold with at most ``wrong_share`` errors above it, but no more than one half."""
    if not len(texts):
        return
    logits = np.concatenate([model.logits(texts[a:a + _AT_ONCE]) for a in range(0, len(texts), _AT_ONCE)])
    rows = np.arange(len(truth))
    grid = np.geomspace(0.1, 10, 60)
    model.temperature = float(min(grid, key=lambda t: -np.log(_softmax(logits / t)[rows, truth] + 1e-12).mean()))
    chance = _softmax(logits / model.temperature)
    best, right = chance.max(axis=1), chance.argmax(axis=1) == truth
    order = np.argsort(-best)
    wrong = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    fine = np.flatnonzero(wrong <= wrong_share)
    lowest = best[order][fine[-1]] if len(fine) else 0.5
    model.threshold = float(min(0.5, lowest))


def fit_language(docs: DataFrame, text_col: str = "text", label_col: str = "lang", key_col: str = "doc_id",
                 per_label: int = SAMPLE_PER_LABEL) -> LanguageModel:
    """Trains on a bounded sample: rows with a label and a letter, some ``per_label`` a label, chosen by a hash of the key.

    The number of labels is taken to be one of languages.  Without labelled rows the model has no labels.
    """
    rows = docs.where(F.col(label_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in rows.groupBy(label_col).count().collect()}
    if not counts:
        return LanguageModel([], np.zeros((1 << BUCKET_BITS, DIMENSION)), np.zeros((DIMENSION, 0)), np.zeros(0))
    place = F.pmod(F.xxhash64(F.lit("language"), F.col(key_col), F.col(text_col)), F.lit(1 << 40))
    bound = F.lit(0)
    for label, n in sorted(counts.items()):
        bound = F.when(F.col(label_col) == label, int(min(1.0, per_label / n) * (1 << 40))).otherwise(bound)
    sample = rows.where(place < bound).select(F.col(text_col).cast("binary").alias("t"), F.col(label_col).alias("l"), place.alias("p"))
    found = sample.orderBy("p").limit(2 * per_label * len(counts)).collect()
    model = train([bytes(r["t"]) for r in found], [r["l"] for r in found])
    del sample, found
    release()
    return model


def identify(docs: DataFrame, model: LanguageModel, key: Column, text_col: str = "text", with_text: bool = False) -> DataFrame:
    """key, lang_pred, score, rejected, and the text if asked for, for every row of ``docs``; ``key`` is any column or struct to carry along.

    ``und`` with score 0 where the text is null or has no letter; otherwise the likeliest label and its calibrated
    probability, rejected if that is below the model's threshold.  A model without labels answers ``und`` always.
    Ties go to the label that sorts first.  Repeated rows get equal answers.  Other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # of a fixed size: buckets x dimension
    rows = docs.select(key.alias("key"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("known"), utf8(text_col))

    def run(part: pa.RecordBatch) -> dict:
        model, texts = shared.value, part.column(2).to_pylist()
        known = np.array(part.column(1).to_pylist(), bool)
        if not model.labels:
            known[:] = False
            chance = np.zeros((len(texts), 1))
        else:
            chance = model.probabilities([t if k else b"" for t, k in zip(texts, known)])
        best, score = chance.argmax(axis=1), np.where(known, chance.max(axis=1), 0.0)
        return {
            "key": part.column(0), "lang_pred": pa.array([model.labels[b] if k else "und" for b, k in zip(best, known)], pa.string()),
            "score": score, "rejected": ~known | (score < model.threshold), "text": part.column(2).cast(pa.string())}

    kind = rows.schema["key"].dataType.simpleString()
    return map_slices(rows, text_col, f"key {kind}, lang_pred string, score double, rejected boolean" + ", text string" * with_text, run, SLICE)
