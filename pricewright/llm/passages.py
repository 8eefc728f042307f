"""Quality classifier: attention-based multiple-instance learning over the passages of a document.

A passage is 64 consecutive words.  It is encoded from what it looks like: frequencies of pairs of byte classes,
repetition and lengths, then a learned layer.  Gated attention weighs the passages (softmax over
w . (tanh(V h) * sigmoid(U h))), and the weighted sum of passages is scored.  All of it is learned from document
labels, in NumPy, on a bounded sample whose passages Spark encodes; every document is scored in one pass.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm.batches import joined, map_slices, mix, utf8
from pricewright.session import materialise

PASSAGE_WORDS = 64
SAMPLE = 6000  # labelled documents that training reads at most
PASSAGES = 150_000  # passages of all of them together at most (90 MB); a document is taken whole or not at all
CLASSES = 12
EXTRA = 6
WIDTH = CLASSES * CLASSES + EXTRA
SLICE = 1 << 20


def _classes() -> np.ndarray:
    table = np.full(256, 9, np.uint8)  # other marks
    table[97:123], table[65:91], table[48:58] = 0, 1, 2
    table[128:192], table[192:] = 3, 4  # inside and at the start of a code point beyond ASCII
    table[[9, 11, 12, 13, 32]], table[10] = 5, 6
    table[[ord(x) for x in ".,;:'\"-()"]] = 7
    table[[ord(x) for x in "!?"]] = 8
    table[[ord(x) for x in "#*$%&"]] = 10
    table[[ord(x) for x in "|<>"]] = 11
    return table


_CLASS = _classes()


def encode(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages, and how many each text has. A text without words has one passage of zeros."""
    raw, begins = joined(texts)
    kind = _CLASS[raw]
    space = (kind == 5) | (kind == 6)
    start = ~space & np.r_[True, space[:-1]]
    at = np.flatnonzero(start)
    doc = np.searchsorted(begins, at, side="right") - 1
    n_words = np.bincount(doc, minlength=len(texts))
    counts = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first = np.cumsum(np.r_[0, counts])
    within = np.arange(len(at)) - np.repeat(np.cumsum(np.r_[0, n_words[:-1]]), n_words)
    passage = first[doc] + within // PASSAGE_WORDS  # of each word
    total = int(first[-1])
    # bytes belong to the passage of the word before them, at the beginning of a text to its first one
    owner = np.zeros(len(raw), np.int64)
    owner[begins[:-1]] = first[:-1]
    owner[at] = passage
    owner = np.maximum.accumulate(owner)
    cell = owner[:-1] * (CLASSES * CLASSES) + kind[:-1].astype(np.int64) * CLASSES + kind[1:]
    cell = np.delete(cell, begins[1:-1] - 1)  # a text's last byte and the first of the next
    pairs = np.bincount(cell, minlength=total * CLASSES * CLASSES).reshape(total, -1).astype(np.float64)
    size = np.maximum(pairs.sum(axis=1), 1)
    out = np.zeros((total, WIDTH), np.float32)
    out[:, :-EXTRA] = np.sqrt(pairs / size[:, None])
    words = np.bincount(passage, minlength=total)
    if len(at):
        base = np.uint64(0x9FB21C651E98DF25)
        power = np.full(len(raw) + 1, base)
        power[0] = 1
        power = np.cumprod(power)
        prefix = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:-1])]
        stop = np.flatnonzero(space & ~np.r_[True, space[:-1]])
        inverse = np.full(len(raw) + 1, np.uint64(pow(int(base), -1, 1 << 64)))
        inverse[0] = 1
        inverse = np.cumprod(inverse)
        code = mix((prefix[stop] - prefix[at]) * inverse[at])
        again = np.r_[False, (code[1:] == code[:-1]) & (passage[1:] == passage[:-1])]
        order = np.lexsort((code, passage))
        new = np.r_[True, (code[order][1:] != code[order][:-1]) | (passage[order][1:] != passage[order][:-1])]
        distinct = np.bincount(passage[order][new], minlength=total)
        whole = np.maximum(words, 1)
        out[:, -6] = distinct / whole
        out[:, -5] = np.bincount(passage, again, total) / whole
        out[:, -4] = np.bincount(passage, stop - at, total) / whole / 10
        out[:, -3] = np.log1p(words) / 4
    out[:, -2] = np.repeat(np.log1p(n_words), counts) / 8
    out[:, -1] = np.repeat(n_words < PASSAGE_WORDS, counts)
    return out, counts


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class PassageModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray] = field(default_factory=dict)
    constant: float | None = None  # the score when labels were of one kind or none

    def forward(self, x: np.ndarray, counts: np.ndarray):
        w = self.weights
        starts = np.cumsum(np.r_[0, counts[:-1]])
        h = np.tanh(x @ w["A"] + w["a"])
        t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        e = (t * g) @ w["w"]
        top = np.repeat(np.maximum.reduceat(e, starts), counts)
        e = np.exp(e - top)
        share = e / np.repeat(np.add.reduceat(e, starts), counts)
        z = np.add.reduceat(share[:, None] * h, starts, axis=0)
        return h, t, g, share, z, _sigmoid(z @ w["c"] + w["d"])

    def gradient(self, x: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss over documents, by weight."""
        w, (h, t, g, share, z, p) = self.weights, self.forward(x, counts)
        back = (p - labels) / len(labels)
        grad = {"c": z.T @ back, "d": np.array([back.sum()])}
        dz = np.repeat(back[:, None] * w["c"], counts, axis=0)
        dshare = (dz * h).sum(axis=1)
        starts = np.cumsum(np.r_[0, counts[:-1]])
        de = share * (dshare - np.repeat(np.add.reduceat(share * dshare, starts), counts))
        grad["w"] = (t * g).T @ de
        dt, dg = de[:, None] * w["w"] * g * (1 - t * t), de[:, None] * w["w"] * t * g * (1 - g)
        grad["V"], grad["U"] = h.T @ dt, h.T @ dg
        dh = share[:, None] * dz + dt @ w["V"].T + dg @ w["U"].T
        da = dh * (1 - h * h)
        grad["A"], grad["a"] = x.T @ da, da.sum(axis=0)
        return grad

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        if not texts:
            return np.empty(0)
        x, counts = encode(texts)
        return self.forward((x - self.mean) / self.scale, counts)[-1]


def train(bags: list[np.ndarray], labels: np.ndarray, hidden: int = 12, gate: int = 8, steps: int = 1500, rate: float = 0.004,
          decay: float = 1.2, seed: int = 5) -> PassageModel:
    """Log loss on document labels plus ``decay`` over their number times the squared weights; Adam, 64 documents a step.

    Some ``steps`` steps are made, but 15 to 60 passes over the documents.
    """
    if len(bags) == 0 or labels.min() == labels.max():
        return PassageModel(np.zeros(WIDTH), np.ones(WIDTH), constant=float(labels.mean()) if len(bags) else 0.5)
    rng = np.random.default_rng(seed)
    total = sum(map(len, bags))
    mean = sum(b.sum(axis=0, dtype=np.float64) for b in bags) / total
    spread = sum(((b - mean) ** 2).sum(axis=0) for b in bags) / total
    model = PassageModel(mean, np.sqrt(spread) + 0.02)
    near = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape)
    model.weights = w = {"A": near(WIDTH, hidden), "a": np.zeros(hidden), "V": near(hidden, gate), "U": near(hidden, gate),
                         "w": near(gate), "c": near(hidden), "d": np.zeros(1)}
    first, second = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    a_pass = -(-len(bags) // 64)
    epochs = min(60, max(15, steps // a_pass))
    step, steps, decay = 0, epochs * a_pass, decay / len(bags)
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for a in range(0, len(order), 64):
            pick = order[a:a + 64]
            counts = np.array([len(bags[i]) for i in pick])
            x = (np.concatenate([bags[i] for i in pick]) - model.mean) / model.scale
            grad = model.gradient(x, counts, labels[pick])
            step += 1
            speed = rate * (1 - step / (steps + 1))
            for k in w:
                d = grad[k] + decay * w[k]
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                w[k] = w[k] - speed * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, key_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                sample: int = SAMPLE, passages: int = PASSAGES) -> PassageModel:
    """Trains on whole texts of ``sample`` labelled documents at most, chosen by a hash of the key; rows without a label or key are not used.

    Only the chosen keys, at most ``sample``, are sent to the documents; all passages are encoded and written there.
    The driver reads documents in the order of the hash while they have room in ``passages`` together, so it
    holds a bounded array; a document that does not fit is left out, not cut.  Repeated rows count once.
    """
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(key_col).isNotNull()).select(
        F.col(key_col).alias("k"), F.col(label_col).cast("double").alias("y"), F.xxhash64(F.lit("quality"), key_col).alias("place"))
    chosen = chosen.orderBy("place", "k", "y").limit(sample).groupBy("place", "k").agg(F.min("y").alias("y"))  # of two labels the lower
    rows = docs.join(F.broadcast(chosen), F.col(key_col) == F.col("k")).select("k", "y", "place", utf8(text_col))

    def run(part: pa.RecordBatch) -> dict:
        x, counts = encode(part.column(3).to_pylist())
        ends = np.cumsum(np.r_[0, counts])
        found = [x[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
        return {"k": part.column(0), "y": part.column(1), "place": part.column(2), "n": counts, "x": pa.array(found, pa.binary())}

    kind = rows.schema["k"].dataType.simpleString()
    encoded = materialise(map_slices(rows, text_col, f"k {kind}, y double, place long, n long, x binary", run, SLICE).withColumn("tag", F.xxhash64("x")), "passages")
    picked, room = [], passages
    for r in encoded.select("place", "k", "tag", "n").distinct().orderBy("place", "k", "tag").limit(sample).collect():
        if r["n"] <= room:
            picked.append((r["k"], r["tag"]))
            room -= r["n"]
    if not picked:
        return train([], np.empty(0))
    wanted = docs.sparkSession.createDataFrame(picked, f"k {kind}, tag long")
    found = encoded.join(F.broadcast(wanted), ["k", "tag"]).groupBy("place", "k", "tag").agg(F.first("y").alias("y"), F.first("x").alias("x")).collect()
    found.sort(key=lambda r: (r["place"], r["k"], r["tag"]))
    return train([np.frombuffer(r["x"], np.float32).reshape(-1, WIDTH) for r in found], np.array([r["y"] for r in found]))


def score_quality(docs: DataFrame, model: PassageModel, key: Column, text_col: str = "text") -> DataFrame:
    """key, score (0 to 1; higher: label 1 is likelier) for every row of ``docs``, from its whole text.

    Null, empty and blank texts are one passage of zeros and get a score too; of a very long text every passage takes
    part.  Equal texts get equal scores.  Other columns are ignored.  Without labels of both kinds the score is
    constant.  An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 4,000 numbers
    rows = docs.select(key.alias("key"), utf8(text_col))
    kind = rows.schema["key"].dataType.simpleString()
    return map_slices(rows, text_col, f"key {kind}, score double", lambda part: {
        "key": part.column(0), "score": shared.value.scores(part.column(1).to_pylist())}, SLICE)
