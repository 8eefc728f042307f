"""Quality rules: n-gram perplexity under a modified Kneser-Ney model, with bands per language.

The units are UTF-16 code units: letters in lower case, digits and some classes of marks alike, all else as it is.  A
4-gram is one 64-bit number, so n-grams of every script are told apart exactly and the model grows with the corpus.
Spark counts the 4-grams of the whole corpus, combined per task; continuation counts, discounts, back-off weights and
probabilities of all orders are Spark tables as well.  For scoring, a table of few n-grams goes to all tasks as an array
sorted by hash; a larger one is joined to the distinct n-grams of bounded batches of documents, which get their own sorted
arrays.  A language's bands lie around its median log perplexity, from counts of rounded values over all documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from pricewright.llm.batches import map_slices, mix, release, rolling, slices, split_words, to_arrow, utf8, window_starts, word_codes
from pricewright.session import materialise

ORDER, UNIT_BITS = 4, 16
START = 0  # stands before a text
SLICE = 1 << 20
BROADCAST_GRAMS = 1 << 21  # a score table of at most so many n-grams (25 MB) is sent to all tasks
HELD_GRAMS = 1 << 20  # distinct n-grams that a task holds before it hands its counts on
STEP = 0.005  # log perplexities are rounded to this for the bands


def _table() -> np.ndarray:
    """The unit that stands for each code unit."""
    table = np.arange(1 << 16, dtype=np.uint64)
    for point in range(1, 1 << 16):
        if 0xD800 <= point < 0xE000:
            continue
        low = chr(point).lower()
        table[point] = ord("0") if chr(point).isdigit() else ord(low) if len(low) == 1 and ord(low) < 1 << 16 else point
    table[0] = 1  # 0 is START
    for marks in (" \t\x0b\x0c\r", ".!?…", ",;:", "'’\"“”«»", "()[]{}-–—/", "#*$%&|<>", "_=+@~^`\\"):
        table[[ord(mark) for mark in marks]] = ord(marks[0])
    return table


_UNIT = _table()


def grams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram that ends at each unit, as one unsigned number, and how many units each text has."""
    units = [np.frombuffer((t or b"").decode("utf-8", "replace").encode("utf-16-le"), np.uint16) for t in texts]
    lengths = np.array([len(p) for p in units], dtype=np.int64)
    padded = np.full(int(lengths.sum()) + (ORDER - 1) * len(texts), START, np.uint64)
    begins = np.cumsum(np.r_[0, lengths[:-1] + ORDER - 1]) + ORDER - 1 if len(texts) else lengths
    place = np.arange(int(lengths.sum())) + np.repeat(begins - np.cumsum(np.r_[0, lengths[:-1]]), lengths)
    padded[place] = _UNIT[np.concatenate(units)] if units else 0
    code = np.zeros(len(place), np.uint64)
    for back in range(ORDER - 1, -1, -1):
        code = (code << np.uint64(UNIT_BITS)) | padded[place - back]
    return code, lengths


def _summed(found: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, index = np.unique(np.concatenate(found), return_inverse=True)
    return keys, np.bincount(index, np.concatenate(counts), len(keys)).astype(np.int64)


def count_grams(docs: DataFrame, text_col: str) -> DataFrame:
    """gram, n over all texts. Each task adds up its own counts first, a bounded number of distinct ones at a time."""

    def emit(keys: np.ndarray, n: np.ndarray):
        for a in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[a:a + 100_000].view(np.int64)), pa.array(n[a:a + 100_000])], names=["gram", "n"])

    def task(batches):
        held, counts = [], []
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                keys, n = np.unique(grams(part.column(0).to_pylist())[0], return_counts=True)
                held.append(keys)
                counts.append(n)
                if sum(map(len, held)) > HELD_GRAMS:
                    keys, n = _summed(held, counts)
                    held, counts = [keys], [n]
                    if len(keys) > HELD_GRAMS // 2:
                        yield from emit(keys, n)
                        held, counts = [], []
        if held:
            yield from emit(*_summed(held, counts))
        release()

    return docs.select(utf8(text_col)).mapInArrow(task, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


@dataclass
class KneserNey:
    """Tables of the model: gram and logp of each order 1 .. ORDER, context and log back-off weight of each order above 1."""

    orders: list[DataFrame]
    backoffs: list[DataFrame | None]
    unseen: float  # log probability of a unit that the corpus lacks

    def scores(self, wanted: DataFrame) -> DataFrame:
        """gram, logp for all rows of ``wanted`` (distinct grams): log probability of the last unit given those before it.

        What an order has not seen goes on to the next lower one, plus the weight of its context where that was seen.
        """
        left = wanted.select("gram", F.lit(0.0).alias("so_far"))
        found = None
        for order in range(ORDER, 0, -1):
            key = F.col("gram").bitwiseAND(_mask(order))
            table = self.orders[order - 1].withColumnsRenamed({"gram": "known", "logp": "logp_of"})
            rows = left.join(table, key == F.col("known"), "left")
            hit = rows.where("known IS NOT NULL").select("gram", (F.col("so_far") + F.col("logp_of")).alias("logp"))
            found = hit if found is None else found.unionAll(hit)
            left = rows.where("known IS NULL").select("gram", "so_far")
            if order > 1:
                weight = self.backoffs[order - 1].withColumnsRenamed({"context": "before", "weight": "w"})
                left = left.join(weight, F.shiftrightunsigned(key, UNIT_BITS) == F.col("before"), "left").select(
                    "gram", (F.col("so_far") + F.coalesce("w", F.lit(0.0))).alias("so_far"))
        return found.unionAll(left.select("gram", (F.col("so_far") + F.lit(self.unseen)).alias("logp")))


def _mask(order: int) -> Column:
    return F.lit(-1 if order == ORDER else (1 << order * UNIT_BITS) - 1).cast("long")


def _discounts(level: DataFrame) -> tuple[list[float], int, int]:
    """Three discounts from the counts of counts, the number of n-grams and their total."""
    row = level.agg(*[F.count(F.when(F.col("n") == k, 1)).alias(f"c{k}") for k in (1, 2, 3, 4)], F.count("*").alias("rows"), F.sum("n").alias("total")).first()
    c1, c2, c3, c4 = (max(1, row[f"c{k}"]) for k in (1, 2, 3, 4))
    y = c1 / (c1 + 2 * c2)
    found = (1 - 2 * y * c2 / c1, 2 - 3 * y * c3 / c2, 3 - 4 * y * c4 / c3)
    return [min(max(d, 0.0), top) for d, top in zip(found, (0.95, 1.9, 2.85))], row["rows"], row["total"] or 0


def fit_kneser_ney(docs: DataFrame, text_col: str = "text") -> KneserNey:
    """Modified Kneser-Ney: three discounts an order, from the counts of counts; lower orders by continuation counts.

    Each order is a written table. A context has at most 65,536 n-grams, and so has a suffix, so no join key is hot.
    Null and empty texts have no n-grams; on an empty corpus all tables are empty.
    """
    levels = [materialise(count_grams(docs, text_col), "grams")]
    for order in range(ORDER - 1, 0, -1):  # distinct units before a shorter n-gram
        levels.append(materialise(levels[-1].groupBy(F.col("gram").bitwiseAND(_mask(order)).alias("gram")).agg(F.count("*").alias("n")), f"grams-{order}"))
    levels.reverse()
    orders, backoffs, unseen = [], [], 0.0
    for order, level in enumerate(levels, 1):
        discounts, distinct, total = _discounts(level)
        cut = F.when(F.col("n") == 1, discounts[0]).when(F.col("n") == 2, discounts[1]).otherwise(discounts[2])
        if order == 1:
            mass = F.lit(max(1, total))
            spare = max(1e-6, (level.agg(F.sum(cut)).first()[0] or 0.0) / max(1, total))
            unseen = math.log(spare / (distinct + 1))  # all units of the corpus and one for the others
            found = level.select("gram", ((F.col("n") - cut) / mass + F.lit(spare / (distinct + 1))).alias("p"))
            backoffs.append(None)
        else:
            context = F.shiftrightunsigned("gram", UNIT_BITS)
            known = materialise(level.groupBy(context.alias("context")).agg(F.sum("n").alias("total"), F.sum(cut).alias("spare")).select(
                "context", "total", F.greatest(F.col("spare") / F.col("total"), F.lit(1e-6)).alias("spare")), f"contexts-{order}")
            lower = orders[-1].select(F.col("gram").alias("suffix"), F.exp("logp").alias("below"))
            found = (level.withColumn("of", context).join(known, F.col("of") == F.col("context"))
                     .join(lower, F.col("gram").bitwiseAND(_mask(order - 1)) == F.col("suffix"))
                     .select("gram", ((F.col("n") - cut) / F.col("total") + F.col("spare") * F.col("below")).alias("p")))
            backoffs.append(known.select("context", F.log("spare").alias("weight")))
        orders.append(materialise(found.select("gram", F.log("p").alias("logp")), f"order-{order}"))
    return KneserNey(orders, backoffs, unseen)


class SortedHashes:
    """Scores of n-grams in two arrays, sorted by a hash that is one to one."""

    def __init__(self, gram: np.ndarray, logp: np.ndarray):
        hashed = mix(gram.view(np.uint64))
        order = np.argsort(hashed)
        self.hashed, self.logp = hashed[order], logp[order].astype(np.float32)

    def __call__(self, code: np.ndarray) -> np.ndarray:
        wanted, index = np.unique(mix(code), return_inverse=True)
        at = np.searchsorted(self.hashed, wanted)
        if len(wanted) and (at[-1] == len(self.hashed) or (self.hashed[at] != wanted).any()):
            raise ValueError("the score table lacks n-grams of these texts")
        return self.logp[at][index] if len(wanted) else np.empty(0, np.float32)


def _sums(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums by text; each of its own values alone, so equal texts get equal sums."""
    out = np.zeros(len(lengths))
    some = lengths > 0
    if some.any():
        out[some] = np.add.reduceat(values.astype(np.float64), (np.cumsum(lengths) - lengths)[some])
    return out


def rules(texts: list[bytes | None]) -> dict[str, np.ndarray]:
    """Per text: words, code points in words, marks of ``[#*$%&|<>]``, repeated lines, words in repeated 3-word windows."""
    words = split_words(texts)
    codes, ends = word_codes(words)
    n_words = np.diff(ends)
    points = [sum(map(len, w)) - _continuation(w) for w in words]
    marks = [sum(map((t or b"").count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))) for t in texts]
    lines = []
    for t in texts:
        rows = [x for x in (t or b"").split(b"\n") if x and not x.isspace()]
        lines.append(len(rows) - len(set(rows)))
    starts = window_starts(ends, 3)
    found = rolling(codes, 3)[starts] if len(starts) else np.empty(0, np.uint64)
    owner = np.searchsorted(ends, starts, side="right") - 1
    order = np.lexsort((found, owner))
    same = (found[order][1:] == found[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    twice = np.zeros(len(found), bool)
    twice[order] = np.r_[False, same] | np.r_[same, False] if len(found) else False
    covered = np.zeros(int(ends[-1]) + 1, np.int32)
    for k in range(3):
        covered[starts[twice] + k] = 1
    total = np.cumsum(np.r_[0, covered[:-1]])
    return {"n_words": n_words.astype(np.int64), "word_chars": np.array(points, np.int64), "n_symbols": np.array(marks, np.int64),
            "n_dup_lines": np.array(lines, np.int64), "n_repeat_words": (total[ends[1:]] - total[ends[:-1]]).astype(np.int64)}


def _continuation(words: list[bytes]) -> int:
    """UTF-8 bytes that do not begin a code point."""
    data = np.frombuffer(b"".join(words), np.uint8)
    return int(((data & 0xC0) == 0x80).sum())


NUMBERS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_perplexity double, n_chars long"


def _numbers(texts: list[bytes | None], scores: SortedHashes) -> dict:
    code, lengths = grams(texts)
    score = -_sums(scores(code), lengths) / np.maximum(lengths, 1)
    return {**rules(texts), "log_perplexity": pa.array(score, mask=lengths == 0), "n_chars": lengths}


def measure(docs: DataFrame, scores: DataFrame, key: Column, language: Column, text_col: str = "text") -> DataFrame:
    """key, language, the rules' numbers and the log perplexity per unit (null for an empty text).

    ``scores`` (gram, logp) has every 4-gram of the texts.  Up to ``BROADCAST_GRAMS`` rows it goes to all tasks; beyond,
    to the batches of documents that ask for it.
    """
    rows = docs.select(key.alias("key"), language.alias("language"), utf8(text_col))
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, language string, {NUMBERS}"
    if scores.limit(BROADCAST_GRAMS + 1).count() > BROADCAST_GRAMS:
        return _measure_by_batches(rows, scores, text_col, schema)
    table = scores.toPandas()  # at most BROADCAST_GRAMS rows
    shared = docs.sparkSession.sparkContext.broadcast(SortedHashes(table["gram"].to_numpy(np.int64), table["logp"].to_numpy(float)))
    return map_slices(rows, text_col, schema, lambda part: {
        "key": part.column(0), "language": part.column(1), **_numbers(part.column(2).to_pylist(), shared.value)}, SLICE)


def _measure_by_batches(rows: DataFrame, scores: DataFrame, text_col: str, schema: str) -> DataFrame:
    """As ``measure``: documents are written in batches of some ``SLICE`` bytes, each asks for its distinct n-grams once."""
    names = [*rows.columns]

    def number(batches):
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, text_col, SLICE):
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(part.num_rows, place))], names=[*names, "batch"])
                place += 1

    dealt = materialise(rows.mapInArrow(number, StructType([*rows.schema.fields, StructField("batch", LongType())])), "batches")

    def ask(part: pa.RecordBatch):
        batch = part.column(1).to_numpy()
        for one in np.unique(batch):
            gram = np.unique(grams(part.filter(pa.array(batch == one)).column(0).to_pylist())[0]).view(np.int64)
            yield {"batch": np.full(len(gram), one), "gram": gram}

    asked = map_slices(dealt.select(text_col, "batch"), text_col, "batch long, gram long", ask, SLICE).distinct()
    answers = asked.join(scores, "gram").select("batch", "gram", "logp")

    def answer(texts: pa.Table, found: pa.Table) -> pa.Table:
        none = found.num_rows == 0  # null and empty texts only
        known = SortedHashes(np.empty(0, np.int64), np.empty(0)) if none else SortedHashes(found["gram"].to_numpy(), found["logp"].to_numpy())
        numbers = _numbers(texts[text_col].to_pylist(), known)
        return pa.table({"key": texts["key"], "language": texts["language"], **{k: to_arrow(v) for k, v in numbers.items()}})

    return dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(answer, schema)


def bands(measured: DataFrame, width: float, floor: float) -> DataFrame:
    """language, lower, upper: median log perplexity -/+ ``width`` times the median distance from it, at least ``floor``.

    From counts of rounded values, so that no language's rows meet in one task.
    """
    step = F.round(F.col("log_perplexity") / STEP).cast("int")
    cells = materialise(measured.where("log_perplexity IS NOT NULL").groupBy("language", step.alias("v")).agg(F.count("*").alias("n")), "bands")

    def median(rows: DataFrame, name: str) -> DataFrame:
        by = Window.partitionBy("language")
        run = rows.select("language", "v", F.sum("n").over(by.orderBy("v")).alias("upto"), F.sum("n").over(by).alias("total"))
        return run.where("2 * upto >= total").groupBy(F.col("language").alias(f"{name}_of")).agg(F.min("v").alias(name))

    same = lambda name: F.col("language").eqNullSafe(F.col(f"{name}_of"))
    middle = median(cells, "middle")
    away = cells.join(middle, same("middle")).groupBy("language", F.abs(F.col("v") - F.col("middle")).alias("v")).agg(F.sum("n").alias("n"))
    spread = median(away, "spread")
    half = F.greatest(F.lit(floor), F.col("spread") * STEP * width)
    return middle.join(spread, F.col("middle_of").eqNullSafe(F.col("spread_of"))).select(
        F.col("middle_of").alias("language"), (F.col("middle") * STEP - half).alias("lower"), (F.col("middle") * STEP + half).alias("upper"))


def quality(docs: DataFrame, key: Column, language: Column, text_col: str = "text", width: float = 4.0, floor: float = 0.04, slack: float = 1.0) -> DataFrame:
    """key, the rules' numbers, base_failed, log_perplexity, lower, upper, kept for every row.

    base_failed: fewer than 50 words, or more than half of them in repeated 3-word windows.  A document that passes is
    kept if its log perplexity lies in the band of its language, widened by ``slack`` over the root of its length, as the
    mean over a short text varies more; null languages are one of their own.  Null and empty
    texts have no words and fail; very long ones are read whole.  Repeated rows count as often as they come and get equal answers.  Other columns
    are ignored.  On an empty table the result is empty.
    """
    model = fit_kneser_ney(docs, text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = materialise(measure(docs, model.orders[ORDER - 1], key, language, text_col).withColumn("base_failed", failed), "perplexity")
    limits = bands(rows, width, floor).withColumnRenamed("language", "l")
    judged = rows.join(limits, rows["language"].eqNullSafe(F.col("l")), "left").drop("l")
    room = slack / F.sqrt(F.greatest("n_chars", F.lit(1)))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("lower") - room, F.col("upper") + room), F.lit(False))
    return judged.withColumn("kept", ~F.col("base_failed") & inside)
