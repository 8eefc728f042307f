"""Arrow batches of text as NumPy arrays: words, word codes, shingles and windows.

Everything here handles one bounded slice of rows inside a task; Spark partitions and shuffles the work.
A word is ``[^\\x20\\x09-\\x0D]+``, which is what ``bytes.split`` without arguments gives on UTF-8.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SLICE_BYTES = 2 << 20  # text handled at once, but at least one row
ARROW_BYTES = "4m"  # of a batch on its way to Python
VOCABULARY = 150_000  # distinct words a task remembers before it starts anew

_M1, _M2, _GOLDEN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: a bijection that spreads every bit over all bits."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def utf8(name: str) -> Column:
    """The text as bytes; Arrow then hands over bytes objects without decoding them."""
    return F.col(name).cast("binary").alias(name)


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session have some 4 MB, unless the session has a bound of its own.

    Each task holds a batch twice, in the JVM beside the heap and in Python; by default a batch grows to 64 MB of long texts.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, ARROW_BYTES)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that no part holds much more than ``limit`` bytes of ``column``."""
    at = batch.schema.get_field_index(column)
    if batch.num_rows == 0:
        return
    lengths = np.array([0 if n is None else n for n in pc.binary_length(batch.column(at)).to_pylist()], dtype=np.int64)
    part = np.cumsum(lengths) // limit
    starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
        yield batch.slice(int(a), int(b - a))


def map_slices(df: DataFrame, column: str, schema: str, run: Callable[[pa.RecordBatch], dict | Iterable[dict]], limit: int = SLICE_BYTES) -> DataFrame:
    """``run`` turns each slice into columns by name. A dict is one result; an iterable of dicts gives several."""
    names = StructType.fromDDL(schema).names

    def task(batches):
        try:
            for batch in batches:
                for part in slices(batch, column, limit):
                    found = run(part)
                    for columns in [found] if isinstance(found, dict) else found:
                        yield pa.RecordBatch.from_arrays([to_arrow(columns[n]) for n in names], names=names)
        finally:
            release()

    return df.mapInArrow(task, schema)


def to_arrow(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


class Codes(dict):
    """Word -> 64-bit hash, remembered: most words of a text have been seen before."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > VOCABULARY:
            self.clear()
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


_CODES = Codes()


def release() -> None:
    """At the end of a task: forgets words and gives free memory back, which a waiting worker would keep otherwise."""
    _CODES.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def split_words(texts: Iterable[bytes | None], lower: bool = False) -> list[list[bytes]]:
    """Words of each text; with ``lower`` A-Z become a-z and nothing else changes. A null text has none."""
    if lower:
        return [t.lower().split() if t else [] for t in texts]
    return [t.split() if t else [] for t in texts]


def word_codes(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words in a row, and where each text starts and ends among them."""
    ends = np.cumsum([0, *map(len, words)])
    get = _CODES.__getitem__
    codes = np.fromiter((c for w in words for c in map(get, w)), np.uint64, int(ends[-1]))
    return codes, ends


def rolling(codes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2**64, of all windows of ``width`` consecutive codes; mixed at the end."""
    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base = np.uint64(0xD6E8FEB86659FD93)
    total, weight = np.zeros(n, np.uint64), np.uint64(1)
    if width <= 8:
        for k in range(width):
            total = total * base + codes[k:k + n]
        return mix(total)
    # prefix sums of code * base**i; a difference times base**-i is the hash of the window at i
    power = np.full(len(codes), base, np.uint64)
    power[0] = weight
    power = np.cumprod(power)
    inverse = np.full(n, np.uint64(pow(int(base), -1, 1 << 64)), np.uint64)
    inverse[0] = weight
    inverse = np.cumprod(inverse)
    prefix = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * power, out=prefix[1:])
    return mix((prefix[width:] - prefix[:n]) * inverse)


def window_starts(ends: np.ndarray, width: int) -> np.ndarray:
    """Positions, among all words, at which a whole window of one text starts."""
    lengths = np.diff(ends)
    counts = np.maximum(lengths - width + 1, 0)
    first = np.repeat(ends[:-1], counts)
    within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return first + within


def shingle_sets(words: list[list[bytes]], width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: ``width`` words each, or the whole text if it has fewer."""
    codes, ends = word_codes(words)
    every = rolling(codes, width)
    sets = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if b - a >= width:
            sets.append(np.unique(every[a:b - width + 1]))
        elif b > a:
            sets.append(np.unique(rolling(codes[a:b], b - a) ^ np.uint64(b - a)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def joined(texts: list[bytes | None], gap: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, each followed by ``gap``; where each begins, and the end of the last."""
    data = gap.join([t or b"" for t in texts]) + gap
    begins = np.cumsum([0, *(len(t or b"") + len(gap) for t in texts)])
    return np.frombuffer(data, np.uint8), begins
