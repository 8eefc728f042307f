"""Token counts: a Viterbi that carries counts only.

The automaton of the vocabulary lists, at every position, the pieces that end there; dynamic programming keeps the best
score and the number of pieces on its path, never the path.  Results equal a unigram tokenizer with the same scores:
sums run from the left in double precision; among equal scores the piece that starts first wins; a character that no
piece covers alone is unknown, at the lowest score less 10, and counts as its bytes where the vocabulary has byte
pieces, else runs of unknown characters count once.  Text is cut before each word mark, which replaces the space,
with one mark before the text, so that a word's count does not depend on its neighbours and can be remembered.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm.batches import VOCABULARY, map_slices, utf8

MARK = "▁"


def read_pieces(path: str) -> tuple[list[tuple[str, float]], int]:
    """(piece, score) by id and the id of the unknown piece, from a vocabulary file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


class PieceCounter:
    """Counts pieces of words; ``__missing__`` is not used, so that long words need not be remembered."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.automaton = ahocorasick.Automaton()
        scores: dict[str, float] = {}
        for piece, score in pieces:  # of equal pieces the last one counts
            if piece:
                scores[piece] = score
        for piece, score in scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - 10.0
        self.bytes = all(f"<0x{b:02X}>" in scores for b in range(256))
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        n = len(word)
        best = [0.0] * (n + 1)
        count = [0] * (n + 1)
        fused = [False] * (n + 1)  # the last piece is unknown
        done = 0  # positions up to this one are final

        def close(end: int, single: bool, score: float | None) -> None:
            """Takes the unknown character before ``end`` into account: it starts last, so it must be better."""
            if not single:
                other = best[end - 1] + self.unknown
                if score is None or other > score:
                    best[end] = other
                    if self.bytes:
                        count[end] = count[end - 1] + len(word[end - 1].encode("utf-8"))
                    else:
                        count[end] = count[end - 1] + (not fused[end - 1])
                        fused[end] = True

        score, single = None, False
        for last, (length, value) in self.automaton.iter(word):
            end = last + 1
            while done < end - 1:  # positions where no further piece ends
                close(done + 1, single, score)
                done += 1
                score, single = None, False
            start = end - length
            other = value + best[start]
            if score is None or other > score:  # longer pieces come first
                score = best[end] = other
                count[end] = count[start] + 1
                fused[end] = False
            single = single or length == 1
        while done < n:
            close(done + 1, single, score)
            done += 1
            score, single = None, False
        return count[n]

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        known, total = self.known, 0
        for word in words(text):
            n = known.get(word)
            if n is None:
                n = self.word(word)
                if len(word) < 64:
                    if len(known) > VOCABULARY:
                        known.clear()
                    known[word] = n
            total += n
        return total


def words(text: str) -> list[str]:
    """The text with word marks for spaces, one in front, cut before each mark."""
    parts = text.split(" ")
    out = [MARK + p for p in parts]
    if text[0] in (" ", MARK):  # it begins with a mark already
        out = out[1:] if text[0] == " " else [parts[0], *out[1:]]
    if MARK in text:
        out = [MARK * (i > 0 or p.startswith(MARK)) + x for p in out for i, x in enumerate(p.split(MARK)) if i or x]
    return out


def count_tokens(docs: DataFrame, key: Column, pieces: list[tuple[str, float]], text_col: str = "text") -> DataFrame:
    """key, n_chars, n_tokens for every row of ``docs``, from its whole text.

    Null and empty texts have no tokens.  Equal texts have equal counts.  Other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # a vocabulary file
    rows = docs.select(key.alias("key"), utf8(text_col))
    counter: list[PieceCounter] = []

    def run(part: pa.RecordBatch) -> dict:
        if not counter:
            counter.append(PieceCounter(shared.value))
        texts = [(t or b"").decode("utf-8", "replace") for t in part.column(1).to_pylist()]
        return {"key": part.column(0), "n_chars": np.array([len(t) for t in texts], np.int64), "n_tokens": np.array([counter[0](t) for t in texts], np.int64)}

    kind = rows.schema["key"].dataType.simpleString()
    return map_slices(rows, text_col, f"key {kind}, n_chars long, n_tokens long", run)
