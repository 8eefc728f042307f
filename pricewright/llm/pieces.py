"""SentencePiece encoding and decoding with byte spans.

The model file's compiled character map (a double array of byte labels, then zero-ended replacements) is unrolled once
into its prefixes.  A text is normalised by the longest prefix at each place, and every normalised character keeps the
byte of the text that it comes from.  Merging pairs by score gives the pieces; their lengths then index those bytes,
which gives every piece its span in the original text.

Merges never join what no piece of the vocabulary holds side by side, so a text is cut where a word mark follows
another character (if no piece has one there), and the pieces of short words are remembered.
"""

from __future__ import annotations

import codecs
import heapq
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm.batches import map_slices, utf8

MARK = "▁"
BLOCK = 1 << 20  # characters normalised at once
SHORT, REMEMBERED = 32, 150_000  # characters of words that are merged together, and how many words are remembered
_NEVER = np.iinfo(np.int32).max
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6  # kinds of pieces in a model file


def unroll(blob: bytes) -> dict[str, str]:
    """Prefix -> replacement of a compiled character map."""
    if not blob:
        return {}
    size, = struct.unpack_from("<I", blob)
    units, texts = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64), blob[4 + size:]

    def offset(unit):
        return (unit >> 10) << ((unit & 512) >> 6)

    found, labels = {}, np.arange(1, 256)
    places, prefixes = offset(units[:1]), [b""]
    while len(places):
        after, longer = [], []
        for a in range(0, len(places), 4096):  # the children of some nodes
            children = places[a:a + 4096, None] ^ labels
            children[children >= len(units)] = 0
            node, label = np.nonzero((units[children] & 0x800000FF) == labels)
            unit = units[children[node, label]]
            below = children[node, label] ^ offset(unit)
            names = [prefixes[a + i] + bytes([c + 1]) for i, c in zip(node.tolist(), label.tolist())]
            for i in np.flatnonzero(unit >> 8 & 1).tolist():
                start = int(units[below[i]] & 0x7FFFFFFF)
                found[names[i].decode("utf-8")] = texts[start:texts.index(b"\0", start)].decode("utf-8")
            after.append(below)
            longer.extend(names)
        places, prefixes = np.concatenate(after), longer
    return found


def _characters(some: set[str]) -> str:
    return "[" + "".join(map(re.escape, sorted(some))) + "]"


class Normaliser:
    """Rewrites a text by the longest prefixes of a map, spaces to marks, and tells where each character comes from."""

    def __init__(self, rules: dict[str, str], prefix: bool, squeeze: bool, escape: bool, suffix: bool):
        self.rules, self.prefix, self.squeeze, self.suffix = rules, prefix, squeeze, suffix
        self.space = MARK if escape else " "
        self.longest = max(map(len, rules), default=0)
        single, several = {k for k in rules if len(k) == 1}, {k for k in rules if len(k) > 1}
        parts = [_characters({k[0] for k in several}) + _characters({k[1] for k in several})] * bool(several) + [_characters(single)] * bool(single)
        self.candidate = re.compile("|".join(parts), re.DOTALL) if parts else None
        self.cuts = not squeeze and not any(" " in k[1:] for k in rules)  # a text may be cut before a space

    def _mapped(self, text: str) -> Iterator[tuple[str, str | None]]:
        """(source, replacement) in order; None where the source stays."""
        done = at = 0
        while self.candidate is not None and (hit := self.candidate.search(text, at)):
            at = hit.start()
            for length in range(min(self.longest, len(text) - at), 0, -1):
                new = self.rules.get(text[at:at + length])
                if new is not None:
                    if at > done:
                        yield text[done:at], None
                    yield text[at:at + length], new
                    done = at = at + length
                    break
            else:
                at += 1
        if done < len(text):
            yield text[done:], None

    def blocks(self, text: str) -> Iterator[tuple[str, np.ndarray]]:
        """Normalised text in blocks, and the source byte of each of its characters and of its end."""
        at = base = 0
        while at < len(text):
            end = at + BLOCK
            while self.cuts and end < len(text) and not (text[end] == " " and text[end - 1] != " "):
                end = text.find(" ", end + 1)
                end = len(text) if end < 0 else end
            end = end if self.cuts else len(text)
            parts, sources = [], []
            if at == 0 and self.prefix and not self.suffix:
                parts.append(" ")
                sources.append(np.zeros(1, np.int64))
            for source, new in self._mapped(text[at:end]):
                raw = np.frombuffer(source.encode("utf-8"), np.uint8)
                if new is None:
                    parts.append(source)
                    sources.append(base + np.flatnonzero((raw & 0xC0) != 0x80))
                else:
                    parts.append(new)
                    sources.append(np.full(len(new), base))
                base += len(raw)
            out, where = "".join(parts), np.concatenate([*sources, [base]]).astype(np.int64)
            if self.squeeze:
                out, where = self._squeezed(out, where, self.prefix and not self.suffix)
            if self.suffix and self.prefix and end >= len(text) and out:
                out, where = out + " ", np.r_[where, where[-1]]
            if out:
                yield out.replace(" ", self.space), where
            at = end

    @staticmethod
    def _squeezed(text: str, where: np.ndarray, prefixed: bool) -> tuple[str, np.ndarray]:
        """One space for several, none at either end, but for the one put in front."""
        space = np.array([c == " " for c in text], bool)
        first = np.flatnonzero(~space)
        if not len(first):
            return "", where[:0]
        keep = ~(space & np.r_[True, space[:-1]])
        keep[:first[0]] = False
        keep[0] |= prefixed
        keep[first[-1] + 1:] = False
        kept = np.flatnonzero(keep)
        where = where.copy()
        where[0] = where[first[0]]  # what goes in front of the text is not counted
        return "".join(text[i] for i in kept), np.r_[where[kept], where[first[-1] + 1]]


@dataclass
class PieceModel:
    """What a BPE model file says: pieces with scores and kinds, and how texts are normalised."""

    pieces: list[tuple[str, float, int]]
    unknown: int
    end: int
    byte_fallback: bool
    unknown_surface: str
    rules: dict[str, str]
    prefix: bool
    squeeze: bool
    escape: bool
    suffix: bool


def read_model(path: str) -> PieceModel:
    """A model file; only BPE models without unused pieces and without rules for decoding are known."""
    from sentencepiece import sentencepiece_model_pb2 as wire

    model = wire.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    kinds = [p.type for p in model.pieces]
    if model.trainer_spec.model_type != model.trainer_spec.BPE or UNUSED in kinds or model.denormalizer_spec.precompiled_charsmap:
        raise ValueError("a BPE model without unused pieces and rules for decoding is needed")
    rule = model.normalizer_spec
    names = [p.piece for p in model.pieces]
    return PieceModel(
        [(p.piece, p.score, p.type) for p in model.pieces], kinds.index(UNKNOWN), names.index(model.trainer_spec.eos_piece),
        model.trainer_spec.byte_fallback, model.trainer_spec.unk_surface, unroll(rule.precompiled_charsmap),
        rule.add_dummy_prefix, rule.remove_extra_whitespaces, rule.escape_whitespaces, model.trainer_spec.treat_whitespace_as_suffix)


class Encoder:
    def __init__(self, model: PieceModel):
        self.model = model
        self.normaliser = Normaliser(model.rules, model.prefix, model.squeeze, model.escape, model.suffix)
        self.ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
        self.scores = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER)}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
        fixed = sorted((p for p, _, kind in model.pieces if kind == USER), key=len, reverse=True)
        self.fixed = re.compile("|".join(map(re.escape, fixed)), re.DOTALL) if fixed else None
        inside = any(MARK in p.lstrip(MARK) for p in self.ids)
        self.word = None if inside else re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self._forget()
        self._tables()

    def _symbols(self, text: str) -> tuple[list[str], list[bool]]:
        if self.fixed is None:
            return list(text), [False] * len(text)
        parts, frozen, at = [], [], 0
        for hit in self.fixed.finditer(text):
            loose = text[at:hit.start()]
            parts += [*loose, hit.group()]
            frozen += [False] * len(loose) + [True]
            at = hit.end()
        return parts + list(text[at:]), frozen + [False] * (len(text) - at)

    def _merge(self, text: str) -> list[str]:
        """Joins the neighbours with the best score, the leftmost of equals, until none is a piece."""
        parts, frozen = self._symbols(text)
        score, n = self.scores.get, len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap: list[tuple[float, int, int, int]] = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and not frozen[left] and not frozen[right]:
                both = parts[left] + parts[right]
                value = score(both)
                if value is not None:
                    heapq.heappush(heap, (-value, left, right, len(both)))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, left, right, size = heapq.heappop(heap)
            if not parts[left] or not parts[right] or len(parts[left]) + len(parts[right]) != size:
                continue  # one of them has changed since
            parts[left] += parts[right]
            parts[right] = ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            offer(before[left], left)
            offer(left, after[left])
        return [p for p in parts if p]

    def _pieces(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of a word's pieces and how many characters each takes; bytes of an unknown one take it with the last."""
        parts = self._merge(text)
        try:
            return [self.ids[p] for p in parts], [len(p) for p in parts]
        except KeyError:  # a character that is no piece
            ids, lengths = [], []
        for part in parts:
            i = self.ids.get(part)
            if i is not None or not self.model.byte_fallback:
                ids.append(self.model.unknown if i is None else i)
                lengths.append(len(part))
            else:
                raw = part.encode("utf-8")
                ids += [self.bytes[b] for b in raw]
                lengths += [0] * (len(raw) - 1) + [len(part)]
        return ids, lengths

    def _parts(self, word: str) -> Iterator[str]:
        """A long word, cut between characters that no piece has side by side."""
        if self.fixed is not None:
            yield word
            return
        start = 0
        for i in range(1, len(word)):
            if word[i - 1:i + 1] not in self.pairs:
                yield word[start:i]
                start = i
        yield word[start:]

    def _tables(self) -> None:
        """Ids by code point, and for all pairs of pieces that make a piece its id and its place in the order of scores."""
        self.point = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.point[ord(piece)] = i
        self.length = np.array([len(p) for p, _, _ in self.model.pieces], np.int64)
        joins = [(self.ids[p[:i]], self.ids[p[i:]], own) for p, own in self.ids.items() for i in range(1, len(p)) if p[:i] in self.ids and p[i:] in self.ids]
        left, right, own = np.array(joins, np.int64).reshape(-1, 3).T
        order = np.argsort(left << 32 | right)
        self.pair, self.joined = (left << 32 | right)[order], own[order].astype(np.int32)
        # equal scores have equal ranks
        scores = np.array([self.scores.get(p, 0.0) for p, _, _ in self.model.pieces])
        self.rank = np.append(np.unique(-scores, return_inverse=True)[1].astype(np.int32), _NEVER)

    def _join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the pieces that two make, -1 for none."""
        if not len(self.pair):
            return np.full(left.shape, -1, np.int32)
        key = left.astype(np.int64) << 32 | right.astype(np.int64)  # no key of the table is negative
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.joined[at], np.int32(-1))

    def _merge_all(self, symbols: np.ndarray) -> np.ndarray:
        """What ``_merge`` does, for one word a row; ids end where -1 begins."""
        done, rows = symbols.copy(), np.arange(len(symbols))
        parts, joined = symbols, self._join(symbols[:, :-1], symbols[:, 1:])
        while len(rows) and parts.shape[1] > 1:
            rank = self.rank[joined]
            at = rank.argmin(axis=1)
            every = np.arange(len(rows))
            active = rank[every, at] != _NEVER
            if not active.all():
                done[rows[~active]] = -1
                done[rows[~active], :parts.shape[1]] = parts[~active]
                rows, parts, joined, at = rows[active], parts[active], joined[active], at[active]
                every = every[:len(rows)]
            if not len(rows):
                break
            parts[every, at] = joined[every, at]
            width = parts.shape[1] - 1
            behind = np.arange(width) > at[:, None]
            parts = np.where(behind, parts[:, 1:], parts[:, :-1])
            joined = np.where(behind[:, :-1], joined[:, 1:], joined[:, :-1])
            for side in (at - 1, at):  # the pairs with the new piece
                inside = np.flatnonzero((side >= 0) & (side < width - 1))
                joined[inside, side[inside]] = self._join(parts[inside, side[inside]], parts[inside, side[inside] + 1])
        if len(rows):
            done[rows] = -1
            done[rows, :parts.shape[1]] = parts
        return done

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.size = 0
        self.flat_ids, self.flat_lengths = np.empty(0, np.int32), np.empty(0, np.int64)
        self.begins, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)

    def _learn(self, words: set[str]) -> None:
        """Remembers the pieces of words: short ones merged together, others one after another."""
        if len(self.known) > REMEMBERED or self.size > REMEMBERED * SHORT:
            self._forget()
        new = sorted(words - self.known.keys(), key=len)
        ids, lengths, counts = [], [], []
        for width in (8, 16, SHORT, None):
            some = [w for w in new if width is None or len(w) <= width]
            new = new[len(some):]
            slow = some
            if width is not None and self.fixed is None and some:
                sizes = np.fromiter(map(len, some), np.int64, len(some))
                points = self.point[np.frombuffer("".join(some).encode("utf-32-le", "surrogatepass"), "<u4")]
                symbols = np.full((len(some), width), -1, np.int32)
                symbols[np.arange(width) < sizes[:, None]] = points
                odd = np.add.reduceat(points < 0, np.r_[0, np.cumsum(sizes)[:-1]]) > 0  # with a character that is no piece
                slow = [some[i] for i in np.flatnonzero(odd)]
                merged = self._merge_all(symbols[~odd])
                held = merged >= 0
                ids.append(merged[held])
                lengths.append(self.length[merged[held]])
                counts.append(held.sum(axis=1))
                self._number(some[i] for i in np.flatnonzero(~odd))
            for word in slow:
                found = [self._pieces(part) for part in (self._parts(word) if len(word) > SHORT else [word])]
                ids.append(np.array([i for f in found for i in f[0]], np.int32))
                lengths.append(np.array([n for f in found for n in f[1]], np.int64))
                counts.append(np.array([len(ids[-1])]))
                self._number([word])
        if ids:
            self.flat_ids, self.flat_lengths = np.concatenate([self.flat_ids, *ids]), np.concatenate([self.flat_lengths, *lengths])
            self.counts = np.concatenate([self.counts, *counts]).astype(np.int64)
            self.begins = np.cumsum(self.counts) - self.counts

    def _number(self, words) -> None:
        for word in words:
            self.size += len(word)
            self.known[word] = len(self.known)

    def _spelled(self, blocks: list[tuple[int, list[str], np.ndarray]], out: list[list]) -> None:
        """Adds ids, starts and ends of blocks (text, words, sources) to the lists of their texts."""
        self._learn({w for _, words, _ in blocks for w in words})
        for text, words, where in blocks:
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            counts = self.counts[at]
            begins = np.cumsum(counts) - counts
            place = np.repeat(self.begins[at] - begins, counts) + np.arange(int(counts.sum()))
            lengths = self.flat_lengths[place]
            stops = np.cumsum(lengths)
            out[text].append((self.flat_ids[place], where[stops - lengths], where[stops], where[-1]))

    def __call__(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text its ids with the end id, and the first byte and the byte after the last of each piece's source."""
        out: list[list] = [[] for _ in texts]
        blocks, size = [], 0
        for i, text in enumerate(texts):
            for normal, where in self.normaliser.blocks(text):
                blocks.append((i, self.word.findall(normal) if self.word is not None else [normal], where))
                size += len(normal)
                if size >= 2 * BLOCK:
                    self._spelled(blocks, out)
                    blocks, size = [], 0
        self._spelled(blocks, out)
        return [self._ended(parts) for parts in out]

    def _ended(self, parts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        total = parts[-1][3] if parts else 0
        ids, starts, ends = (np.concatenate([p[i] for p in parts]) if parts else np.empty(0, np.int64) for i in range(3))
        if not self.model.byte_fallback and len(ids):  # unknown neighbours are one
            first = ~((ids == self.model.unknown) & np.r_[False, ids[:-1] == self.model.unknown])
            ids, starts, ends = ids[first], starts[first], ends[np.r_[first[1:], True]]
        return np.r_[ids, self.model.end].astype(np.int32), np.r_[starts, total], np.r_[ends, total]


def _one_for_each_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


class Decoder:
    def __init__(self, model: PieceModel):
        codecs.register_error("pricewright-pieces", _one_for_each_byte)
        self.model = model
        self.byte = {i: int(p[3:5], 16) for i, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.silent = {i for i, (_, _, kind) in enumerate(model.pieces) if kind == CONTROL}
        surfaces = {CONTROL: lambda p: "", UNKNOWN: lambda p: model.unknown_surface}
        self.surface = [surfaces.get(kind, lambda p: p.replace(MARK, " "))(p) for p, _, kind in model.pieces]

    def _front(self, ids: list[int]) -> int:
        """How many pieces stand before the first that needs no look at the text's beginning."""
        at = 0
        while at < len(ids) and (ids[at] in self.silent or (self.model.squeeze and not self.surface[ids[at]].strip(" "))):
            at += 1
        return at + 1

    def __call__(self, ids: list[int]) -> str:
        """The text of ids: marks are spaces, one in front goes if texts get one, bytes are put together."""
        out: list[str] = []
        strip = self.model.prefix or self.model.squeeze
        n = self._front(ids) if strip else 0
        begun = False  # text, or the mark that was put in front, has been seen
        for i in ids[:n]:
            if i in self.byte or i in self.silent:
                out.append("" if i in self.silent else chr(0xDC00 + self.byte[i]))
                begun |= i in self.byte
            else:
                piece, kind = self.surface[i], self.model.pieces[i][2]
                cut = not begun and kind != UNKNOWN and piece.startswith(" ")
                out.append(piece[1:] if cut else piece)
                begun |= bool(out[-1]) or (cut and not self.model.squeeze)
        byte, rest = self.byte, ids[n:]
        if byte.keys().isdisjoint(ids):
            return "".join(out) + "".join(map(self.surface.__getitem__, rest))
        out += [chr(0xDC00 + byte[i]) if i in byte else self.surface[i] for i in rest]
        joined = [(lone, "".join(part)) for lone, part in groupby(out, key=lambda s: len(s) == 1 and 0xDC00 <= ord(s) < 0xDD00)]
        return "".join(bytes(ord(c) - 0xDC00 for c in s).decode("utf-8", "pricewright-pieces") if lone else s for lone, s in joined)


def encode(docs: DataFrame, key: Column, model: PieceModel, text_col: str = "text") -> DataFrame:
    """key, ids, starts, ends, decoded for every row of ``docs``, from its whole text.

    ``ids`` are those of the library with an end id; ``starts`` and ``ends`` are byte places in the UTF-8 text.  A mark put
    in front and the end id span nothing; of the bytes of an unknown character the last spans it.  ``decoded`` is the text
    that the ids stand for.  Null and empty texts have the end id only.  Texts are handled in blocks of ``BLOCK`` characters,
    so long ones need little more than their result; bytes that are not UTF-8 count as U+FFFD.  Equal texts have equal
    results, repeated rows stay, an empty table gives none, and other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a vocabulary file
    rows = docs.select(key.alias("key"), utf8(text_col))
    tools: list = []

    def run(part: pa.RecordBatch) -> dict:
        if not tools:
            tools.extend([Encoder(shared.value), Decoder(shared.value)])
        encoder, decoder = tools
        found = encoder([(t or b"").decode("utf-8", "replace") for t in part.column(1).to_pylist()])
        cuts = np.cumsum([0, *(len(ids) for ids, _, _ in found)]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(cuts, pa.array(np.concatenate([f[i] for f in found]).astype(np.int32))) for i in range(3)]
        return {"key": part.column(0), "ids": lists[0], "starts": lists[1], "ends": lists[2], "decoded": pa.array([decoder(f[0].tolist()) for f in found], pa.string())}

    kind = rows.schema["key"].dataType.simpleString()
    return map_slices(rows, text_col, f"key {kind}, ids array<int>, starts array<int>, ends array<int>, decoded string", run)
