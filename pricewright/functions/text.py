"""Cleaning and field extraction from semi-structured product text."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricewright import fixed

# Java's (?U) gives \s, \d and \b their Unicode meaning; the four separators are whitespace too.
SPACE = r"[\s\x1C-\x1F]"
NON_SPACE = r"[^\s\x1C-\x1F]"


def _find(text: Column, pattern: str, group: int = 1, ignore_case: bool = True) -> Column:
    """First match of a field pattern; '' when there is none. (?d): '.' stops at a newline only."""
    return F.regexp_extract(text, f"(?{'i' if ignore_case else ''}dU){pattern}", group)


def _find_all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?idU){pattern}"), F.lit(1))


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def clean_text(text: Column) -> Column:
    """Collapse whitespace, drop non-ASCII, then drop tags, then trim. Spaces around a tag stay."""
    collapsed = F.regexp_replace(or_empty(text), rf"(?U){SPACE}+", " ")
    ascii_only = F.regexp_replace(collapsed, r"[^\x00-\x7F]", "")
    return F.trim(F.regexp_replace(ascii_only, r"<[^>]+>", ""))


def clean_text_short(text: Column, max_chars: int = fixed.CLEAN_TEXT_CHARS) -> Column:
    """The same without tag removal, cut to ``max_chars``."""
    collapsed = F.regexp_replace(or_empty(text), rf"(?U){SPACE}+", " ")
    return F.substring(F.trim(F.regexp_replace(collapsed, r"[^\x00-\x7F]", "")), 1, max_chars)


def first_word(text: Column) -> Column:
    return F.regexp_extract(text, rf"(?U)\A{SPACE}*({NON_SPACE}+)", 1)


def word_count(text: Column) -> Column:
    return F.regexp_count(or_empty(text), F.lit(rf"(?U){NON_SPACE}+"))


def text_length(text: Column) -> Column:
    return F.length(or_empty(text))


def first_chars(text: Column, most: int | None) -> Column:
    """The text, or its first ``most`` characters."""
    return text if most is None else F.substring(text, 1, most)


# ---- fields of the labelled extraction: raw text ----

def labelled_window(content: Column, max_chars: int | None = None) -> Column:
    return first_chars(or_empty(content), max_chars)


def labelled_item_name(window: Column, max_chars: int | None = None) -> Column:
    return strip(first_chars(_find(window, fixed.ITEM_NAME_OR_EMPTY), max_chars))


def labelled_value(window: Column) -> Column:
    return _find(window, fixed.VALUE, ignore_case=False).try_cast("double")


def labelled_pack_count(window: Column) -> Column:
    return F.coalesce(_find(window, fixed.PACK_OR_COUNT).try_cast("bigint"), F.lit(1).cast("bigint"))


def labelled_description(window: Column, max_parts: int | None = None) -> Column:
    parts = _find_all(window, fixed.BULLET_OR_DESCRIPTION)
    return F.array_join(parts if max_parts is None else F.slice(parts, 1, max_parts), " ")


# ---- fields of the detailed extraction: whole text ----

def detailed_item_name(content: Column) -> Column:
    return clean_text(_find(content, fixed.ITEM_NAME))


def detailed_bullets(content: Column) -> Column:
    return F.array_join(F.transform(_find_all(content, fixed.BULLET_POINT), clean_text), " ")


def detailed_description(content: Column) -> Column:
    return clean_text(_find(content, fixed.PRODUCT_DESCRIPTION))


def detailed_value(content: Column) -> Column:
    return _find(content, fixed.VALUE).try_cast("double")


def detailed_unit(content: Column) -> Column:
    return clean_text(_find(content, fixed.UNIT))


def weight_value(content: Column) -> Column:
    return _find(content, fixed.WEIGHT, 1).try_cast("double")


def weight_unit(content: Column) -> Column:
    """Lower-cased unit of the weight, NULL when the text has no weight."""
    return F.nullif(F.lower(_find(content, fixed.WEIGHT, 2)), F.lit(""))


def detailed_pack_count(content: Column) -> Column:
    return _find(content, fixed.PACK_OF_OR_COUNT).try_cast("bigint")


def has_category(content: Column, category: str) -> Column:
    lowered = F.lower(or_empty(content))
    hit = F.lit(False)
    for keyword in fixed.CATEGORY_KEYWORDS[category]:
        hit = hit | F.contains(lowered, F.lit(keyword))
    return hit


def detect_categories(content: Column) -> Column:
    """Names of the categories whose keywords occur anywhere in the text, in the fixed order."""
    found = F.array(*[F.when(has_category(content, name), F.lit(name)) for name in fixed.CATEGORY_KEYWORDS])
    return F.filter(found, lambda name: name.isNotNull())


def image_link_valid(link: Column) -> Column:
    return F.coalesce(F.startswith(link, F.lit("http")), F.lit(False)).cast("int")


def image_url_length(link: Column) -> Column:
    """A missing link counts as the text 'nan', so its length is 3."""
    return F.length(F.coalesce(link, F.lit("nan")))


def combine_labelled(*fields: Column, max_chars: int | None = None) -> Column:
    """Fields joined by a space, a missing one as empty."""
    return first_chars(F.concat_ws(" ", *[or_empty(f) for f in fields]), max_chars)


def combine_detailed(*fields: Column) -> Column:
    """Non-null fields joined by a space; an empty field still adds its space."""
    return F.concat_ws(" ", *fields)


# ---- vectoriser front end ----

_HANGUL = (0xAC00, 0xD7A3)


def _decompositions() -> tuple[str, str, str, dict[str, str]]:
    """Compatibility decompositions without combining marks, of all code points: those to one character, in two texts; the
    characters that leave nothing; and those to several. Hangul syllables, which follow a rule, are not among them."""
    source, target, nothing, several = [], [], [], {}
    for code in range(0xA0, 0x110000):
        if 0xD800 <= code < 0xE000 or _HANGUL[0] <= code <= _HANGUL[1]:
            continue
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if len(base) > 1:
            several[char] = base
        elif base != char:
            (source if base else nothing).append(char)
            target.append(base)
    return "".join(source), "".join(target), "".join(nothing), several


_ACCENTED, _BASE, _MARKS, _SEVERAL = _decompositions()
_PARTS = 64
_BEYOND = r"\x{A0}-\x{10FFFF}"  # no character before these changes


def _class(chars: str) -> str:
    """A pattern for any of these characters, as ranges of code points."""
    codes, ranges = sorted(map(ord, chars)), []
    for code in codes:
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"


def _jamo(char: Column) -> Column:
    """The two or three letters of a Hangul syllable."""
    at = F.ascii(char) - _HANGUL[0]
    letter = lambda code: F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
    last = at % 28
    return F.concat(letter(F.floor(at / 588) + 0x1100), letter(F.floor((at % 588) / 28) + 0x1161), F.when(last > 0, letter(last + 0x11A7)).otherwise(""))


def _spelled_out(text: Column) -> Column:
    """Characters that decompose to several. Each is looked up in the part of the table that its number falls in."""
    parts: list[list[str]] = [[] for _ in range(_PARTS)]
    for char, base in _SEVERAL.items():
        parts[ord(char) % _PARTS].append(f"{char}\x01{base}")
    maps = F.array(*[F.str_to_map(F.lit("\x02".join(p)), F.lit("\x02"), F.lit("\x01")) for p in parts])

    def spell(char: Column) -> Column:
        code = F.ascii(char)
        known = F.try_element_at(F.get(maps, code % _PARTS), char)
        return F.when(code < 0xA0, char).when(code.between(*_HANGUL), _jamo(char)).otherwise(F.coalesce(known, char))

    return F.array_join(F.transform(F.split(text, ""), spell), "")


def strip_accents(text: Column) -> Column:
    """The compatibility decomposition of a text without its combining marks, code point by code point.

    Most characters that change become one other, or go; only texts with a ligature, a fraction, a Hangul syllable or another
    character that becomes several are looked at character by character.
    """
    simple = F.translate(text, _ACCENTED + _MARKS, _BASE)
    # A class of hundreds of ranges asks them one by one, so only characters that may be among them are compared with it.
    odd = text.rlike(f"[{_BEYOND}&&{_class(''.join(_SEVERAL) + ''.join(map(chr, range(_HANGUL[0], _HANGUL[1] + 1))))}]")
    return F.when(text.rlike(f"[{_BEYOND}]"), F.when(odd, _spelled_out(simple)).otherwise(simple)).otherwise(text)


def tokens(text: Column, accents: bool = True) -> Column:
    """Lower-cased words of two or more word characters."""
    lowered = F.lower(or_empty(text))
    return F.regexp_extract_all(lowered if accents else strip_accents(lowered), F.lit(fixed.TOKEN), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, however often ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), lambda bound: body(bound))[0]


def _runs(words: Column, n: int) -> Column:
    def at(start: Column) -> Column:
        return F.concat_ws(" ", *[F.get(words, start + k) for k in range(n)])

    starts = F.sequence(F.lit(0), F.size(words) - n)
    return F.when(F.size(words) >= n, F.transform(starts, at)).otherwise(F.array().cast("array<string>"))


def ngrams(words: Column, low: int = 1, high: int = 2) -> Column:
    """All n-grams of low..high words, words joined by a space, shorter n first."""
    return let(words, lambda w: F.concat(*[w if n == 1 else _runs(w, n) for n in range(low, high + 1)]))


def sentiment(words: Column, lexicon: dict[str, tuple[float, float]], which: str = "polarity") -> Column:
    """Mean polarity or subjectivity of the words found in the lexicon, 0 when none is.

    The lexicon is a literal of the plan, so scoring is row-local: no join and no regrouping.
    """
    part = {"polarity": 0, "subjectivity": 1}[which]
    table = F.create_map(*[F.lit(x) for word, score in lexicon.items() for x in (word, score[part])])
    known = F.filter(words, lambda w: w.isin(*lexicon))  # a hash lookup, so the map is scanned for hits only
    hits = F.transform(known, lambda w: F.try_element_at(table, w))

    def mean(scores: Column) -> Column:
        total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s)
        return F.when(F.size(scores) > 0, total / F.size(scores)).otherwise(F.lit(0.0))

    return let(hits, mean)
