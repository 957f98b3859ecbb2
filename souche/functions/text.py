"""Text scalars as Column expressions, with Python twins for Arrow code.

Words are maximal runs of letters and digits after lower-casing and dropping accents.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F


@cache
def _marks() -> dict[int, None]:
    return {c: None for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c))[0] == "M"}


@cache
def _fold_table() -> tuple[str, str]:
    """Every precomposed character whose decomposition has one base character, with that base."""
    source, target = [], []
    for code in range(0xC0, 0x3000):
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFD", char) if unicodedata.category(c)[0] != "M")
        if base != char and len(base) == 1:
            source.append(char)
            target.append(base)
    return "".join(source), "".join(target)


def bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once a row, however often it is used (a one-element array holds it)."""
    return F.transform(F.array(value), use)[0]


def drop_accents(col: Column) -> Column:
    """NFD, then marks removed (œ, æ, ß, ł stay, as they have no decomposition)."""
    source, target = _fold_table()
    return F.regexp_replace(F.translate(col, source, target), r"\p{M}+", "")


def fold(col: Column) -> Column:
    return drop_accents(F.lower(col))


def fold_py(text: str) -> str:
    text = text.lower()
    if text.isascii():
        return text
    return unicodedata.normalize("NFD", text).translate(_marks())


_WORD = re.compile(r"[^\W_]+")


_MARKS_FROM = re.compile("[\u0300-\U0010ffff]")  # no mark has a smaller code


def _has_marks(text: str) -> bool:
    return not _marks().keys().isdisjoint(map(ord, _MARKS_FROM.findall(text)))


def raw_words_py(text: str | None) -> list[str]:
    """Lower-cased words that fold_py turns into the words of the text, one by one.

    A letter decomposes into a letter and marks, so words can be cut first and folded after
    (each distinct one once), unless the text holds marks of its own.
    """
    if not text:
        return []
    low = text.lower()
    if not low.isascii() and _has_marks(low):
        low = fold_py(low)
    return _WORD.findall(low)


def words_py(text: str | None) -> list[str]:
    return [w if w.isascii() else fold_py(w) for w in raw_words_py(text)]


def words(col: Column) -> Column:
    return F.filter(F.split(fold(col), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def ngrams(words: Column, n: int) -> Column:
    """Runs of n neighbouring words, joined by blanks, in linear time: shifted copies zipped together."""
    count = F.greatest(F.size(words) - (n - 1), F.lit(0))
    out = F.slice(words, 1, count)
    for k in range(1, n):
        out = F.zip_with(out, F.slice(words, k + 1, count), lambda a, b: F.concat_ws(" ", a, b))
    return out


def squeeze(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, r"(?U)\s+", " "))


def absent(col: Column) -> Column:
    """``''`` and blanks mean the same as NULL."""
    return F.when(F.trim(col) != "", col)


def surname_key(col: Column) -> Column:
    """Surname normaliser: folded, hyphen to blank, blanks collapsed; the apostrophe stays."""
    return squeeze(F.translate(fold(col), "-", " "))


def first_name_key(col: Column) -> Column:
    """First-name normaliser: as for surnames, the apostrophe to blank as well."""
    return squeeze(F.regexp_replace(fold(col), "[-'’]", " "))


def linked_name(col: Column, first_name: bool = False) -> Column:
    """A cited name without its bracketed remarks and digits, normalised."""
    bare = F.regexp_replace(F.regexp_replace(col, r"\([^)]*\)", " "), r"\p{Nd}+", "")
    return first_name_key(bare) if first_name else surname_key(bare)


def stable_id(key: Column) -> Column:
    return F.substring(F.md5(key), 1, 8)


def display_name(col: Column) -> Column:
    return F.initcap(col)


def statistics_key(col: Column) -> Column:
    """Key of the birth statistics: letters, blanks and hyphens only."""
    return squeeze(F.regexp_replace(fold(col), r"[^a-z\s\-]", " "))


#: fixed value: what stands before the name in a listing's title
TITLE_PREFIX = "Tout sur le prénom "


def scraped_key(col: Column) -> Column:
    """Key of a name in a listing: its title's prefix dropped, letters and hyphens only (œ, æ and ß spelt out)."""
    name = F.when(col.contains(TITLE_PREFIX), col.substr(F.locate(TITLE_PREFIX, col) + len(TITLE_PREFIX), F.length(col))).otherwise(col)
    plain = F.replace(F.replace(F.replace(fold(name), F.lit("œ"), F.lit("oe")), F.lit("æ"), F.lit("ae")), F.lit("ß"), F.lit("ss"))
    return F.regexp_replace(plain, r"[^a-z\-]", "")


def title_case(col: Column) -> Column:
    """Upper case after every non-letter, as in title case of running text."""
    parts = F.regexp_extract_all(F.lower(col), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), p.substr(F.lit(2), F.length(p)))), "")


def clean_surname_text(col: Column) -> Column:
    text = drop_accents(col)
    text = F.regexp_replace(text, r"https?://\S+|www\.\S+", " ")
    text = F.regexp_replace(text, r"(?U)\b\d+\w*\b", " ")
    text = F.regexp_replace(text, r"(?U)[^\w\s'-]", " ")
    text = F.regexp_replace(text, r"(?U)(?<!\w)-|-(?!\w)", " ")
    return squeeze(F.lower(text))


def clean_first_name_text(col: Column) -> Column:
    text = F.regexp_replace(F.regexp_replace(col, r"<[^>]+>", " "), r"https?://\S+", " ")
    return squeeze(text)


def embedding_text(history: Column, origin: Column, etymology: Column) -> Column:
    """Text for the encoder: the cleaned history twice, then origin and etymology, what is empty left out."""
    parts = [absent(clean_first_name_text(c)) for c in (history, history, origin, etymology)]
    return F.concat_ws(" | ", *parts)


def joined_text(*cols: Column) -> Column:
    """Cleaned fields joined by blanks, what is empty left out."""
    return F.concat_ws(" ", *(absent(clean_first_name_text(c)) for c in cols))


def display_text(col: Column) -> Column:
    """Blanks collapsed, first letter upper, closed with a full stop unless ended."""
    text = squeeze(col)
    text = F.concat(F.upper(F.substring(text, 1, 1)), text.substr(F.lit(2), F.length(text)))
    return F.when(text == "", F.lit("")).when(text.rlike(r"[.!?]$"), text).otherwise(F.concat(text, F.lit(".")))


def token_count(col: Column) -> Column:
    text = squeeze(col)
    return F.when(text == "", 0).otherwise(F.size(F.split(text, " ")))


def distance_limit(length: Column) -> Column:
    """Edits allowed between two spellings, by length."""
    return F.when(length <= 4, 1).when(length <= 7, 2).otherwise(3)


def sentences(col: Column, least: int = 25) -> Column:
    return F.filter(F.split(F.trim(col), r"(?<=[.!?])\s+"), lambda s: F.length(s) >= least)


def thousands(col: Column) -> Column:
    return F.replace(F.format_number(col, 0), F.lit(","), F.lit(" "))


def pad_department(col: Column) -> Column:
    return F.when(F.length(col) < 2, F.lpad(col, 2, "0")).otherwise(col)


def filled(col: Column) -> Column:
    return F.coalesce(F.trim(col) != "", F.lit(False))
