"""Text expressions: accent folding, tokens, query normalisation, category detection."""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Filler words dropped from a query.
FILLERS = [
    "toi", "muon", "xem", "thich", "tim", "can", "mot", "nhung", "nao", "gi", "vay", "cho",
    "voi", "la", "cua", "va", "hoac", "goi_y", "bo", "dien", "hay",
]

# Accent-free phrases and their English form.
PHRASES = {
    "phim khoa hoc vien tuong": "science fiction movie",
    "phime khoa hoc vien tuong": "science fiction movie",
    "phim sieu anh hung": "superhero movie",
    "phim hanh dong": "action movie",
    "phim tinh cam": "romance movie",
    "phim kinh di": "horror movie",
    "phim chien tranh": "war movie",
    "phim hoat hinh": "animation movie",
    "phim tre em": "children movie",
    "phim vu tru": "space movie",
    "phim my": "american movie",
    "phim hai": "comedy movie",
    "nguoi may": "robot",
    "vu tru": "space",
}

# Single-word fallbacks.
WORDS = {
    "phim": "movie", "hanh": "action", "dong": "action", "tinh": "romance", "cam": "romance",
    "hai": "comedy", "kinh": "horror", "di": "horror", "vien": "fiction", "tuong": "fiction",
    "khoa": "science", "hoc": "science", "chien": "war", "tranh": "war", "hoat": "animation",
    "hinh": "animation", "tre": "children", "em": "children", "sieu": "super", "hung": "hero",
    "nguoi": "robot", "may": "robot", "my": "american",
}

# Phrases that name a category.
CATEGORY_ALIASES = {
    "science fiction": "Sci-Fi", "sci fi": "Sci-Fi", "khoa hoc vien tuong": "Sci-Fi",
    "superhero": "Action", "sieu anh hung": "Action", "action": "Action", "hanh dong": "Action",
    "comedy": "Comedy", "hai": "Comedy", "romance": "Romance", "tinh cam": "Romance",
    "horror": "Horror", "kinh di": "Horror", "adventure": "Adventure", "phuu luu": "Adventure",
    "animation": "Animation", "hoat hinh": "Animation", "children": "Children",
    "tre em": "Children", "war": "War", "chien tranh": "War", "crime": "Crime",
    "toi pham": "Crime", "drama": "Drama", "chinh kich": "Drama", "fantasy": "Fantasy",
    "thriller": "Thriller", "western": "Western", "musical": "Musical", "mystery": "Mystery",
    "documentary": "Documentary", "film noir": "Film-Noir",
}

# Words that carry no content when matching a catalog.
STOPWORDS = [
    "the", "a", "an", "of", "and", "in", "on", "for", "to", "with", "movie", "movies", "film",
    "phim", "about", "some", "like", "want", "give", "me", "toi", "muon", "xem", "thich", "tim",
    "can", "mot", "nhung", "nao", "vay", "cho", "voi", "cua", "hoac", "dien", "hay",
]


def longest_first(table: dict) -> list[tuple[str, str]]:
    return sorted(table.items(), key=lambda kv: -len(kv[0]))


@lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, list[tuple[str, str]]]:
    """Character tables for accent folding, derived from the Unicode database.

    Characters folding to one other character, then characters that vanish (combining marks),
    then the few that fold to several characters. Hangul syllables are left composed.
    """
    single_from, single_to, dropped, several = [], [], [], []
    for code in range(sys.maxunicode + 1):
        if 0xAC00 <= code <= 0xD7A3 or 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        base = {"đ": "d", "Đ": "d"}.get(ch, ch)
        folded = "".join(
            c
            for c in unicodedata.normalize("NFD", base.casefold())
            if not unicodedata.combining(c)
        )
        if folded == ch:
            continue
        if folded == "":
            dropped.append(ch)
        elif len(folded) == 1:
            single_from.append(ch)
            single_to.append(folded)
        else:
            several.append((ch, folded))
    return "".join(single_from + dropped), "".join(single_to), several


def _words(words: list[str]) -> Column:
    """Constant array as one literal, to keep plans that use it many times small."""
    return F.split(F.lit("|".join(words)), r"\|")


def _mapping(table: dict[str, str]) -> Column:
    return F.str_to_map(
        F.lit("|".join(f"{a}={b}" for a, b in table.items())), F.lit(r"\|"), F.lit("=")
    )


def _pairs(pairs: list[tuple[str, str]]) -> Column:
    """Constant array of ``(a, b)`` as one literal."""
    text = json.dumps([{"a": a, "b": b} for a, b in pairs], ensure_ascii=False)
    return F.from_json(F.lit(text), "array<struct<a: string, b: string>>")


# First Hangul syllable and its parts: 19 leading consonants, 21 vowels, 27 final consonants or none.
_SYLLABLE, _LEAD, _VOWEL, _TAIL = 0xAC00, 0x1100, 0x1161, 0x11A7


def _jamo(point: Column) -> Column:
    """The character U+1100 to U+11FF of a code point, by its three UTF-8 bytes."""
    code = F.lit(0xE18080) + F.shiftleft(F.shiftright(point, 6).bitwiseAND(63), 8) + point.bitwiseAND(63)
    return F.decode(F.unhex(F.hex(code)), "UTF-8")


def split_hangul(c: Column) -> Column:
    """Hangul syllables taken apart into their letters, as Unicode decomposition does."""

    def parts(ch: Column) -> Column:
        at = F.ascii(ch) - _SYLLABLE
        tail = at % 28
        letters = F.concat(
            _jamo(F.lit(_LEAD) + F.floor(at / 588).cast("int")),
            _jamo(F.lit(_VOWEL) + F.floor((at % 588) / 28).cast("int")),
            F.when(tail > 0, _jamo(F.lit(_TAIL) + tail)).otherwise(""),
        )
        return F.when(ch.between("\uac00", "\ud7a3"), letters).otherwise(ch)

    return F.when(F.rlike(c, F.lit("[\uac00-\ud7a3]")), F.array_join(F.transform(F.split(c, ""), parts), "")).otherwise(c)


def strip_accents(c: Column) -> Column:
    """Case-folded text without combining marks; d with stroke becomes d, Hangul syllables become letters."""
    ascii_only = F.octet_length(c) == F.length(c)  # folding then changes only A-Z
    given, c = c, split_hangul(c)
    source, target, several = _fold_tables()
    special = "".join(a for a, _ in several)
    # The long replacement list only runs on the rare rows that hold such a character.
    expanded = F.when(
        F.translate(c, special, "") != c, F.aggregate(_pairs(several), c, lambda s, p: F.replace(s, p["a"], p["b"]))
    ).otherwise(c)
    return F.when(ascii_only, F.lower(given)).otherwise(F.translate(expanded, source, target))


def squeeze(c: Column) -> Column:
    """Collapse runs of Unicode white space and trim."""
    return F.trim(F.regexp_replace(c, r"[\s\x1c-\x1f\x{85}\p{Z}]+", " "))


def content_tokens(c: Column) -> Column:
    """Accent-free alphanumeric tokens of three or more characters, stop words removed."""
    tokens = F.regexp_extract_all(strip_accents(F.lower(c)), F.lit("([a-z0-9]+)"), F.lit(1))
    stop = _words(STOPWORDS)
    return F.filter(tokens, lambda t: (F.length(t) >= 3) & ~F.array_contains(stop, t))


def normalize_query(c: Column) -> Column:
    """Query text in its English form; text that holds only fillers stays as its folded key."""
    key = strip_accents(c)
    out = key
    for phrase, english in longest_first(PHRASES):
        out = F.replace(out, F.lit(phrase), F.lit(english))
    fillers = _words(FILLERS)
    words = F.filter(
        F.split(squeeze(out), " "), lambda w: (w != "") & ~F.array_contains(fillers, w)
    )
    table = _mapping(WORDS)
    mapped = F.transform(words, lambda w: F.coalesce(F.try_element_at(table, w), w))
    return F.coalesce(F.nullif(F.array_join(mapped, " "), F.lit("")), key)


def detect_categories(c: Column) -> Column:
    """Category labels named in the text, longest alias first; matched text is used up."""
    key = strip_accents(c)
    aliases = _pairs([(f" {a} ", label) for a, label in longest_first(CATEGORY_ALIASES)])
    start = F.struct(
        F.concat(F.lit(" "), key, F.lit(" ")).alias("rest"),
        F.array().cast("array<string>").alias("found"),
    )

    def step(state: Column, alias: Column) -> Column:
        hit = ~F.array_contains(state["found"], alias["b"]) & F.contains(
            state["rest"], alias["a"]
        )
        return F.when(
            hit,
            F.struct(
                F.replace(state["rest"], alias["a"], F.lit(" ")).alias("rest"),
                F.array_append(state["found"], alias["b"]).alias("found"),
            ),
        ).otherwise(state)

    return F.aggregate(aliases, start, step, lambda s: s["found"])


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(" \t\n\r\x0b\x0c"))


def joined_text(*cols: Column) -> Column:
    """Trimmed non-empty parts joined by one space."""
    return F.concat_ws(" ", *[F.nullif(strip(c), F.lit("")) for c in cols])


def item_text(fields: tuple[str, ...] = ("title", "category", "tags")) -> Column:
    return joined_text(*[F.col(f) for f in fields])


ITEM_TEXT_FIELDS = ("title", "category", "tags", "text_description")
