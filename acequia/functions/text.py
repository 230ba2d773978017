"""Text functions as Column expressions; everything here stays inside the JVM."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word and unit rules of the text normaliser.
STOP_WORDS = (
    "DE", "POR", "X", "EL", "LA", "LOS", "LAS", "EN", "CON", "A", "AL",
    "INTRAMUSCULAR", "INTRAVENOSA", "ORAL",
)
PLURAL_UNITS = ("CM", "MT")
DROPPED_UNITS = ("PU",)
GLUED_UNITS = ("MG", "ML")

DEMO_TOKEN = "DEMO"

# `(?U)`: word boundaries, digits and spaces by their Unicode definition.
_UNICODE = "(?U)"
_NOT_ASCII = r"[^\x00-\x7F]"
# Every white-space character of Unicode.
_SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _folded(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))


def _is_word(text: str) -> bool:
    return all(c.isalnum() or c == "_" for c in text)


@lru_cache(maxsize=1)
def accent_tables() -> tuple[dict[str, str], dict[str, str]]:
    """(one character or deletion, several characters) foldings of upper-case text.

    Derived from the Unicode data by one rule: keep a code point when folding it
    yields ASCII letters, digits or spaces, removes it, or changes whether it is
    a word character. All other code points cannot influence normalised text, as
    what is left of them becomes a space either way.
    """
    single: dict[str, str] = {}
    several: dict[str, str] = {}
    for cp in range(0x80, 0x20000):
        # surrogates have no character; Hangul and ideographs never fold to ASCII
        if 0xD800 <= cp <= 0xDFFF or 0xAC00 <= cp <= 0xD7A3 or 0x3400 <= cp <= 0x9FFF:
            continue
        ch = chr(cp)
        folded = _folded(ch)
        if folded == ch:
            continue
        matters = (
            not folded
            or any(c.isascii() for c in folded)
            or _is_word(folded) != _is_word(ch)
        )
        if not matters:
            continue
        if len(folded) <= 1:
            single[ch] = folded
        else:
            several[ch] = folded
    return single, several


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _fold(c: Column) -> Column:
    single, several = accent_tables()
    # translate() deletes the characters that have no counterpart in its third argument
    kept = {k: v for k, v in single.items() if v}
    gone = [k for k, v in single.items() if not v]
    one = F.translate(c, "".join(kept) + "".join(gone), "".join(kept.values()))
    # one literal instead of a node per entry keeps the plan small
    entries = "\x01".join(f"{k}\x02{v}" for k, v in several.items())
    expand = F.str_to_map(F.lit(entries), F.lit("\x01"), F.lit("\x02"))

    def many(text: Column) -> Column:
        chars = F.transform(F.split(text, ""), lambda x: F.coalesce(F.try_element_at(expand, x), x))
        return F.array_join(chars, "")

    keys = "".join(several)
    return _let(one, lambda t: F.when(F.translate(t, keys, "") != t, many(t)).otherwise(t))


def strip_accents(c: Column) -> Column:
    """Compatibility-decompose and drop combining marks; ASCII rows pass untouched."""
    return _let(c, lambda t: F.when(t.rlike(_NOT_ASCII), _fold(t)).otherwise(t))


def _words(*words: str) -> str:
    return rf"\b(?:{'|'.join(words)})\b"


# Fixed values: (pattern, replacement) steps of the normaliser, in order. The last
# turns every run of other characters, spaces included, into one space.
_STEPS = (
    (rf"\b({'|'.join(PLURAL_UNITS)})S\b", "$1"),
    (_words(*DROPPED_UNITS), ""),
    (rf"\b(\d+)[\s\x1c-\x1f]*({'|'.join(GLUED_UNITS)})\b", "$1$2"),
    (_words(*STOP_WORDS), ""),
    ("[^A-Z0-9]+", " "),
)


def _apply_steps(c: Column, flag: str) -> Column:
    for pattern, replacement in _STEPS:
        c = F.regexp_replace(c, flag + pattern, replacement)
    return F.trim(c)


def normalize_text(c: Column) -> Column:
    """Comparable form of a free-text name; null becomes the empty string.

    Unicode word boundaries cost several times the ASCII ones, so only rows that
    still hold other characters after folding pay for them.
    """
    folded = strip_accents(F.upper(F.coalesce(c.cast("string"), F.lit(""))))
    return _let(
        folded,
        lambda t: F.when(t.rlike(_NOT_ASCII), _apply_steps(t, _UNICODE)).otherwise(_apply_steps(t, "")),
    )


def trim_text(c: Column) -> Column:
    """Strip every kind of white space at both ends; null stays null."""
    return F.btrim(c, F.lit(_SPACES))


def squeeze_spaces(c: Column) -> Column:
    """Strip and reduce inner white space to one space each."""
    return F.trim(F.regexp_replace(c, _UNICODE + r"\s+", " "))


def clean_code(c: Column) -> Column:
    """Code as text without the `.0` that a numeric export leaves behind."""
    return F.regexp_replace(trim_text(c.cast("string")), r"\.0$", "")


def key_text(c: Column) -> Column:
    """Natural key as text: a clean code, null when nothing is left of it."""
    return F.nullif(clean_code(c), F.lit(""))


def truncate(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def to_text(c: Column) -> Column:
    return trim_text(c.cast("string"))


def first_words(c: Column, n: int) -> Column:
    return F.slice(F.split(c, " "), 1, n)


def contains_all(c: Column, words: Column) -> Column:
    """True when every word occurs in `c` as a substring."""
    return F.forall(words, lambda w: F.contains(c, w))


def sorted_words(c: Column) -> Column:
    return F.array_join(F.array_sort(F.split(c, " ")), " ")


def same_text(a: Column, b: Column) -> Column:
    """Null-safe equality that ignores case and outer spaces."""
    return F.upper(trim_text(a)).eqNullSafe(F.upper(trim_text(b)))


def join_key(c: Column) -> Column:
    return F.upper(trim_text(c.cast("string")))


def composite_key(*parts: Column) -> Column:
    """Parts joined by `-`; a missing part is kept as an empty one.

    Parts that hold `-` themselves can give one text for different keys, so rows are
    told apart by the parts (`key_part`), never by this text.
    """
    return F.concat_ws("-", *[key_part(p) for p in parts])


def key_part(c: Column) -> Column:
    """A part of a composite key as a non-null text; a missing part is an empty one."""
    return F.coalesce(c.cast("string"), F.lit(""))


def is_demo(c: Column, token: str = DEMO_TOKEN) -> Column:
    """True for values containing the token in any case; null is not a demo value."""
    return F.coalesce(F.contains(F.upper(c.cast("string")), F.lit(token)), F.lit(False))
