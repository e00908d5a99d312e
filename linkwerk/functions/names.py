"""Normalisers for German names, streets and postal codes, as Column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: letters that no decomposition turns into ASCII
SPECIAL = {"æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ħ": "h", "ı": "i", "ŋ": "ng", "ĳ": "ij", "ĸ": "q", "ſ": "s", "ŧ": "t", "ß": "ss"}
# fixed values: street suffixes and what they become
SUFFIXES = [("str.", "strasse"), ("straße", "strasse"), ("str", "strasse")]


def accents() -> tuple[str, str]:
    """Lower-case letters of Latin-1 and Latin Extended-A that are a base letter with marks, and those letters."""
    pairs = [(c, d[0]) for c in map(chr, range(0xE0, 0x180)) if c == c.lower() and len(d := unicodedata.normalize("NFD", c)) > 1 and d[0].isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    """Trims all white space; trim() knows the blank only."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def to_ascii(c: Column) -> Column:
    """Transliterates lower-case letters; other scripts stay."""
    c = F.translate(c, *accents())
    for letter, plain in SPECIAL.items():
        c = F.replace(c, F.lit(letter), F.lit(plain))
    return c


def _squeeze(c: Column) -> Column:
    return strip(F.regexp_replace(c, r"\s+", " "))


def _lowered(c: Column) -> Column:
    return F.lower(strip(F.coalesce(c.cast("string"), F.lit(""))))


def name(c: Column) -> Column:
    """Lower case, umlauts as two letters: Müller and Mueller agree."""
    c = _lowered(c)
    for letter, plain in (("ß", "ss"), ("ü", "ue"), ("ä", "ae"), ("ö", "oe")):
        c = F.replace(c, F.lit(letter), F.lit(plain))
    return _squeeze(to_ascii(c))


def name_plain(c: Column) -> Column:
    """Lower case, umlauts as their base letter: Müller and Muller agree."""
    return _squeeze(to_ascii(F.replace(_lowered(c), F.lit("ß"), F.lit("ss"))))


def second_name(c: Column) -> Column:
    return _lowered(c)


def postal_code(c: Column, null_as_blank: bool = True) -> Column:
    """Digits, padded and cut to five. Null is 00000, or null if not null_as_blank."""
    text = F.coalesce(c.cast("string"), F.lit("")) if null_as_blank else c.cast("string")
    return F.substring(F.lpad(F.regexp_replace(text, "[^0-9]", ""), 5, "0"), 1, 5)


def _without_number(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\s+[0-9]+[a-z]*\z", ""), r"^[0-9]+[a-z]*\s+", "")


def street(c: Column) -> Column:
    """Suffixes as patterns, one after the other (a dot stands for any character)."""
    c = _lowered(c)
    for old, new in SUFFIXES:
        c = F.regexp_replace(c, old + r"\z", new)
    c = to_ascii(_without_number(c))
    return _squeeze(F.regexp_replace(c, r"[^a-z\s]", ""))


def street_literal(c: Column) -> Column:
    """Suffixes as text, the first that fits; null stays null. Blanks are squeezed before signs go."""

    def suffixed(c: Column) -> Column:
        out = c
        for old, new in reversed(SUFFIXES):
            out = F.when(c.endswith(old), F.concat(F.substring(c, F.lit(1), F.length(c) - len(old)), F.lit(new))).otherwise(out)
        return out

    out = F.regexp_replace(to_ascii(_without_number(let(F.lower(strip(c.cast("string"))), suffixed))), r"\s+", " ")
    return strip(F.regexp_replace(out, r"[^a-z\s]", ""))


def year(c: Column) -> Column:
    """The first four digits in a row, as a number; null without."""
    return F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), "([0-9]{4})", 1).try_cast("int")


def effective_year(birthday: Column, birth_year: Column) -> Column:
    """The birthday's year unless it is missing or 0, else the birth year, which may be written 1998.0."""
    return F.coalesce(F.nullif(year(birthday), F.lit(0)), strip(birth_year.cast("string")).try_cast("double").try_cast("int"))


def reversed_name(c: Column) -> Column:
    return F.reverse(c)


def label(c: Column) -> Column:
    return F.upper(F.replace(c, F.lit("_"), F.lit(" ")))


def full_name(first: Column, last: Column) -> Column:
    return strip(F.concat_ws(" ", first, last))
