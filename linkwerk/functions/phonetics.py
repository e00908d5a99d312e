"""Cologne phonetics (Postel 1969) as one Column expression over the letters of a word."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import let, strip, to_ascii


def cologne(c: Column, split_hyphens: bool = True) -> Column:
    """Code of the first token; empty for blank or null."""
    word = F.split(strip(F.coalesce(c.cast("string"), F.lit(""))), r"[\s-]+" if split_hyphens else r"\s+", 2)[0]
    letters = F.regexp_replace(to_ascii(F.lower(word)), "[^a-z]", "")

    def code(at: Column, before: Column, after: Column) -> Column:
        hard = F.when(before == "", after.isin(*"ahkloqrux")).otherwise(after.isin(*"ahkoqux") & ~before.isin("s", "z"))
        return (
            F.when(at.isin(*"aeijouy"), "0")
            .when(at == "h", "")
            .when(at == "b", "1")
            .when(at == "p", F.when(after == "h", "3").otherwise("1"))
            .when(at.isin("d", "t"), F.when(after.isin("c", "s", "z"), "8").otherwise("2"))
            .when(at.isin("f", "v", "w"), "3")
            .when(at.isin("g", "k", "q"), "4")
            .when(at == "c", F.when(hard, "4").otherwise("8"))
            .when(at == "x", F.when(before.isin("c", "k", "q"), "8").otherwise("48"))
            .when(at == "l", "5")
            .when(at.isin("m", "n"), "6")
            .when(at == "r", "7")
            .when(at.isin("s", "z"), "8")
            .otherwise("")
        )

    def encoded(w: Column) -> Column:
        chars = F.concat(F.array(F.lit("")), F.split(w, ""), F.array(F.lit("")))
        codes = let(chars, lambda c: F.array_join(F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: code(c[i], c[i - 1], c[i + 1])), ""))
        once = F.regexp_replace(codes, r"(.)\1+", "$1")
        kept = let(once, lambda x: F.concat(F.substring(x, 1, 1), F.replace(F.substring(x, F.lit(2), F.length(x)), F.lit("0"), F.lit(""))))
        return F.when(F.length(w) > 0, kept).otherwise("")

    return let(letters, encoded)
