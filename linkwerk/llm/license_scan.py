"""License scans by diagonal voting, in DataFrame functions only.

Texts and license templates are sequences of words. Every rolling three-word
gram of a text is hashed; those whose hash a template has are joined to the
template's places (hash and words), and each match votes for the diagonal
``place in text - place in template``. Votes are added up by diagonal, runs of
diagonals at most ``DRIFT`` apart are merged (a word more or less moves the
rest of a text to the next diagonal), and a merged run is a span of the license
if the template's grams found on it are a share of ``ENOUGH`` or more. The base
phrases are templates too, and a place of one is a diagonal with all its grams.

The templates are a fixed table of a few kilobytes, the only thing broadcast.
Rows are told apart by id and a hash of the text; equal rows are counted, taken
through together and returned as often as they came.

Defined results: null text counts as empty; texts without matches get no
places, empty labels and score 0; a null id is an id; an empty table gives an
empty result; extra columns are ignored. The score is the largest share of a
template's grams found on one merged run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared as sh

GRAM = 3
DRIFT = 2
ENOUGH = 0.8
TOKEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# fixed values: the base phrases
BASE = [("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc")]
# fixed values: wording of public licenses and of the notices that name them; 66 words at most
NOTICES = [
    ("agpl", "gnu affero general public license version"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by", "licensed under a creative commons attribution"),
    ("cc-by-nc-nd", "cc by nc nd"),
    ("cc-by-nc-sa", "cc by nc sa"),
    ("cc-by-nd", "cc by nd"),
    ("cc-by-sa", "cc by sa"),
    ("cc0", "cc0 1 0 universal"),
    ("epl-2", "eclipse public license version 2"),
    ("gpl", "licensed under the gnu general public license version"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license version"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mpl-2", "subject to the terms of the mozilla public license version 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def template_grams() -> list[tuple]:
    """(gram, template, its place, label, is base, number of grams) of all templates."""
    out = []
    for k, (label, text) in enumerate([*BASE, *NOTICES]):
        words = text.split()
        n = len(words) - GRAM + 1
        out += [(" ".join(words[i : i + GRAM]), k, i, label, k < len(BASE), n) for i in range(n)]
    return out


def _gram_hash(*words: str) -> int:
    """What xxhash64() makes of the words."""
    from xxhash import xxh64_intdigest

    h = 42
    for w in words:
        h = xxh64_intdigest(w.encode(), h)
    return h - (1 << 64) if h >> 63 else h


def _matches(text: Column) -> Column:
    """Struct of the number of words and the places and words of all grams that a template has."""
    known = sorted({_gram_hash(*g[0].split()) for g in template_grams()})

    def of(w: Column) -> Column:
        def found(low: Column) -> Column:
            at = F.filter(F.sequence(F.lit(1), F.size(low) - GRAM + 1), lambda i: F.xxhash64(*(low[i + k] for k in range(-1, GRAM - 1))).isin(known))
            return F.transform(at, lambda i: F.struct((i - 1).cast("long").alias("place"), sh.lower_ascii(F.array_join(F.slice(w, i, GRAM), " ")).alias("gram")))

        none = F.array().cast("array<struct<place: bigint, gram: string>>")
        # lower() may fold more than A-Z: a superset, which the join on the gram's own words corrects
        hits = F.when(F.size(w) >= GRAM, sh.let(F.transform(w, F.lower), found)).otherwise(none)
        return F.struct(F.size(w).cast("long").alias("n_words"), hits.alias("hits"))

    return sh.let(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), of)


def scan(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_spans), one row per row of ``df``."""
    body = F.coalesce(F.col(text), F.lit(""))
    own = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col), body).alias("row"), _matches(body).alias("m"))
    grams = own.select("doc_id", "row", F.col("m.n_words").alias("n_words"), F.explode_outer("m.hits").alias("hit"))
    table = df.sparkSession.createDataFrame(template_grams(), "gram string, template int, at int, label string, base boolean, n int")
    votes = grams.join(F.broadcast(table), F.col("hit.gram") == F.col("gram"), "left")
    key = ["doc_id", "row", "n_words"]
    diagonal = (F.col("hit.place") - F.col("at")).alias("diagonal")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))
    # a matched gram of equal rows occurs once per row on its diagonal
    places = votes.groupBy(*key, "template", "label", "base", "n", diagonal, bit.alias("bit")).agg(F.count("*").alias("copies"))
    lines = places.groupBy(*key, "template", "label", "base", "n", "diagonal").agg(F.bit_or("bit").alias("bits"), F.max("copies").alias("copies"))
    in_order = Window.partitionBy("doc_id", "row", "template").orderBy("diagonal")
    lines = lines.withColumn("run", F.sum(F.when(F.col("diagonal") - F.lag("diagonal").over(in_order) <= DRIFT, 0).otherwise(1)).over(in_order))
    whole = F.col("base") & (F.bit_count("bits") == F.col("n"))
    runs = lines.groupBy(*key, "template", "label", "base", "n", "run").agg(
        F.max("copies").alias("copies"),
        F.bit_count(F.bit_or("bits")).alias("found"),
        F.count_if(whole).alias("whole"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first"),
        F.max(F.when(whole, F.col("diagonal"))).alias("last"),
    )
    share = F.col("found") / F.col("n")
    span = F.when(F.col("base"), F.col("whole") > 0).otherwise(share >= ENOUGH)
    say = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    out = runs.groupBy(*key).agg(
        F.max("copies").alias("copies"),
        F.coalesce(F.sum("whole"), F.lit(0)).alias("n_base"),
        F.min("first").alias("first_word"),
        F.max("last").alias("last_word"),
        say(F.when(F.col("whole") > 0, F.col("label"))).alias("base_labels"),
        say(F.when(span, F.col("label"))).alias("labels"),
        F.coalesce(F.max(share), F.lit(0.0)).alias("score"),
        F.count_if(span & ~F.col("base")).alias("n_spans"),
    )
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_spans", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")


def op1_license_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query: all ``documents``."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    rows = ", ".join(f"('{g}', {t}, {at}, '{label}', {str(base).lower()}, {n})" for g, t, at, label, base, n in template_grams())
    return rf"""
WITH t(gram, template, spot, label, base, n) AS (VALUES {rows}),
d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT rid, i - 1 AS place, array_to_string(w[i:i + 2], ' ') AS gram FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
v AS (SELECT DISTINCT rid, template, label, base, n, place - spot AS diagonal, spot FROM g JOIN t ON g.gram = t.gram),
l AS (SELECT rid, template, label, base, n, diagonal, count(*) AS c FROM v GROUP BY ALL),
r AS (SELECT *, sum(CASE WHEN gap <= {DRIFT} THEN 0 ELSE 1 END) OVER (PARTITION BY rid, template ORDER BY diagonal) AS run
      FROM (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) AS gap FROM l)),
f AS (SELECT r.rid, r.template, r.run, count(DISTINCT v.spot) AS found FROM r JOIN v ON r.rid = v.rid AND r.template = v.template AND r.diagonal = v.diagonal GROUP BY ALL),
u AS (SELECT r.rid, r.template, r.label, r.base, r.n, r.run, f.found, count(*) FILTER (WHERE r.base AND r.c = r.n) AS whole,
        min(r.diagonal) FILTER (WHERE r.base AND r.c = r.n) AS first_, max(r.diagonal) FILTER (WHERE r.base AND r.c = r.n) AS last_
      FROM r JOIN f ON r.rid = f.rid AND r.template = f.template AND r.run = f.run GROUP BY ALL),
s AS (SELECT *, found / n AS share, CASE WHEN base THEN whole > 0 ELSE found / n >= {ENOUGH} END AS span FROM u),
o AS (SELECT rid, sum(whole)::BIGINT AS n_base, min(first_)::BIGINT AS first_word, max(last_)::BIGINT AS last_word,
        coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE whole > 0), '') AS base_labels, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE span), '') AS labels,
        max(share) AS score, (count(*) FILTER (WHERE span AND NOT base))::BIGINT AS n_spans FROM s GROUP BY rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score, coalesce(n_spans, 0)::BIGINT AS n_spans
FROM d LEFT JOIN o ON d.rid = o.rid
"""


SQL = _sql()
