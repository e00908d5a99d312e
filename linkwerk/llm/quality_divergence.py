"""Quality rules by divergence from language references, in DataFrame functions only.

Two histograms describe a document: its characters over ``CLASSES`` and its
words over the common words of some languages (and all others). The reference
of a language is the mean histogram of the documents labelled with it; the mean
of a language without such documents does not exist. A document's divergence is
the Jensen-Shannon distance (base 2, 0 to 1) to the closest reference. It is
rejected if the character distance exceeds ``MOST_CHARS`` and the document has
``MIN_CHARS`` characters or more, or the word distance exceeds ``MOST_WORDS``
and it has ``MIN_WORDS`` words or more: short texts stray by chance. The stage
for training data (``keep``) also rejects texts of ``LEAST_WORDS`` words or more
beyond ``MOST_SHORT``; the contract query keeps to the rule of its SQL.

The languages of ``COMMON`` are references for all documents. Any other label,
null included, is one for the documents that carry it, so that a language
without common words here is held against itself.

The base rules count words in repeated three-word windows. A sort of hashes,
cut to leave room for their places, brings equal windows together; neighbours
of equal hash are compared word by word, and a text in which two such windows
differ is counted again by a sort of the windows' words. The count is exact.

``judge`` computes features once, row by row, and checkpoints them (some
hundred bytes a document); ``keep`` reads texts twice, for the histograms of
the references and for the verdict. The references of ``COMMON`` reach the
driver, a row each; those of other labels stay a table, joined by label.

Defined results: null text has no words and fails the base rules; a label whose
documents have no words is no reference; rows are judged one by one, so repeated
rows repeat their result; an empty table gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared as sh

# fixed values: common words of each language
COMMON = {
    "en": ["the", "of", "and", "to", "in", "that", "is", "for", "it", "was", "with", "be", "on", "this"],
    "fr": ["le", "la", "les", "de", "des", "et", "en", "un", "que", "qui", "dans", "pour", "du", "au"],
    "de": ["der", "die", "das", "und", "in", "zu", "den", "mit", "von", "ist", "des", "ein", "eine", "im"],
    "es": ["el", "la", "los", "las", "de", "que", "y", "en", "un", "se", "del", "por", "con", "para"],
}
WORDS = sorted({w for own in COMMON.values() for w in own})
#: Java expressions of characters to drop, so that the class is what is left.
CLASSES = {"upper": "[^A-Z]+", "digit": "[^0-9]+", "stop": "[^.,;:!?'\"()-]+", "symbol": "[^#*$%&|<>@\\\\^_=+/~{}\\[\\]]+", "wide": "[\\x00-\\x7F]+"}
MIN_CHARS, MIN_WORDS = 200, 150
MOST_CHARS, MOST_WORDS = 0.30, 0.25
#: Most word distance of the stage for texts of LEAST_WORDS to MIN_WORDS words.
MOST_SHORT = 0.30
LEAST_WORDS, MOST_REPEATED = 50, 50


def _repeat_words(words: Column, spare: int = 0) -> Column:
    """Words in three-word windows that occur twice or more; ``spare``: bits of the hash left out, for tests."""
    at = lambda x, k: words[(x + k).cast("int")]  # noqa: E731  k-th word of the window at place x, from 1
    last = lambda c: F.greatest(F.size(c) - 1, F.lit(0))
    n = F.size(words) - 2
    bits = F.length(F.bin(n.cast("long"))) + spare
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n.cast("long")))) - 1

    def covered(places: Column) -> Column:
        """Words in the windows at ascending places."""
        step = lambda p: F.transform(p, lambda x, i: F.when(i == last(p), F.lit(3).cast("long")).otherwise(F.least(F.lit(3).cast("long"), p[F.least(i + 1, last(p))] - x)))
        return sh.let(places, lambda p: F.aggregate(step(p), F.lit(0).cast("long"), lambda a, x: a + x))

    def neighbours(sorted_: Column, same) -> Column:
        """Those of sorted values that are the same as the one before or after."""
        return F.filter(sorted_, lambda x, i: ((i > 0) & same(x, sorted_[F.greatest(i - 1, F.lit(0))])) | ((i < last(sorted_)) & same(x, sorted_[F.least(i + 1, last(sorted_))])))

    def by_hash(sorted_: Column) -> Column:
        kin = lambda x, y: F.call_function("shiftright", x.bitwiseXOR(y), bits) == 0

        def checked(again: Column) -> Column:
            place = lambda x: x.bitwiseAND(mask)
            differ = lambda x, y: (at(place(x), -1) != at(place(y), -1)) | (at(place(x), 0) != at(place(y), 0)) | (at(place(x), 1) != at(place(y), 1))
            wrong = F.filter(again, lambda x, i: (i > 0) & kin(x, again[F.greatest(i - 1, F.lit(0))]) & differ(x, again[F.greatest(i - 1, F.lit(0))]))
            return F.when(F.size(wrong) > 0, by_words()).otherwise(covered(F.sort_array(F.transform(again, place))))

        return sh.let(neighbours(sorted_, kin), checked)

    def by_words() -> Column:
        own = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(F.array_join(F.slice(words, i, 3), " ").alias("w"), i.cast("long").alias("i")))
        return sh.let(F.sort_array(own), lambda s: covered(F.sort_array(F.transform(neighbours(s, lambda x, y: x["w"] == y["w"]), lambda x: x["i"]))))

    hashed = F.transform(F.sequence(F.lit(1), n), lambda i: F.call_function("shiftleft", F.xxhash64(words[i - 1], words[i], words[i + 1]), bits).bitwiseOR(i.cast("long")))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(sh.let(F.sort_array(hashed), by_hash))


def _dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return sh.let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def _left(text: Column, drop: str) -> Column:
    return F.length(F.regexp_replace(text, drop, ""))


def features(text: Column, repeats: bool = True, base: bool = True) -> Column:
    """Struct of all counts of a text, in one pass over its words."""
    body = F.coalesce(text, F.lit(""))

    def of(w: Column) -> Column:
        chars = F.length(F.array_join(w, "")).cast("long")
        common = F.filter(F.transform(w, lambda x: F.lower(F.rtrim(x, F.lit(".,;:!?")))), lambda x: x.isin(WORDS))
        counted = sh.let(common, lambda c: F.array(*(F.size(c) - F.size(F.array_remove(c, own)) for own in WORDS)))
        own = [
            F.size(w).cast("long").alias("n_words"),
            chars.alias("word_chars"),
            F.length(body).alias("n_chars"),
            F.array(*(_left(body, drop) for drop in CLASSES.values())).alias("classes"),
            counted.alias("common"),
        ]
        if repeats:
            own += [_repeat_words(w).alias("n_repeat_words")]
        if base:
            own += [_left(body, "[^#*$%&|<>]+").cast("long").alias("n_symbols"), _dup_lines(body).alias("n_dup_lines")]
        return F.struct(*own)

    return sh.let(sh.words(body), of)


def _shares(f: Column) -> tuple[Column, Column]:
    """Both histograms of the features, as arrays of shares."""
    space = f["n_chars"] - f["word_chars"]
    total = lambda x: F.aggregate(x, F.lit(0), lambda a, y: a + y)
    chars = F.concat(f["classes"], F.array(space.cast("int"), (f["word_chars"] - total(f["classes"])).cast("int")))
    words = F.concat(f["common"], F.array((f["n_words"] - total(f["common"])).cast("int")))
    of = lambda x, n: sh.let(F.greatest(n, F.lit(1)), lambda m: F.transform(x, lambda c: c / m))
    return of(chars, f["n_chars"]), of(words, f["n_words"])


#: Labels besides COMMON up to which their references are broadcast.
FEW_LABELS = 1000
_SPLIT = len(CLASSES) + 2


def references(df: DataFrame, f: Column, lang: Column) -> tuple[dict[str, list[float]], DataFrame | None]:
    """Mean histograms, characters then words: of each language of COMMON, and a table (lang, ref) of other labels if there are any."""
    shares = sh.let(f, lambda x: F.when(x["n_words"] > 0, F.concat(*_shares(x))).otherwise(F.array().cast("array<double>")))
    means = df.select(lang.alias("lang"), F.posexplode(shares).alias("k", "p")).groupBy("lang", "k").agg(F.avg("p").alias("p"))
    refs = sh.cut(means.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "p"))), lambda x: x["p"]).alias("ref")))
    ours = {r.lang: r.ref for r in refs.where(F.col("lang").isin(list(COMMON))).orderBy("lang").collect()}
    rest = refs.where(~F.coalesce(F.col("lang").isin(list(COMMON)), F.lit(False)))
    n = rest.count()
    return ours, None if n == 0 else F.broadcast(rest) if n <= FEW_LABELS else rest


def _distance(own: Column, ref: Column) -> Column:
    """Jensen-Shannon distance, base 2."""
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(F.lit(0.0))
    both = F.zip_with(own, ref, lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    return F.sqrt(F.greatest(F.aggregate(both, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def distances(f: Column, ours: dict, ref: Column | None) -> tuple[Column, Column]:
    """Character and word distance to the closest reference, ``ref`` (null: none) among them; 0 without references."""
    cut = (lambda x: F.slice(x, 1, _SPLIT), lambda x: F.slice(x, _SPLIT + 1, len(WORDS) + 1))
    lists = [[F.array(*map(F.lit, r[:_SPLIT] if k == 0 else r[_SPLIT:])) for r in ours.values()] for k in (0, 1)]

    def closest(k: int):
        refs = lists[k] + ([cut[k](ref)] if ref is not None else [])
        return lambda own: F.coalesce(F.array_min(F.array(*(_distance(own, r) for r in refs))), F.lit(0.0)) if refs else F.lit(0.0)

    return tuple(sh.let(own, closest(k)) for k, own in enumerate(_shares(f)))


def base_failed(f: Column) -> Column:
    return (f["n_words"] < LEAST_WORDS) | (100 * f["n_repeat_words"] > MOST_REPEATED * f["n_words"])


def rejected(f: Column, ours: dict, ref: Column | None, short: bool = False) -> Column:
    chars, words = distances(f, ours, ref)
    strays = (f["n_words"] >= LEAST_WORDS) & (words > MOST_SHORT) if short else F.lit(False)
    return strays | base_failed(f) | ((f["n_chars"] >= MIN_CHARS) & (chars > MOST_CHARS)) | ((f["n_words"] >= MIN_WORDS) & (words > MOST_WORDS))


def _with_ref(df: DataFrame, lang: str, rest: DataFrame | None) -> tuple[DataFrame, Column | None]:
    """``df`` with the reference of each row's own label, and that column."""
    if rest is None:
        return df, None
    key, ref = (sh.fresh(c, df.columns) for c in ("label", "ref"))
    own = rest.select(F.col("lang").alias(key), F.col("ref").alias(ref))
    return df.join(own, F.col(lang).eqNullSafe(F.col(key)), "left"), F.col(ref)


def judge(df: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(doc_id, counts, base_failed, kept), one row per row of ``df``."""
    own = sh.cut(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"), features(F.col(text)).alias("f")))
    f = F.col("f")
    ours, rest = references(own, f, F.col("lang"))
    own, ref = _with_ref(own, "lang", rest)
    return own.select("doc_id", *(f[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), base_failed(f).alias("base_failed"), (~rejected(f, ours, ref)).alias("kept"))


def keep(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``df`` that pass."""
    ours, rest = references(df, features(F.col(text), repeats=False, base=False), F.col(lang))
    own, ref = _with_ref(df, lang, rest)
    return own.where(sh.let(features(F.col(text), base=False), lambda x: ~rejected(x, ours, ref, short=True))).select(*(F.col(f"`{c}`") for c in df.columns))


def op4_quality_divergence(spark, sf_dir: str) -> DataFrame:
    """Contract query: all ``documents``."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    drops = ", ".join(f"length(regexp_replace(text, '{drop.replace(chr(39), chr(39) * 2).replace(chr(92) * 2, chr(92)).replace('[' + chr(92) + 'x00-' + chr(92) + 'x7F]+', '[[:ascii:]]+')}', '', 'g'))" for drop in CLASSES.values())
    listed = ", ".join(f"'{w}'" for w in WORDS)
    langs = ", ".join(f"'{k}'" for k in COMMON)
    distance = lambda own, ref: f"sqrt(greatest(list_sum(list_transform(list_zip({own}, {ref}), lambda z: (CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0 END) + (CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) ELSE 0 END))) / 2, 0))"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
f AS (SELECT *, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(text) AS n_chars, length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, [{drops}] AS classes,
        list_filter(list_transform(w, lambda x: lower(regexp_replace(x, '[.,;:!?]+$', ''))), lambda x: list_contains([{listed}], x)) AS c FROM w),
g AS (SELECT rid, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) > 3),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w[i], w[i + 1], w[i + 2]) AS c FROM g) WHERE c > 1),
n AS (SELECT rid, count(DISTINCT j)::BIGINT AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM r) GROUP BY rid),
h AS (SELECT f.*, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, list_concat(classes, [n_chars - word_chars, word_chars - list_sum(classes)])::BIGINT[] AS hc,
        list_transform([{listed}], lambda k: len(list_filter(c, lambda x: x = k))) AS hw FROM f LEFT JOIN n ON f.rid = n.rid),
s AS (SELECT *, list_transform(hc, lambda x: x / greatest(n_chars, 1)) AS pc, list_transform(list_concat(hw, [n_words - list_sum(hw)])::BIGINT[], lambda x: x / greatest(n_words, 1)) AS pw FROM h),
e AS (SELECT lang, unnest(range(1, len(pc) + len(pw) + 1)) AS k, unnest(list_concat(pc, pw)) AS p FROM s WHERE n_words > 0),
m AS (SELECT lang, k, avg(p) AS p FROM e GROUP BY lang, k),
q AS (SELECT lang, list(p ORDER BY k) FILTER (WHERE k <= {len(CLASSES) + 2}) AS rc, list(p ORDER BY k) FILTER (WHERE k > {len(CLASSES) + 2}) AS rw FROM m GROUP BY lang),
j AS (SELECT s.rid, min({distance('pc', 'rc')}) AS dc, min({distance('pw', 'rw')}) AS dw FROM s JOIN q ON q.lang IN ({langs}) OR q.lang IS NOT DISTINCT FROM s.lang GROUP BY s.rid),
b AS (SELECT s.*, coalesce(dc, 0) AS dc, coalesce(dw, 0) AS dw, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed FROM s LEFT JOIN j ON s.rid = j.rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR (n_chars >= {MIN_CHARS} AND dc > {MOST_CHARS}) OR (n_words >= {MIN_WORDS} AND dw > {MOST_WORDS})) AS kept FROM b
"""


SQL = _sql()
