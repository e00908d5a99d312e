"""Matching plans: exact, fuzzy and phonetic pairs as joins over record features.

Everything that a pair needs is computed once per record; pairs come from hash
joins whose keys carry the rules that are equalities: block and chunk, the
effective year (null-safe, rows of year 0 left out) and, for exact pairs, both
names as an unordered pair. Similar pairs come from ``tiles``, the only Python;
the rules that are no equalities are applied to what it finds.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names
from ..functions.phonetics import cologne
from ..storage import cut
from . import blocking, tiles

ADDRESS = ["Strasse", "HausNummer", "Plz", "Ort"]
BLOCK = ["block_key", "chunk_no", "year"]
PHONETIC_FLOOR, PHONETIC_SCORE = 0.60, 0.72
DETAILS = "struct<address_ratio:double,address_matches:int,total_address_fields:int,normal_score:double,swapped_score:double,best_score:double,is_swapped:boolean,phonetic_assisted:boolean>"


@dataclass(frozen=True)
class Settings:
    fuzzy: float = 0.8
    confidence: float = 70.0
    chunk: int | None = blocking.CHUNK
    blank_plz: str = "reference"
    phonetic_blocks: bool = True
    split_hyphens: bool = True


def features(df: DataFrame, s: Settings = Settings()) -> DataFrame:
    """row_id and what the blocked plan compares: b, chunk_no, year, v, n, last, second, a1..a4, pv, pn."""
    keyed = blocking.chunked(df.withColumn("block_key", blocking.blocking_key(s.blank_plz, s.phonetic_blocks)), s.chunk)
    address = [F.lower(names.strip(F.coalesce(F.col(c), F.lit("none")))).alias(f"a{k}") for k, c in enumerate(ADDRESS)]
    out = keyed.select(
        "row_id",
        "block_key",
        "chunk_no",
        names.effective_year(F.col("Geburtstag"), F.col("Jahrgang")).alias("year"),
        names.name(F.col("Vorname")).alias("v"),
        names.name(F.col("Name")).alias("n"),
        names.second_name(F.col("Name")).alias("last"),
        names.second_name(F.col("Name2")).alias("second"),
        *address,
        cologne(F.col("Vorname"), s.split_hyphens).alias("pv"),
        cologne(F.col("Name"), s.split_hyphens).alias("pn"),
    )
    return out.where(F.col("year").isNull() | (F.col("year") != 0))


def _sides(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(df.select(*(F.col(c).alias(f"{side}_{c}") for c in df.columns)) for side in ("a", "b"))


def _pairs(df: DataFrame, *keys: str, extra: Column | None = None) -> DataFrame:
    """Pairs a before b that agree on ``keys`` and, nulls alike, on the year."""
    a, b = _sides(df)
    on = [F.col("a_year").eqNullSafe(F.col("b_year")), F.col("a_row_id") < F.col("b_row_id"), *(F.col(f"a_{k}") == F.col(f"b_{k}") for k in keys)]
    return a.join(b, reduce(Column.__and__, on if extra is None else [*on, extra]))


def second_name_rule() -> Column:
    """Both set: equal. One set: it ends the other's last name. None set: passes."""
    a, b = F.col("a_second"), F.col("b_second")
    return F.when((a != "") & (b != ""), a == b).when((a == "") & (b == ""), True).when(a != "", F.col("b_last").endswith(a)).otherwise(F.col("a_last").endswith(b))


def second_name_rule_plain() -> Column:
    a, b = F.col("a_second"), F.col("b_second")
    return (a == "") | (b == "") | (a == b)


def _sum(flags) -> Column:
    return reduce(Column.__add__, [F.when(f, 1).otherwise(0) for f in flags])


def address_scores(nulls_compare: bool = True) -> list[Column]:
    """matches, fields and ratio. Empty fields are left out; or, not nulls_compare, only null ones."""
    both = [(F.col(f"a_a{k}"), F.col(f"b_a{k}")) for k in range(len(ADDRESS))]
    counts = [(a != "") & (b != "") if nulls_compare else a.isNotNull() & b.isNotNull() for a, b in both]
    total, same = _sum(counts), _sum([c & (a == b) for c, (a, b) in zip(counts, both, strict=True)])
    return [same.alias("address_matches"), total.alias("total_address_fields"), (same / F.greatest(total, F.lit(1))).alias("address_ratio")]


def _result(kind: Column, confidence: Column, scored: bool, assisted: Column | None = None) -> list[Column]:
    null = lambda t: F.lit(None).cast(t)
    more = [F.col(c) if scored else null(t) for c, t in (("normal_score", "double"), ("swapped_score", "double"), ("best_score", "double"), ("is_swapped", "boolean"))]
    details = F.struct("address_ratio", "address_matches", "total_address_fields", *more, assisted if assisted is not None else null("boolean")).cast(DETAILS)
    return [F.col("a_row_id").alias("record_a"), F.col("b_row_id").alias("record_b"), confidence.alias("confidence"), kind.alias("match_type"), details.alias("details")]


def exact(feats: DataFrame) -> DataFrame:
    """Equal names in either order; the address only scores and no threshold applies."""
    named = feats.where("v <> '' and n <> ''").withColumns({"low": F.least("v", "n"), "high": F.greatest("v", "n")}).drop("pv", "pn")
    pairs = _pairs(named, "block_key", "chunk_no", "low", "high", extra=second_name_rule()).select("*", *address_scores())
    normal = (F.col("a_v") == F.col("b_v")) & (F.col("a_n") == F.col("b_n"))
    confidence = F.when(normal, F.lit(90.0)).otherwise(F.lit(85.0)) + F.col("address_ratio") * 10
    return pairs.select(*_result(F.when(normal, "exact_normal").otherwise("exact_swapped"), confidence, False))


def unmatched(feats: DataFrame, matches: DataFrame) -> DataFrame:
    taken = matches.select(F.explode(F.array("record_a", "record_b")).alias("row_id")).distinct()
    return feats.join(taken, "row_id", "left_anti")


def fuzzy(feats: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Similar names, or less similar ones that sound alike, from the confidence threshold on."""
    named = feats.where("v <> '' and n <> ''") if s.fuzzy > 0 else feats
    pairs = tiles.within(named, BLOCK, named.columns, min(PHONETIC_FLOOR, s.fuzzy)).where(second_name_rule()).select("*", *address_scores())
    filled = reduce(Column.__and__, [F.col(f"{x}_{p}") != "" for x in "ab" for p in ("pv", "pn")])
    alike = filled & (F.col("a_pv") == F.col("b_pv")) & (F.col("a_pn") == F.col("b_pn"))
    turned = filled & (F.col("a_pv") == F.col("b_pn")) & (F.col("a_pn") == F.col("b_pv"))
    r, t = F.col("address_ratio"), s.confidence
    pairs = pairs.withColumns({"alike": alike, "turned": turned, "best_score": F.greatest("normal_score", "swapped_score")})
    by_sound = (F.col("best_score") < s.fuzzy) & (F.col("best_score") >= PHONETIC_FLOOR) & (F.col("alike") | F.col("turned"))
    pairs = pairs.withColumn("assisted", by_sound).where((F.col("best_score") >= s.fuzzy) | F.col("assisted"))
    swapped = F.when(F.col("assisted"), F.col("turned")).otherwise(F.col("is_swapped"))
    plain = F.col("best_score") * 50 + r * 30
    confidence = F.when(F.col("assisted"), F.when(swapped, 70.0).otherwise(72.0) + r * 10).otherwise(F.when(swapped, plain - 5).otherwise(plain))
    kind = F.concat(F.when(F.col("assisted"), "phonetic_assisted").otherwise("fuzzy"), F.when(swapped, "_swapped").otherwise("_normal"))
    pairs = pairs.withColumns({"confidence": F.least(confidence, F.lit(95.0)), "kind": kind, "is_swapped": swapped, "best_score": F.when(F.col("assisted"), PHONETIC_SCORE).otherwise(F.col("best_score"))})
    assisted = F.when(F.col("assisted"), True)
    return pairs.where(F.col("confidence") >= t).select(*_result(F.col("kind"), F.col("confidence"), True, assisted))


def blocked_two_stage(df: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The default plan: exact pairs, then fuzzy pairs among records that have none."""
    feats = cut(features(df, s))
    first = cut(exact(feats))
    return first.unionByName(fuzzy(unmatched(feats, first), s))


def _plain_features(df: DataFrame) -> DataFrame:
    raw = lambda c: names.strip(F.col(c))
    out = df.select(
        "row_id",
        *([F.col("block_key")] if "block_key" in df.columns else []),
        names.effective_year(F.col("Geburtstag"), F.col("Jahrgang")).alias("year"),
        names.name_plain(F.col("Vorname")).alias("v"),
        names.name_plain(F.col("Name")).alias("n"),
        names.second_name(F.col("Name2")).alias("second"),
        raw("Vorname").alias("rv"),
        raw("Name").alias("rn"),
        *(raw(c).alias(f"a{k}") for k, c in enumerate(ADDRESS)),
        F.coalesce(raw("Plz"), F.lit("nan")).alias("plz"),
    )
    return out.where(F.col("year").isNull() | (F.col("year") != 0))


_RAW = ["rv", "rn", *(f"a{k}" for k in range(len(ADDRESS)))]


def _all_equal() -> Column:
    """Some field is set on both sides and all that are agree."""
    both = [(F.col(f"a_{c}"), F.col(f"b_{c}")) for c in _RAW]
    set_ = [a.isNotNull() & b.isNotNull() for a, b in both]
    return reduce(Column.__or__, set_) & reduce(Column.__and__, [~s | (a == b) for s, (a, b) in zip(set_, both, strict=True)])


def _plain_exact(pairs: DataFrame) -> DataFrame:
    return pairs.select("*", *address_scores(False)).select(*_result(F.lit("exact"), F.lit(100.0), False))


def _plain_fuzzy(pairs: DataFrame, s: Settings) -> DataFrame:
    pairs = pairs.select("*", *address_scores(False)).withColumn("best_score", F.greatest("normal_score", "swapped_score"))
    confidence = F.least(F.col("best_score") * 50 + F.col("address_ratio") * 30 + F.when(F.col("is_swapped"), 10).otherwise(0), F.lit(95.0))
    kind = F.when(F.col("is_swapped"), "fuzzy_swapped").otherwise("fuzzy_normal")
    return pairs.withColumn("confidence", confidence).where(F.col("confidence") >= s.confidence).select(*_result(kind, F.col("confidence"), True))


def _equal_pairs(feats: DataFrame, rule: Column) -> DataFrame:
    """Pairs whose raw fields agree wherever both are set, some field at least.

    Each record goes by the hash of its fields in every set of fields that it
    has in common with some record (64 sets at most), and a pair meets in the
    set of the fields that both have.
    """
    mask = reduce(Column.__add__, [F.when(F.col(c).isNotNull(), 1 << k).otherwise(0) for k, c in enumerate(_RAW)])
    feats = feats.withColumn("mask", mask)
    there = sorted(r[0] for r in feats.select("mask").distinct().collect())  # 64 at most
    common = sorted({x & y for x in there for y in there} - {0})
    held = F.filter(F.array(*map(F.lit, common)) if common else F.array().cast("array<int>"), lambda c: c.bitwiseAND(F.col("mask")) == c)
    keyed = feats.withColumn("fields", F.explode(held))
    keyed = keyed.withColumn("same", F.xxhash64("fields", *(F.when(F.col("fields").bitwiseAND(F.lit(1 << k)) != 0, F.col(c)) for k, c in enumerate(_RAW))))
    a, b = _sides(keyed)
    on = (F.col("a_fields") == F.col("b_fields")) & (F.col("a_same") == F.col("b_same")) & (F.col("a_mask").bitwiseAND(F.col("b_mask")) == F.col("a_fields"))
    return a.join(b, on & rule & _all_equal())


def global_two_stage(df: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Without blocks: equal raw fields, then similar names with compatible postal codes.

    A blank code fits any. Records with one are compared with all of their year.
    """
    feats = cut(_plain_features(df))
    rule = second_name_rule_plain() & F.col("a_year").eqNullSafe(F.col("b_year")) & (F.col("a_row_id") < F.col("b_row_id"))
    pairs = _equal_pairs(feats, rule)
    first = cut(_plain_exact(pairs if s.confidence <= 100 else pairs.where(F.lit(False))))
    rest = cut(unmatched(feats, first))
    equal = tiles.within(rest, ["plz", "year"], rest.columns, s.fuzzy)
    blank = tiles.across(rest.where("plz = ''"), rest.where("plz <> ''"), ["year"], rest.columns, s.fuzzy)
    return first.unionByName(_plain_fuzzy(equal.unionByName(blank).where(second_name_rule_plain()), s))


def blocked_single_stage(df: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Within blocks: a pair is exact, or else compared by similarity."""
    feats = cut(_plain_features(df.withColumn("block_key", blocking.blocking_key_literal())))
    rule = second_name_rule_plain() & F.col("a_year").eqNullSafe(F.col("b_year")) & (F.col("a_row_id") < F.col("b_row_id"))
    equal = _equal_pairs(feats, rule & (F.col("a_block_key") == F.col("b_block_key")))
    similar = tiles.within(feats, ["block_key", "year"], feats.columns, s.fuzzy).where(second_name_rule_plain())
    if s.confidence > 100:  # none is exact
        return _plain_fuzzy(similar, s)
    return _plain_exact(equal).unionByName(_plain_fuzzy(similar.where(~_all_equal()), s))
