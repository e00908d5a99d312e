"""Queries over the driver's tables, one per operator, and the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import names
from .functions.phonetics import cologne
from .plans import blocking, matching, report, tiles
from .sources import records, sinks
from .storage import cut

#: Blocks stay whole, as in the SQL.
SETTINGS = matching.Settings(fuzzy=0.7, confidence=60.0, chunk=None)
CUT_OFF = "2024-01-15"
CLEANED = ["Vorname", "Name", "Name2", "Strasse", "HausNummer", "Plz", "Ort", "Geburtstag", "Jahrgang"]


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.from_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _per_record(*columns) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, d: _records(spark, d).select("row_id", *(make().alias(k) for k, make in columns))


def _blocks(spark: SparkSession, d: DataFrame) -> DataFrame:
    return blocking.chunked(_records(spark, d).withColumn("block_key", blocking.blocking_key()), 20)


def _scan(spark: SparkSession, d: str) -> DataFrame:
    events = spark.read.parquet(f"{d}/events.parquet")
    return records.settled(events.withColumn("Erfasst", F.col("ts")), F.lit(CUT_OFF).cast("timestamp")).select("event_id", "user_id", "event_type")


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    return matching._pairs(matching.features(_records(spark, d), SETTINGS), "block_key", "chunk_no")


def _ids(df: DataFrame, *more) -> DataFrame:
    return df.select(F.col("a_row_id").alias("record_a"), F.col("b_row_id").alias("record_b"), *more)


def _exact(spark: SparkSession, d: str) -> DataFrame:
    return matching.exact(matching.features(_records(spark, d), SETTINGS))


def _flat(m: DataFrame) -> DataFrame:
    scores = [F.round(f"details.{c}", 9).alias(c) for c in ("address_ratio", "normal_score", "swapped_score")]
    return m.select("record_a", "record_b", F.round("confidence", 9).alias("confidence"), "match_type", *scores)


def _all(spark: SparkSession, d: str) -> DataFrame:
    return matching.blocked_two_stage(_records(spark, d), SETTINGS)


def all_matches(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: all matches of the default plan."""
    return _flat(_all(spark, d))


def _similarity(spark: SparkSession, d: str) -> DataFrame:
    feats = cut(matching.features(_records(spark, d), SETTINGS).select("row_id", "block_key", "chunk_no", "year", "v", "n"))
    pairs = tiles.within(feats, matching.BLOCK, ["row_id"], digits=9)
    return _ids(pairs, "normal_score", "swapped_score", F.greatest("normal_score", "swapped_score").alias("best_score"), "is_swapped")


def _unmatched(spark: SparkSession, d: str) -> DataFrame:
    feats = matching.features(_records(spark, d), SETTINGS)
    return matching.unmatched(feats, matching.exact(feats)).select("row_id")


def _top(spark: SparkSession, d: str) -> DataFrame:
    return _flat(report.top(_all(spark, d), 10))


def _summary(spark: SparkSession, d: str) -> DataFrame:
    s = report.summary(_all(spark, d))
    return s.withColumn("mean_confidence", F.round("mean_confidence", 6))


def _export(spark: SparkSession, d: str) -> DataFrame:
    recs = _records(spark, d)
    return sinks.export_rows(matching.blocked_two_stage(recs, SETTINGS), recs).withColumn("confidence", F.round("confidence", 9))


def _export_wide(spark: SparkSession, d: str) -> DataFrame:
    recs = _records(spark, d)
    out = sinks.export_rows_wide(matching.blocked_two_stage(recs, SETTINGS), recs)
    return out.select("crefo1_crefo2", "record_position", F.round("confidence_score", 9).alias("confidence_score"), "match_type", "record_index", "name", "name_field", "strasse", "plz", F.round("name_similarity_normal", 9).alias("name_similarity_normal"), "is_swapped")


def _newest(spark: SparkSession, d: str) -> DataFrame:
    events = spark.read.parquet(f"{d}/events.parquet").withColumn("Erfasst", F.col("ts"))
    return records.newest(events, 100, "event_id").select("event_id", "event_type")


def _clean(spark: SparkSession, d: str) -> DataFrame:
    return records.clean(_records(spark, d)).select("row_id", *CLEANED)


def _recall(spark: SparkSession, d: str) -> DataFrame:
    """How many of the altered copies are found, by alteration: records 2k and 2k + 1 are expected to match."""
    expected = _records(spark, d).where("row_id % 2 = 0").select(F.col("row_id").alias("record_a"), (F.col("row_id") + 1).alias("record_b"), F.pmod(F.col("row_id") / 2, F.lit(24)).cast("int").alias("kind"))
    found = _all(spark, d).select("record_a", "record_b", F.lit(1).alias("found"))
    return expected.join(found, ["record_a", "record_b"], "left").groupBy("kind").agg(F.count("*").alias("n_expected"), F.count("found").alias("n_found"))


def _phonetic_blocks(spark: SparkSession, d: str) -> DataFrame:
    return _records(spark, d).select("row_id", blocking.blocking_key("null").alias("block_key"), blocking.blocking_key("null", False).alias("plain_key"))


def _unkeyed(spark: SparkSession, d: str) -> DataFrame:
    """Records numbered in the order of their fields."""
    return records.canonical(_records(spark, d).drop("row_id")).select("row_id", "Vorname", "Name", "Strasse", "Plz")


def _listing(spark: SparkSession, d: str) -> DataFrame:
    recs = cut(_records(spark, d))  # once, for the matches and for both names
    return report.listing(matching.blocked_two_stage(recs, SETTINGS), recs).withColumn("confidence", F.round("confidence", 9))


def _statistics(spark: SparkSession, d: str) -> DataFrame:
    keyed = _records(spark, d).withColumn("block_key", blocking.blocking_key())
    return blocking.statistics(keyed, 20).withColumn("mean_size", F.round("mean_size", 9))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    c = F.col
    return {
        "scan_project_filter": _scan,
        "normalize_name": _per_record(("vorname", lambda: names.name(c("Vorname"))), ("name", lambda: names.name(c("Name")))),
        "normalize_name_poc": _per_record(("vorname", lambda: names.name_plain(c("Vorname"))), ("name", lambda: names.name_plain(c("Name")))),
        "normalize_plz": _per_record(("plz", lambda: names.postal_code(c("Plz")))),
        "normalize_street": _per_record(("street", lambda: names.street(c("Strasse")))),
        "normalize_street_literal": _per_record(("street", lambda: names.street_literal(c("Strasse")))),
        "blocking_keys": _per_record(("block_key", lambda: blocking.blocking_key())),
        "phonetic_blocks": _phonetic_blocks,
        "newest_records": _newest,
        "clean_records": _clean,
        "sampled_records": lambda s, d: report.sample(_records(s, d), 100).select("row_id", "Vorname", "Name"),
        "numbered_records": _unkeyed,
        "block_statistics": _statistics,
        "listing": _listing,
        "filtered_matches": lambda s, d: _flat(report.only(_all(s, d), ["exact_swapped", "fuzzy_swapped", "phonetic_assisted_swapped", "exact_normal"], True, 80.0)),
        "recall_by_alteration": _recall,
        "block_sizes": lambda s, d: blocking.block_sizes(_blocks(s, d)),
        "block_chunks": lambda s, d: _blocks(s, d).select("row_id", "block_key", "chunk_no"),
        "comparison_reduction": lambda s, d: blocking.reduction(_blocks(s, d)).withColumn("saved_percent", F.round("saved_percent", 9)),
        "effective_year": _per_record(("year", lambda: names.effective_year(c("Geburtstag"), c("Jahrgang")))),
        "date_rule_pairs": lambda s, d: _candidates(s, d).groupBy(c("a_block_key").alias("block_key"), c("a_year").alias("year")).agg(F.count("*").alias("n_pairs")),
        "zweitname_pairs": lambda s, d: _ids(_candidates(s, d).where(matching.second_name_rule() & ((c("a_second") != "") | (c("b_second") != "")))),
        "address_ratio_pairs": lambda s, d: _candidates(s, d).select(c("a_block_key").alias("block_key"), *matching.address_scores()).groupBy("block_key", "address_matches", "total_address_fields").agg(F.count("*").alias("n_pairs")),
        "exact_matches": lambda s, d: _exact(s, d).select("record_a", "record_b", "confidence", "match_type"),
        "unmatched_records": _unmatched,
        "name_similarity": _similarity,
        "fuzzy_matches": lambda s, d: _flat(_all(s, d)).where(c("match_type").startswith("fuzzy")),
        "phonetic_codes": _per_record(("vorname_phon", lambda: cologne(c("Vorname"))), ("name_phon", lambda: cologne(c("Name")))),
        "phonetic_matches": lambda s, d: _flat(_all(s, d)).where(c("match_type").startswith("phonetic")),
        "all_matches": all_matches,
        "match_type_breakdown": lambda s, d: report.breakdown(_all(s, d)),
        "confidence_histogram": lambda s, d: report.histogram(_all(s, d)),
        "report_summary": _summary,
        "top_matches": _top,
        "export_rows": _export,
        "export_rows_wide": _export_wide,
        "poc_matches": lambda s, d: _flat(matching.global_two_stage(_records(s, d), SETTINGS)),
        "blocked_matches": lambda s, d: _flat(matching.blocked_single_stage(_records(s, d), SETTINGS)),
    }


# The same in SQL -----------------------------------------------------------


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _ascii(x: str) -> str:
    a, b = names.accents()
    x = f"translate({x}, '{a}', '{b}')"
    for letter, plain in names.SPECIAL.items():
        x = f"replace({x}, '{letter}', '{plain}')"
    return x


def _squeeze(x: str) -> str:
    return _strip(rf"regexp_replace({x}, '\s+', ' ', 'g')")


def _name(x: str, plain: bool = False) -> str:
    x = f"replace(lower({_strip(f'coalesce({x}, {chr(39) * 2})')}), 'ß', 'ss')"
    for a, b in [] if plain else [("ü", "ue"), ("ä", "ae"), ("ö", "oe")]:
        x = f"replace({x}, '{a}', '{b}')"
    return _squeeze(_ascii(x))


def _no_number(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '\s+[0-9]+[a-z]*$', ''), '^[0-9]+[a-z]*\s+', '')"


def _street(x: str) -> str:
    x = f"lower({_strip(x)})"
    for old, new in names.SUFFIXES:
        x = f"regexp_replace({x}, '{old}$', '{new}')"
    return _squeeze(rf"regexp_replace({_ascii(_no_number(x))}, '[^a-z\s]', '', 'g')")


def _street_literal(x: str) -> str:
    x = f"lower({_strip(x)})"
    cases = " ".join(f"WHEN ends_with({x}, '{old}') THEN left({x}, length({x}) - {len(old)}) || '{new}'" for old, new in names.SUFFIXES)
    out = _ascii(_no_number(f"CASE {cases} ELSE {x} END"))
    return _strip(rf"regexp_replace(regexp_replace({out}, '\s+', ' ', 'g'), '[^a-z\s]', '', 'g')")


def _plz(x: str) -> str:
    return f"left(lpad(regexp_replace({x}, '[^0-9]', '', 'g'), greatest(5, length(regexp_replace({x}, '[^0-9]', '', 'g'))::INT), '0'), 5)"


def _cologne(x: str) -> str:
    w = f"regexp_replace({_ascii(f'lower(regexp_extract({_strip(x)}, {chr(39)}^[^\\s-]*{chr(39)}))')}, '[^a-z]', '', 'g')"
    at, before, after = "w[i]", "CASE WHEN i > 1 THEN w[i - 1] ELSE '' END", "coalesce(w[i + 1], '')"
    one = lambda e, letters: f"{e} IN ({', '.join(repr(c) for c in letters)})"
    code = (
        f"CASE WHEN {one(at, 'aeijouy')} THEN '0' WHEN {at} = 'h' THEN '' WHEN {at} = 'b' THEN '1' WHEN {at} = 'p' THEN CASE WHEN {after} = 'h' THEN '3' ELSE '1' END"
        f" WHEN {one(at, 'dt')} THEN CASE WHEN {one(after, 'csz')} THEN '8' ELSE '2' END WHEN {one(at, 'fvw')} THEN '3' WHEN {one(at, 'gkq')} THEN '4'"
        f" WHEN {at} = 'c' THEN CASE WHEN i = 1 THEN CASE WHEN {one(after, 'ahkloqrux')} THEN '4' ELSE '8' END WHEN {one(after, 'ahkoqux')} AND NOT ({one('(' + before + ')', 'sz')}) THEN '4' ELSE '8' END"
        f" WHEN {at} = 'x' THEN CASE WHEN {one('(' + before + ')', 'ckq')} THEN '8' ELSE '48' END WHEN {at} = 'l' THEN '5' WHEN {one(at, 'mn')} THEN '6' WHEN {at} = 'r' THEN '7' WHEN {one(at, 'sz')} THEN '8' ELSE '' END"
    )
    let = lambda v, name, body: f"list_transform([{v}], lambda {name}: {body})[1]"
    codes = f"array_to_string(list_transform(range(1, length(w) + 1), lambda i: {code}), '')"
    once = "array_to_string(list_transform(range(1, length(s) + 1), lambda i: CASE WHEN i > 1 AND s[i] = s[i - 1] THEN '' ELSE s[i] END), '')"
    return let(w, "w", f"CASE WHEN w = '' THEN '' ELSE {let(codes, 's', let(once, 'u', 'left(u, 1) || replace(substr(u, 2), ' + chr(39) + '0' + chr(39) + ', ' + chr(39) * 2 + ')'))} END")


def _indel(a: str, b: str) -> str:
    codes = lambda x: f"list_transform(string_split({x}, ''), lambda c: [unicode(c)::BIGINT])"
    row = f"list_append(acc, CASE WHEN unicode(({b})[j[1]]) = x[1] THEN row_[j[1]] + 1 ELSE greatest(row_[j[1] + 1], acc[len(acc)]) END)"
    inner = f"list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j]), lambda acc, j: {row}, [0::BIGINT])"
    lcs = f"list_last(list_reduce({codes(a)}, lambda row_, x: {inner}, list_transform(range(0, length({b}) + 1), lambda z: 0::BIGINT)))"
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN 0.0::DOUBLE ELSE (1.0::DOUBLE - (length({a}) + length({b}) - 2 * {lcs})::DOUBLE / (length({a}) + length({b}))) * 100.0::DOUBLE / 100.0::DOUBLE END)"


def _ctes() -> dict[str, str]:
    """Named steps; each may use those before it."""
    blank, none = "coalesce({}, '')".format, "coalesce({}, 'none')".format
    year = "coalesce(nullif(try_cast(nullif(regexp_extract(Geburtstag, '([0-9]{4})', 1), '') AS INT), 0), trunc(try_cast(trim(Jahrgang) AS DOUBLE))::INT)"
    address = ["Strasse", "HausNummer", "Plz", "Ort"]
    sides = lambda cols: ", ".join(f"{s}.{c} AS {s}_{c}" for s in "ab" for c in cols)
    both = [f"a_a{k} <> '' AND b_a{k} <> ''" for k in range(4)]
    count = lambda extra: " + ".join(f"(CASE WHEN {b}{extra.format(k=k)} THEN 1 ELSE 0 END)" for k, b in enumerate(both))
    rule = "CASE WHEN a_second <> '' AND b_second <> '' THEN a_second = b_second WHEN a_second = '' AND b_second = '' THEN true WHEN a_second <> '' THEN ends_with(b_last, a_second) ELSE ends_with(a_last, b_second) END"
    cols = ["row_id", "block_key", "chunk_no", "year", "v", "n", "last", "second", "a0", "a1", "a2", "a3", "pv", "pn"]
    plain = ["row_id", "block_key", "year", "v", "n", "second", "rv", "rn", "a0", "a1", "a2", "a3", "plz"]
    scores = f"({_indel('a_v', 'b_v')} + {_indel('a_n', 'b_n')}) / 2 AS normal_score, ({_indel('a_v', 'b_n')} + {_indel('a_n', 'b_v')}) / 2 AS swapped_score"
    plain_same = " + ".join(f"(CASE WHEN a_a{k} = b_a{k} THEN 1 ELSE 0 END)" for k in range(4))
    plain_total = " + ".join(f"(CASE WHEN a_a{k} IS NOT NULL AND b_a{k} IS NOT NULL THEN 1 ELSE 0 END)" for k in range(4))
    plain_ratio = f"({plain_same})::DOUBLE / greatest({plain_total}, 1)"
    # names are always set, so some field is
    fields_equal = lambda a, b: " AND ".join(f"({a}{c} = {b}{c} OR {a}{c} IS NULL OR {b}{c} IS NULL)" for c in ("rv", "rn", "a0", "a1", "a2", "a3"))
    raw_equal = fields_equal("a_", "b_")
    plain_fuzzy = lambda src: (
        f"SELECT record_a, record_b, least(best * 50 + r * 30 + CASE WHEN sw THEN 10 ELSE 0 END, 95.0::DOUBLE) AS confidence, CASE WHEN sw THEN 'fuzzy_swapped' ELSE 'fuzzy_normal' END AS match_type, r AS address_ratio, normal_score, swapped_score FROM"
        f" (SELECT a_row_id AS record_a, b_row_id AS record_b, normal_score, swapped_score, greatest(normal_score, swapped_score) AS best, swapped_score > normal_score AS sw, {plain_ratio} AS r FROM (SELECT *, {scores} FROM {src}))"
        " WHERE best >= 0.7 AND least(best * 50 + r * 30 + CASE WHEN sw THEN 10 ELSE 0 END, 95.0::DOUBLE) >= 60"
    )
    plain_exact = lambda src: f"SELECT a_row_id AS record_a, b_row_id AS record_b, 100.0::DOUBLE AS confidence, 'exact' AS match_type, {plain_ratio} AS address_ratio, NULL::DOUBLE AS normal_score, NULL::DOUBLE AS swapped_score FROM {src} WHERE {raw_equal}"
    plain_rule = "a.year IS NOT DISTINCT FROM b.year AND a.row_id < b.row_id AND (a.second = '' OR b.second = '' OR a.second = b.second)"
    return {
        "w": r"""SELECT doc_id, lang, source, n, coalesce(w[n // 3 % greatest(n, 1) + 1], '') AS v, coalesce(w[n // 2 % greatest(n, 1) + 1], '') AS l, coalesce(w[n // 5 % greatest(n, 1) + 1], '') AS m, unnest([0, 1]) AS side,
          regexp_replace(coalesce(source, ''), '[^0-9]', '', 'g') AS number, doc_id % 24 AS kind FROM (SELECT *, len(w) AS n FROM (SELECT *, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents))""",
        "alt": """SELECT *, CASE WHEN side = 1 THEN kind ELSE -1 END AS alt, CASE WHEN side = 1 AND kind IN (3, 4, 15) THEN translate(v, 'aeo', 'eoa') ELSE v END AS f1,
          CASE WHEN side = 1 AND kind IN (3, 4) THEN translate(l, 'aeo', 'eoa') WHEN side = 1 AND kind = 2 THEN replace(l, 'e', 'a') WHEN side = 1 AND kind = 6 THEN l || '-' || m ELSE l END AS f2,
          (1950 + length(v) % 3)::VARCHAR AS born, (doc_id % 2 = 0) <> (side = 1 AND kind = 5) AS even FROM w""",
        "rec": """SELECT doc_id * 2 + side AS row_id, CASE WHEN alt IN (1, 4) THEN f2 ELSE f1 END AS Vorname, CASE WHEN alt IN (1, 4) THEN f1 ELSE f2 END AS Name,
          CASE WHEN alt = 6 THEN '' WHEN kind = 6 THEN m WHEN n % 4 = 0 THEN m WHEN n % 4 = 1 THEN NULL ELSE '' END AS Name2,
          CASE WHEN alt NOT IN (8, 13) THEN lang || ['str.', 'strasse', 'straße'][(doc_id + side) % 3 + 1] END AS Strasse, CASE WHEN alt <> 10 THEN number END AS HausNummer,
          CASE WHEN alt IN (9, 13) THEN NULL WHEN kind = 7 AND doc_id % 5 = 0 AND (side = 1 OR doc_id // 24 % 2 = 0) THEN '' ELSE (ascii(substr(lang, 2, 1)) * 10 + 1000 + length(source) * 1000 + coalesce(try_cast(number AS INT), 0) * 100 + n % 7)::VARCHAR END AS Plz, CASE WHEN alt <> 10 THEN lang END AS Ort,
          CASE WHEN side = 0 THEN CASE WHEN doc_id % 3 <> 0 THEN 'C' || doc_id END WHEN doc_id % 2 = 0 THEN 'K' || doc_id ELSE '' END AS Crefo,
          CASE WHEN kind = 12 OR alt = 11 THEN NULL WHEN alt = 14 THEN born || '-03-02' WHEN even THEN '01.01.' || born ELSE '' END AS Geburtstag,
          CASE WHEN kind = 12 THEN NULL WHEN alt = 11 THEN '0' WHEN alt = 14 OR even THEN '' ELSE born || '.0' END AS Jahrgang FROM alt""",
        "norm": f"SELECT *, {_name('Vorname')} AS v, {_name('Name')} AS n, {_plz(blank('Plz'))} AS plz5, {_street(blank('Strasse'))} AS street, {year} AS year, {_cologne('Vorname')} AS pv, {_cologne('Name')} AS pn FROM rec",
        "keyed": "SELECT *, CASE WHEN street <> '' THEN plz5 || '_' || street ELSE 'plz_only_' || plz5 END AS block_key FROM norm",
        "chunked": "SELECT *, ((row_number() OVER (PARTITION BY block_key ORDER BY row_id) - 1) // 20)::INT AS chunk20, 0 AS chunk_no FROM keyed",
        "f": f"SELECT row_id, block_key, chunk_no, year, v, n, lower({_strip('Name')}) AS last, lower({_strip(blank('Name2'))}) AS second, pv, pn, {', '.join(f'lower({_strip(none(c))}) AS a{k}' for k, c in enumerate(address))} FROM chunked WHERE year IS NULL OR year <> 0",
        "cand": f"SELECT {sides(cols)} FROM f a JOIN f b ON a.block_key = b.block_key AND a.chunk_no = b.chunk_no AND a.year IS NOT DISTINCT FROM b.year AND a.row_id < b.row_id",
        "ruled": f"SELECT *, {count('')} AS total, {count(' AND a_a{k} = b_a{k}')} AS same FROM cand WHERE {rule}",
        "ex": "SELECT a_row_id AS record_a, b_row_id AS record_b, CASE WHEN a_v = b_v AND a_n = b_n THEN 90.0::DOUBLE ELSE 85.0::DOUBLE END + same / greatest(total, 1) * 10 AS confidence, CASE WHEN a_v = b_v AND a_n = b_n THEN 'exact_normal' ELSE 'exact_swapped' END AS match_type, same / greatest(total, 1) AS address_ratio FROM ruled WHERE a_v <> '' AND a_n <> '' AND b_v <> '' AND b_n <> '' AND ((a_v = b_v AND a_n = b_n) OR (a_v = b_n AND a_n = b_v))",
        "taken": "SELECT record_a AS row_id FROM ex UNION SELECT record_b FROM ex",
        "sc": f"SELECT *, {scores}, same / greatest(total, 1) AS r, a_pv <> '' AND a_pn <> '' AND b_pv <> '' AND b_pn <> '' AND a_pv = b_pv AND a_pn = b_pn AS alike, a_pv <> '' AND a_pn <> '' AND b_pv <> '' AND b_pn <> '' AND a_pv = b_pn AND a_pn = b_pv AS turned FROM ruled WHERE a_v <> '' AND a_n <> '' AND b_v <> '' AND b_n <> '' AND a_row_id NOT IN (SELECT row_id FROM taken) AND b_row_id NOT IN (SELECT row_id FROM taken)",
        "be": "SELECT *, greatest(normal_score, swapped_score) AS best, greatest(normal_score, swapped_score) < 0.7 AS low FROM sc WHERE greatest(normal_score, swapped_score) >= 0.7 OR (greatest(normal_score, swapped_score) >= 0.6 AND (alike OR turned))",
        "co": "SELECT *, CASE WHEN low THEN turned ELSE swapped_score > normal_score END AS sw FROM be",
        "fu": "SELECT a_row_id AS record_a, b_row_id AS record_b, least(CASE WHEN low THEN CASE WHEN sw THEN 70.0::DOUBLE ELSE 72.0::DOUBLE END + r * 10 WHEN sw THEN best * 50 + r * 30 - 5 ELSE best * 50 + r * 30 END, 95.0::DOUBLE) AS confidence, CASE WHEN low THEN 'phonetic_assisted' ELSE 'fuzzy' END || CASE WHEN sw THEN '_swapped' ELSE '_normal' END AS match_type, r AS address_ratio, normal_score, swapped_score FROM co",
        "m": "SELECT record_a, record_b, confidence, match_type, address_ratio, NULL::DOUBLE AS normal_score, NULL::DOUBLE AS swapped_score FROM ex UNION ALL SELECT * FROM fu WHERE confidence >= 60",
        "pf": f"SELECT row_id, year, {_name('Vorname', True)} AS v, {_name('Name', True)} AS n, lower({_strip(blank('Name2'))}) AS second, {_strip('Vorname')} AS rv, {_strip('Name')} AS rn, {', '.join(f'{_strip(c)} AS a{k}' for k, c in enumerate(address))}, coalesce({_strip('Plz')}, 'nan') AS plz, CASE WHEN p <> '' AND t <> '' THEN p || '_' || t WHEN p <> '' THEN 'plz_only_' || p WHEN t <> '' THEN 'street_only_' || t ELSE 'no_address' END AS block_key FROM (SELECT *, {_plz('Plz')} AS p, {_street_literal('Strasse')} AS t FROM norm) WHERE year IS NULL OR year <> 0",
        "pe": f"SELECT {sides(plain)} FROM pf a JOIN pf b ON {plain_rule} AND a.rv = b.rv AND a.rn = b.rn AND {fields_equal('a.', 'b.')}",
        "pt": "SELECT a_row_id AS row_id FROM pe UNION SELECT b_row_id FROM pe",
        "pc": f"SELECT {sides(plain)} FROM pf a JOIN pf b ON {plain_rule} AND (a.plz = b.plz OR a.plz = '' OR b.plz = '') WHERE a.row_id NOT IN (SELECT row_id FROM pt) AND b.row_id NOT IN (SELECT row_id FROM pt)",
        "pm": f"{plain_exact('pe')} UNION ALL {plain_fuzzy('pc')}",
        "bc": f"SELECT {sides(plain)} FROM pf a JOIN pf b ON a.block_key = b.block_key AND {plain_rule}",
        "bf": f"SELECT * FROM bc WHERE NOT ({raw_equal})",
        "bm": f"{plain_exact('bc')} UNION ALL {plain_fuzzy('bf')}",
    }


_NEEDS = {"w": [], "alt": ["w"], "rec": ["alt"], "norm": ["rec"], "keyed": ["norm"], "chunked": ["keyed"], "f": ["chunked"], "cand": ["f"], "ruled": ["cand"], "ex": ["ruled"], "taken": ["ex"], "sc": ["ruled", "taken"], "be": ["sc"], "co": ["be"], "fu": ["co"], "m": ["ex", "fu"], "pf": ["norm"], "pe": ["pf"], "pt": ["pe"], "pc": ["pf", "pt"], "pm": ["pe", "pc"], "bc": ["pf"], "bf": ["bc"], "bm": ["bc", "bf"]}


def oracle_sql() -> dict[str, str]:
    steps = _ctes()

    def of(last: str, body: str) -> str:
        wanted, todo = set(), [last]
        while todo:
            wanted.add(k := todo.pop())
            todo += _NEEDS[k]
        return "WITH " + ", ".join(f"{k} AS (SELECT * FROM ({v}))" for k, v in steps.items() if k in wanted) + f" {body}"

    flat = "SELECT record_a, record_b, round(confidence, 9) AS confidence, match_type, round(address_ratio, 9) AS address_ratio, round(normal_score, 9) AS normal_score, round(swapped_score, 9) AS swapped_score FROM "
    best = "SELECT a_row_id AS record_a, b_row_id AS record_b, normal_score, swapped_score, greatest(normal_score, swapped_score) AS best_score, swapped_score > normal_score AS is_swapped FROM (SELECT a_row_id, b_row_id, " + f"({_indel('a_v', 'b_v')} + {_indel('a_n', 'b_n')}) / 2 AS normal_score, ({_indel('a_v', 'b_n')} + {_indel('a_n', 'b_v')}) / 2 AS swapped_score FROM cand)"
    named = "(SELECT m.*, CASE WHEN x.Crefo <> '' AND y.Crefo <> '' THEN x.Crefo || '_' || y.Crefo ELSE record_a || '_' || record_b END AS pair FROM m JOIN rec x ON record_a = x.row_id JOIN rec y ON record_b = y.row_id)"
    rows = f"FROM (SELECT *, 'A' AS position, record_a AS idx FROM {named} UNION ALL SELECT *, 'B', record_b FROM {named}) x JOIN rec r ON x.idx = r.row_id"
    trimmed = lambda c: f"nullif({_strip(f'coalesce({c}, {chr(39)}None{chr(39)})')}, 'nan') AS {c}"
    phon = "CASE WHEN p IS NOT NULL AND street <> '' THEN p || '_' || street WHEN p IS NOT NULL THEN 'plz_only_' || p WHEN street <> '' THEN 'street_only_' || street ELSE {} END"
    return {
        "scan_project_filter": f"SELECT event_id, user_id, event_type FROM events WHERE ts < TIMESTAMP '{CUT_OFF}' - INTERVAL 7 DAYS",
        "normalize_name": of("norm", "SELECT row_id, v AS vorname, n AS name FROM norm"),
        "normalize_name_poc": of("rec", f"SELECT row_id, {_name('Vorname', True)} AS vorname, {_name('Name', True)} AS name FROM rec"),
        "normalize_plz": of("norm", "SELECT row_id, plz5 AS plz FROM norm"),
        "normalize_street": of("norm", "SELECT row_id, street FROM norm"),
        "normalize_street_literal": of("rec", f"SELECT row_id, {_street_literal('Strasse')} AS street FROM rec"),
        "blocking_keys": of("keyed", "SELECT row_id, block_key FROM keyed"),
        "phonetic_blocks": of("norm", f"SELECT row_id, {phon.format("CASE WHEN pv <> '' OR pn <> '' THEN 'phon_' || pv || '_' || pn ELSE 'no_address' END")} AS block_key, {phon.format("'no_address'")} AS plain_key FROM (SELECT *, CASE WHEN regexp_matches(coalesce(Plz, ''), '[0-9]') THEN plz5 END AS p FROM norm)"),
        "newest_records": "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id LIMIT 100",
        "clean_records": of("rec", f"SELECT row_id, {', '.join(map(trimmed, CLEANED[:7]))}, coalesce(Geburtstag, '') AS Geburtstag, coalesce(Jahrgang, '') AS Jahrgang FROM rec"),
        "sampled_records": of("rec", "SELECT row_id, Vorname, Name FROM rec ORDER BY md5('42|' || row_id), row_id LIMIT 100"),
        "numbered_records": of("rec", f"SELECT row_number() OVER (ORDER BY {', '.join(f'{c} NULLS FIRST' for c in records.FIELDS)}) - 1 AS row_id, Vorname, Name, Strasse, Plz FROM (SELECT *, NULL::VARCHAR AS Quelle_95 FROM rec)"),
        "block_statistics": of("keyed", "SELECT count(*) AS n_blocks, coalesce(sum(c), 0)::BIGINT AS n_rows, round(avg(c), 9) AS mean_size, max(c) AS largest, count(*) FILTER (WHERE c > 20) AS n_split FROM (SELECT count(*) AS c FROM keyed GROUP BY block_key)"),
        "listing": of("m", "SELECT row_number() OVER (ORDER BY confidence DESC, record_a, record_b) AS rank_no, upper(replace(match_type, '_', ' ')) AS label, round(confidence, 9) AS confidence, record_a, x.Vorname || ' ' || x.Name AS name_a, record_b, y.Vorname || ' ' || y.Name AS name_b FROM m JOIN rec x ON record_a = x.row_id JOIN rec y ON record_b = y.row_id"),
        "filtered_matches": of("m", flat + "m WHERE match_type LIKE '%swapped%' AND confidence >= 80"),
        "recall_by_alteration": of("m", "SELECT (x.row_id // 2 % 24)::INT AS kind, count(*) AS n_expected, count(m.record_a) AS n_found FROM rec x LEFT JOIN m ON m.record_a = x.row_id AND m.record_b = x.row_id + 1 WHERE x.row_id % 2 = 0 GROUP BY ALL"),
        "block_sizes": of("keyed", "SELECT block_key, count(*) AS n_rows FROM keyed GROUP BY block_key"),
        "block_chunks": of("chunked", "SELECT row_id, block_key, chunk20 AS chunk_no FROM chunked"),
        "comparison_reduction": of("chunked", "SELECT n_blocks, n_rows, pairs_all, pairs_blocked, round(CASE WHEN pairs_all > 0 THEN 100.0::DOUBLE * (pairs_all - pairs_blocked) / pairs_all ELSE 0 END, 9) AS saved_percent FROM (SELECT count(*) FILTER (WHERE c > 1) AS n_blocks, sum(c)::BIGINT AS n_rows, (sum(c) * (sum(c) - 1) // 2)::BIGINT AS pairs_all, sum(c * (c - 1) // 2)::BIGINT AS pairs_blocked FROM (SELECT count(*) AS c FROM chunked GROUP BY block_key, chunk20))"),
        "effective_year": of("norm", "SELECT row_id, year FROM norm"),
        "date_rule_pairs": of("cand", "SELECT a_block_key AS block_key, a_year AS year, count(*) AS n_pairs FROM cand GROUP BY ALL"),
        "zweitname_pairs": of("ruled", "SELECT a_row_id AS record_a, b_row_id AS record_b FROM ruled WHERE a_second <> '' OR b_second <> ''"),
        "address_ratio_pairs": of("cand", f"SELECT block_key, address_matches, total_address_fields, count(*) AS n_pairs FROM (SELECT a_block_key AS block_key, ({' + '.join(f'(CASE WHEN a_a{k} <> {chr(39) * 2} AND b_a{k} <> {chr(39) * 2} AND a_a{k} = b_a{k} THEN 1 ELSE 0 END)' for k in range(4))})::INT AS address_matches, ({' + '.join(f'(CASE WHEN a_a{k} <> {chr(39) * 2} AND b_a{k} <> {chr(39) * 2} THEN 1 ELSE 0 END)' for k in range(4))})::INT AS total_address_fields FROM cand) GROUP BY ALL"),
        "exact_matches": of("ex", "SELECT record_a, record_b, confidence, match_type FROM ex"),
        "unmatched_records": of("taken", "SELECT row_id FROM chunked WHERE (year IS NULL OR year <> 0) AND row_id NOT IN (SELECT row_id FROM taken)"),
        "name_similarity": of("cand", f"SELECT record_a, record_b, round(normal_score, 9) AS normal_score, round(swapped_score, 9) AS swapped_score, round(best_score, 9) AS best_score, is_swapped FROM ({best})"),
        "fuzzy_matches": of("m", flat + "m WHERE starts_with(match_type, 'fuzzy')"),
        "phonetic_codes": of("norm", "SELECT row_id, pv AS vorname_phon, pn AS name_phon FROM norm"),
        "phonetic_matches": of("m", flat + "m WHERE starts_with(match_type, 'phonetic')"),
        "all_matches": of("m", flat + "m"),
        "match_type_breakdown": of("m", "SELECT match_type, count(*) AS n_matches FROM m GROUP BY match_type"),
        "confidence_histogram": of("m", "SELECT count(*) FILTER (WHERE c >= 90) AS ge_90, count(*) FILTER (WHERE c >= 80 AND c < 90) AS from_80_to_90, count(*) FILTER (WHERE c < 80) AS under_80, count(*) FILTER (WHERE c >= 70 AND c < 80) AS from_70_to_80, count(*) FILTER (WHERE c >= 90 AND c < 95) AS from_90_to_95, count(*) FILTER (WHERE c >= 95) AS ge_95 FROM (SELECT confidence AS c FROM m)"),
        "report_summary": of("m", "SELECT count(*) AS n_matches, count(*) FILTER (WHERE starts_with(match_type, 'exact')) AS n_exact, count(*) FILTER (WHERE starts_with(match_type, 'fuzzy')) AS n_fuzzy, count(*) FILTER (WHERE starts_with(match_type, 'phonetic')) AS n_phonetic, count(*) FILTER (WHERE ends_with(match_type, 'swapped')) AS n_swapped, count(*) FILTER (WHERE confidence >= 80) AS n_high, round(coalesce(avg(confidence), 0), 6) AS mean_confidence FROM m"),
        "top_matches": of("m", flat + "(SELECT * FROM m ORDER BY confidence DESC, record_a, record_b LIMIT 10)"),
        "export_rows": of("m", f"SELECT pair AS match_id, round(confidence, 9) AS confidence, match_type, position, row_id AS index, Vorname AS vorname, Name AS name, Name2 AS name2, Strasse AS strasse, HausNummer AS hausnummer, Plz AS plz, Ort AS ort, Crefo AS crefo, Geburtstag AS geburtstag, Jahrgang AS jahrgang {rows}"),
        "export_rows_wide": of("m", f"SELECT pair AS crefo1_crefo2, position AS record_position, round(confidence, 9) AS confidence_score, match_type, row_id AS record_index, {_strip('Vorname || chr(32) || Name')} AS name, Name AS name_field, Strasse AS strasse, Plz AS plz, round(normal_score, 9) AS name_similarity_normal, CASE WHEN normal_score IS NOT NULL THEN ends_with(match_type, 'swapped') END AS is_swapped {rows}"),
        "poc_matches": of("pm", flat + "pm"),
        "blocked_matches": of("bm", flat + "bm"),
    }
