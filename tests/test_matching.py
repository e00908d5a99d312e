import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkwerk import queries, storage
from linkwerk.functions import names
from linkwerk.functions.phonetics import cologne
from linkwerk.functions.similarity import indel, indel_native, lcs, ratio, ratio_table, ratios, rounded
from linkwerk.operators import DuplicateChecker
from linkwerk.plans import blocking, matching, report, tiles
from linkwerk.sources import records, sinks

from . import people


def _found(matches):
    return {(r.record_a, r.record_b): (r.match_type, r.confidence) for r in matches.collect()}


def _values(spark, fn, values):
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, x string")
    return [r[0] for r in df.orderBy("k").select(fn(F.col("x"))).collect()]


def test_known_matches_and_no_others(spark):
    found = _found(DuplicateChecker(fuzzy_threshold=0.75).find_duplicates(people.frame(spark), 60.0))
    assert found.keys() == people.EXPECTED.keys()
    for pair, (kind, confidence) in people.EXPECTED.items():
        assert found[pair][0] == kind and abs(found[pair][1] - confidence) < 1e-9


def test_comparison_reduction(spark):
    df = blocking.chunked(people.frame(spark).withColumn("block_key", blocking.blocking_key()))
    r = blocking.reduction(df).first()
    assert (r.pairs_all, r.pairs_blocked, r.n_blocks) == (465, 15, 15)
    assert blocking.reduction(df.limit(0)).first().saved_percent == 0


def test_names(spark):
    assert _values(spark, names.name, ["Müller", " MUELLER\t", None, "Groß  Mann", "Žižek", "Łódź", ""]) == ["mueller", "mueller", "", "gross mann", "zizek", "lodz", ""]
    assert _values(spark, names.name_plain, ["Müller", "Groß", None]) == ["muller", "gross", ""]
    assert _values(spark, names.postal_code, ["", "8001", "964200", "CH-8001", None]) == ["00000", "08001", "96420", "08001", "00000"]
    assert _values(spark, names.street, ["Hauptstr.", "Hauptstraße", "Hauptstrasse 5", "12a Weg", "oberstra", "hauptstr. 5", None, "Müllerweg"]) == ["hauptstrasse", "hauptstrasse", "hauptstrasse", "weg", "oberstrasse", "hauptstr", "", "mullerweg"]
    assert _values(spark, names.street_literal, ["Hauptstr.", "oberstra", "a - b", None]) == ["hauptstrasse", "oberstra", "a  b", None]
    assert _values(spark, names.year, ["28.07.1955", "1980-01-15", "15011980", "", None]) == [1955, 1980, 1501, None, None]


def test_effective_year(spark):
    rows = [("0000-1-1", "1998.0"), ("", "x"), (None, None), ("1980", "1990"), (None, "0"), ("", "-3.7")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(names.effective_year(F.col("a"), F.col("b"))).collect()] == [1998, None, None, 1980, 0, -3]


def test_phonetic_codes(spark):
    codes = {"Meyer": "67", "Maier": "67", "Müller": "657", "Miler": "657", "Schmidt": "862", "Schmitt": "862", "Wagner": "3467", "Vagner": "3467", "Fischer": "387", "Hans": "068", "Philipp": "351", "Filip": "351", "Hoffmann": "0366", "Schröder": "8727", "Breschnew": "17863", "Weber": "317", "Koch": "44", "": "", " ": ""}
    assert _values(spark, cologne, list(codes)) == list(codes.values())
    assert _values(spark, lambda c: cologne(c, False), ["Müller-Lüdenscheidt", None]) == ["65752682", ""]


@given(st.text("abcü", max_size=12), st.text("abcü", max_size=12))
@settings(max_examples=200, deadline=None)
def test_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert lcs(a, b) == table[-1][-1]


def test_similarity_native(spark):
    pairs = [("thomas", "tomas"), ("mueller", "miler"), ("", "a"), (None, "a"), ("a", "a"), ("ab", "ba")]
    df = spark.createDataFrame(pairs, "a string, b string")
    for r in df.select("a", "b", indel("a", "b").alias("x"), indel_native(F.col("a"), F.col("b")).alias("y")).collect():
        assert r.x == r.y == ratio(r.a, r.b)


def test_phonetic_matches(spark):
    find = lambda rows, **k: _found(DuplicateChecker(fuzzy_threshold=0.7, **k).find_duplicates(people.frame(spark, rows), 60.0))
    assert find([people.row(0, "Philipp", "Maier"), people.row(1, "Filip", "Meyer")]) == {(0, 1): ("phonetic_assisted_normal", 82.0)}
    assert find([people.row(0, "Philipp", "Maier"), people.row(1, "Meyer", "Filip")]) == {(0, 1): ("phonetic_assisted_swapped", 80.0)}


def test_rules(spark):
    find = lambda rows, t=60.0, **k: _found(DuplicateChecker(fuzzy_threshold=0.7, **k).find_duplicates(people.frame(spark, rows), t))
    same = [people.row(k, "Max", "Muster") for k in range(3)]
    assert find(same).keys() == {(0, 1), (0, 2), (1, 2)}
    assert find(same, max_block_size=2).keys() == {(0, 1)}
    assert find(same, max_block_size=None).keys() == {(0, 1), (0, 2), (1, 2)}
    assert find([people.row(k, "Max", "Muster", birthday=None, year="0") for k in range(2)]) == {}
    assert find([people.row(0, "Max", "Muster", year="1980", birthday=None), people.row(1, "Max", "Muster", birthday=None)]) == {}
    assert find([people.row(k, "Max", "Muster", birthday=None, ort=None) for k in range(2)]) == {(0, 1): ("exact_normal", 100.0)}
    far = [people.row(k, "Max", "Muster", nr=str(k), ort=f"o{k}", plz="12345" if k else "12345 ", strasse="Weg" if k else "weg 1") for k in range(2)]
    assert find(far, t=99.0)[(0, 1)][1] == 92.5
    assert find([]) == {} and find(same[:1]) == {}


def test_blank_postal_code(spark):
    rows = [people.row(0, "Max", "Muster", plz="", strasse="Weg"), people.row(1, "Max", "Muster", plz="", strasse="")]
    keys = lambda **k: [r[0] for r in people.frame(spark, rows).orderBy("row_id").select(blocking.blocking_key(**k)).collect()]
    assert keys() == ["00000_weg", "plz_only_00000"]
    assert keys(blank_plz="null") == ["street_only_weg", "phon_648_6827"]
    assert keys(blank_plz="null", phonetic=False) == ["street_only_weg", "no_address"]


def _naive(rows, mode, fuzzy, least):
    """The pair loop over all rows, as a check on the joins."""
    import re
    import unicodedata

    fold = lambda s: "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c))

    def norm(s):
        s = (s or "").strip().lower().replace("ß", "ss")
        if mode == "two_stage":
            s = s.replace("ü", "ue").replace("ä", "ae").replace("ö", "oe")
        return re.sub(r"\s+", " ", fold(s)).strip()

    def eff(r):
        m = re.search(r"\d{4}", r[8] or "")
        y = int(m[0]) if m else None
        try:
            j = int(float((r[9] or "").strip()))
        except ValueError:
            j = None
        return y if y else j

    def second(a, b):
        x, y = ((r[3] or "").strip().lower() for r in (a, b))
        if x and y:
            return x == y
        if mode != "two_stage" or (not x and not y):
            return True
        return ((b if x else a)[2] or "").strip().lower().endswith(x or y)

    def address(a, b):
        same = total = 0
        for k in (4, 5, 6, 7):
            if mode == "two_stage":
                x, y = (str(r[k]).strip().lower() for r in (a, b))
                if not (x and y):
                    continue
            elif a[k] is None or b[k] is None:
                continue
            else:
                x, y = a[k].strip(), b[k].strip()
            total += 1
            same += x == y
        return same / max(total, 1)

    def ok(a, b):
        x, y = eff(a), eff(b)
        return second(a, b) and ((x and y and x == y) or (x is None and y is None))

    def scores(a, b):
        v, n, w, m = norm(a[1]), norm(a[2]), norm(b[1]), norm(b[2])
        return (ratio(v, w) + ratio(n, m)) / 2, (ratio(v, m) + ratio(n, w)) / 2

    out, used = {}, set()
    pairs = [(a, b) for i, a in enumerate(rows) for b in rows[i + 1 :] if ok(a, b)]
    for a, b in pairs:
        v, n, w, m = norm(a[1]), norm(a[2]), norm(b[1]), norm(b[2])
        if mode == "two_stage":
            if all((v, n, w, m)) and ((v, n) == (w, m) or (v, n) == (m, w)):
                normal = (v, n) == (w, m)
                out[a[0], b[0]] = ("exact_normal" if normal else "exact_swapped", (90 if normal else 85) + address(a, b) * 10)
                used |= {a[0], b[0]}
        else:
            both = [(a[k], b[k]) for k in (1, 2, 4, 5, 6, 7) if a[k] is not None and b[k] is not None]
            if both and all(x.strip() == y.strip() for x, y in both):
                out[a[0], b[0]] = ("exact", 100.0)
                used |= {a[0], b[0]}
    exact = set(out)
    for a, b in pairs:
        if (a[0], b[0]) in exact or (mode != "blocked" and {a[0], b[0]} & used):
            continue
        if mode == "global":
            x, y = ("nan" if r[6] is None else r[6].strip() for r in (a, b))
            if x != y and x and y:
                continue
        normal, swapped = scores(a, b)
        if max(normal, swapped) < fuzzy:
            continue
        confidence = max(normal, swapped) * 50 + address(a, b) * 30 + (0 if swapped <= normal else -5 if mode == "two_stage" else 10)
        if min(confidence, 95) >= least:
            out[a[0], b[0]] = ("fuzzy_swapped" if swapped > normal else "fuzzy_normal", min(confidence, 95))
    return out


def test_joins_find_what_the_pair_loop_finds(spark):
    rng = random.Random(3)
    first, last = ["Max", "Mux", "Maxi", "Müller", "Tom"], ["Müller", "Mueller", "Miller", "Tom", "Max"]
    for mode in ("two_stage", "global", "blocked"):
        rows = [people.row(k, rng.choice(first), rng.choice(last), rng.choice(["", "", "ler", "B"]), nr=rng.choice(["1", "2"] if mode == "two_stage" else ["1", "2", None]), plz="12345" if mode != "global" else rng.choice(["12345", "1", "", None]), ort=rng.choice(["O", "P"]), birthday=rng.choice(["1980-01-01", None]), year=rng.choice([None, "1980.0", "0", "1990"])) for k in range(60)]
        found = _found(DuplicateChecker(mode, fuzzy_threshold=0.75).find_duplicates(people.frame(spark, rows), 55.0))
        want = _naive(rows, mode, 0.75, 55.0)
        found = {k: v for k, v in found.items() if not v[0].startswith("phonetic")}
        assert found.keys() == want.keys(), mode
        assert all(found[k][0] == want[k][0] and abs(found[k][1] - want[k][1]) < 1e-9 for k in want), mode


def test_export_and_report(spark, tmp_path):
    df = people.frame(spark)
    checker = DuplicateChecker(fuzzy_threshold=0.75)
    matches = checker.find_duplicates(df, 60.0)
    assert checker.export(matches, df, str(tmp_path / "out.csv"), single=True)
    text = (tmp_path / "out.csv").read_bytes()
    assert text.startswith(b"\xef\xbb\xbfmatch_id,confidence,match_type,position,index,vorname,name,name2,strasse,hausnummer,plz,ort,crefo,geburtstag,jahrgang")
    assert text.count(b"\n") == 27
    assert not checker.export(matches.limit(0), df, str(tmp_path / "none.csv"), single=True) and not checker.export(matches.limit(0), df, str(tmp_path / "none.csv")) and not (tmp_path / "none.csv").exists()
    assert sinks.export_rows_wide(matches, df).columns == sinks.WIDE
    assert checker.export(matches, df, str(tmp_path / "parts"), wide=True)
    back = spark.read.csv(str(tmp_path / "parts"), header=True, escape='"')
    assert back.columns == sinks.WIDE and back.count() == 26
    shown = checker.listing(matches, df, 3).orderBy("rank_no").collect()
    assert [(x.rank_no, x.label, x.confidence) for x in shown] == [(k, "EXACT NORMAL", 100.0) for k in (1, 2, 3)] and shown[0].name_a == "Max Mustermann"
    sizes = checker.block_statistics(df).first()
    assert (sizes.n_blocks, sizes.n_rows, sizes.largest, sizes.n_split) == (16, 31, 2, 0) and abs(sizes.mean_size - 31 / 16) < 1e-9
    assert checker.block_statistics(df.limit(0)).first().mean_size is None
    timed = checker.benchmark(df, (10, 50), 60.0)
    assert [x["n_rows"] for x in timed] == [10, 50] and timed[1]["n_matches"] == 13 and timed[1]["rows_per_second"] > 0
    assert report.throughput(1000, 2.0, 5000) == {"rows_per_second": 500.0, "seconds_for_total": 10.0} and report.throughput(0, 1.0)["seconds_for_total"] is None
    r = checker.report(matches)
    assert (r["n_matches"], r["n_exact"], r["n_fuzzy"], r["n_swapped"], len(r["top_matches"])) == (13, 6, 7, 3, 10)
    assert checker.report(matches.limit(0))["mean_confidence"] == 0
    assert report.only(matches, swapped=True, least=72).count() == 2
    assert report.sample(df, 5).count() == 5


def test_sources(spark):
    made = records.synthetic(spark, 500)
    assert 520 < made.count() < 580
    assert DuplicateChecker().find_duplicates(made, 60.0).count() > 0
    cleaned = records.clean(spark.createDataFrame([(" a ", None, "nan", None)], "Vorname string, Name string, Ort string, Jahrgang string")).first()
    assert tuple(cleaned) == ("a", "None", None, "")


def test_stream(spark, tmp_path):
    from linkwerk.streaming import match_stream

    df, got = people.frame(spark), []
    df.where("row_id % 2 = 1").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = match_stream(stream, df.where("row_id % 2 = 0"), lambda m, k: got.extend(m.collect()), matching.Settings(fuzzy=0.75, confidence=60.0)).option("checkpointLocation", str(tmp_path / "at")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {(r.record_a, r.record_b) for r in got} == people.EXPECTED.keys()


def test_queries_need_no_session():
    import subprocess
    import sys
    from pathlib import Path

    code = "from linkwerk import queries as q; assert q.queries().keys() == q.oracle_sql().keys() and len(q.queries()) > 25"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parents[1])


def test_queries_keep_large_blocks_whole(spark, tmp_path):
    letters = lambda k: "".join("abcdefghij"[int(c)] for c in f"{k:05d}")
    # the first records of documents 5,010 apart agree, in a block of 10,026
    rows = [(k, f"{letters(k % 5_010 if k > 5_010 else k)} meier", "de", "src1", 11) for k in range(1, 5_014)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.queries()["exact_matches"](spark, str(tmp_path)).collect()
    assert {(2, 10_022), (4, 10_024), (6, 10_026)} <= {(r.record_a, r.record_b) for r in found}


def test_similarity_of_many():
    rng = random.Random(7)
    word = lambda m: "".join(rng.choice("abcdeü") for _ in range(rng.randrange(m)))
    a = [word(12) for _ in range(500)] + [word(80) for _ in range(100)] + ["x" * 64, "x" * 64, None, "", "a" * 65]
    b = [word(12) for _ in range(500)] + [word(80) for _ in range(100)] + ["x" * 64, "y" * 64, "a", "a", "a" * 65]
    assert ratios(a, b).tolist() == [ratio(x, y) for x, y in zip(a, b, strict=True)] and len(ratios([], [])) == 0


def test_rows_are_numbered_by_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"), F.lit("z").alias("range_no"))
    for run in (10**6, 90):
        got = storage.numbered(df, [F.desc("x")], "place", run)
        assert got.columns == ["x", "range_no", "place"] and all(r.place == 999 - r.x for r in got.collect())
    assert storage.numbered(df.limit(0), [F.col("x")], "place").count() == 0
    made = records.canonical(spark.createDataFrame([("b", "n", "s", "1"), ("a", "n", None, "1"), ("a", "n", "s", "1")], "Vorname string, Name string, Strasse string, Plz string"))
    assert [(r.row_id, r.Vorname, r.Strasse) for r in made.orderBy("row_id").collect()] == [(0, "a", None), (1, "a", "s"), (2, "b", "s")]
    try:
        records.canonical(spark.range(1))
        raise AssertionError
    except ValueError as e:
        assert "Vorname" in str(e)


def test_database_options():
    import pytest

    url = records.jdbc_url("host", "db")
    assert url.startswith("jdbc:sqlserver://host;databaseName=db;")
    parts = {"partitionColumn": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    assert records.jdbc_options(url, "people", partition=parts) == {"url": url, "dbtable": "people", **parts}
    assert records.jdbc_options(url, query="SELECT 1") == {"url": url, "query": "SELECT 1"}
    for bad in ({}, {"table": "a", "query": "b"}, {"query": "b", "partition": parts}):
        with pytest.raises(ValueError):
            records.jdbc_options(url, **bad)


def test_newest_first_and_lag(spark):
    now = F.lit("2024-02-10").cast("timestamp")
    df = spark.createDataFrame([(k, f"2024-02-0{k}") for k in range(1, 8)], "k int, d string").withColumn("Erfasst", F.col("d").cast("timestamp"))
    assert [r.k for r in records.newest(records.settled(df, now)).collect()] == [2, 1] and [r.k for r in records.newest(df, 3).collect()] == [7, 6, 5]


def test_command_line(spark, tmp_path, capsys):
    from linkwerk import cli

    people.frame(spark).withColumn("id", F.col("row_id")).write.parquet(str(tmp_path / "in"))
    common = [str(tmp_path / "in"), "--key", "id", "--confidence", "60", "--fuzzy-threshold", "0.75"]
    cli.main([*common, "--output", str(tmp_path / "out"), "--benchmark", "--no-parallel"])
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 26 and "rows/s" in capsys.readouterr().out
    cli.main([*common, "--output", str(tmp_path / "one.csv"), "--single-file", "--mode", "blocked"])
    assert (tmp_path / "one.csv").read_text(encoding="utf-8-sig").startswith("match_id,")
    cli.main([*common, "--limit", "0", "--output", str(tmp_path / "none")])
    assert not (tmp_path / "none").exists() and "no matches" in capsys.readouterr().out


def test_exact_pairs_with_null_fields(spark):
    rng = random.Random(4)
    pick = lambda *values: rng.choice(values)
    rows = [(k, pick("Max", "Eva"), pick("Moor", "Tal"), "", pick("Weg", None), pick("1", None), pick("10000", "", None), pick("Ort", None), "1980-01-01", None) for k in range(60)]
    found = DuplicateChecker("global", 0.7).find_duplicates(people.frame(spark, rows), 60.0).where("match_type = 'exact'")
    same = lambda a, b: all(x == y for x, y in zip(a, b, strict=True) if x is not None and y is not None)
    fields = lambda r: (r[1], r[2], *r[4:8])
    assert {(r.record_a, r.record_b) for r in found.collect()} == {(a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and same(fields(a), fields(b))}


def test_shared_folder_must_be_set_on_a_cluster():
    import pytest

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda k, d: d)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _crowd(spark, n, blank=()):
    """n rows of few names in one block, some with a blank code."""
    draw = random.Random(5)
    words = ["anna", "anne", "hanna", "", "x" * 70, "x" * 69 + "y", *("".join(draw.choices("abcde", k=draw.randint(1, 9))) for _ in range(12))]
    rows = [people.row(k, draw.choice(words), draw.choice(words), plz="" if k in blank else "12345") for k in range(n)]
    return people.frame(spark, rows)


def test_ratio_table():
    draw = random.Random(3)
    words = ["".join(draw.choices("abcü\0", k=k)) for k in (0, 1, 2, 3, 5, 8, 13, 63, 64, 65, 90) for _ in range(4)]
    table = ratio_table(words[:30], words[10:])
    assert all(table[i, j] == ratio(a, b) for i, a in enumerate(words[:30]) for j, b in enumerate(words[10:]))
    assert ratio_table([], ["a"]).shape == (0, 1) and ratio_table([""], ["a"])[0, 0] == 0


def test_rounding_is_sparks(spark):
    import numpy as np

    values = [0.0009765625, 1 / 3, 2 / 3, 0.123456789499999, 0.0, 1.0, 0.1234567895]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(values)], "k int, x double")
    assert rounded(np.array(values), 9).tolist() == [r[0] for r in df.orderBy("k").select(F.round("x", 9)).collect()]


def test_tiles_hold_every_pair_once(spark, monkeypatch):
    for name, size in (("BAND", 40), ("NARROW", 7), ("WIDE", 30), ("TASK", 500)):
        monkeypatch.setattr(tiles, name, size)
    df = matching._plain_features(_crowd(spark, 130, blank=range(0, 130, 6)))
    rows = {r.row_id: (r.v, r.n, r.plz) for r in df.collect()}

    def expected(fits, least):
        out = {}
        for i in rows:
            for j in rows:
                (v, n, p), (w, m, q) = rows[i], rows[j]
                normal, swapped = (ratio(v, w) + ratio(n, m)) / 2, (ratio(v, m) + ratio(n, w)) / 2
                if i < j and fits(p, q) and (least is None or max(normal, swapped) >= least):
                    out[i, j] = (normal, swapped, swapped > normal)
        return out

    for least in (None, 0.7):
        found = tiles.within(df, ["plz", "year"], ["row_id"], least).collect()
        assert {(r[0], r[1]): tuple(r[2:]) for r in found} == expected(lambda p, q: p == q, least) and len(found) == len({r[:2] for r in found})
        found = tiles.across(df.where("plz = ''"), df.where("plz <> ''"), ["year"], ["row_id"], least).collect()
        assert {(r[0], r[1]): tuple(r[2:]) for r in found} == expected(lambda p, q: (p == "") != (q == ""), least) and len(found) == len({r[:2] for r in found})
    assert tiles.within(df.limit(0), ["plz", "year"], ["row_id"]).count() == 0


def test_repeated_ids_are_no_pair(spark):
    df = matching._plain_features(_crowd(spark, 40)).withColumn("row_id", F.expr("row_id div 2"))
    found = tiles.within(df, ["plz", "year"], ["row_id"])
    assert found.count() == 40 * 39 // 2 - 20 and found.where("a_row_id >= b_row_id").count() == 0


def test_global_pairs_are_not_joined_before_they_are_compared(spark):
    plan = _plan(matching.global_two_stage(_crowd(spark, 60, blank=(3, 4, 50)), queries.SETTINGS))
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


def test_blocked_pairs_are_not_joined_before_they_are_compared(spark):
    plan = _plan(matching.blocked_single_stage(_crowd(spark, 60), queries.SETTINGS))
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


def test_fuzzy_pairs_are_not_joined_before_they_are_compared(spark):
    plan = _plan(matching.blocked_two_stage(_crowd(spark, 60), queries.SETTINGS))
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


def test_name_similarity_compares_words_once(spark, tmp_path):
    rows = [(k, "anna anne hanna otto", "de", "src1") for k in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    df = queries.queries()["name_similarity"](spark, str(tmp_path))
    assert "MapInArrow" in _plan(df) and "ArrowEvalPython" not in _plan(df)
    assert df.count() == matching._pairs(matching.features(queries._records(spark, str(tmp_path)), queries.SETTINGS), "block_key", "chunk_no").count() > 0
