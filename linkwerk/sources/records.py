"""Person and address records: schema, adapters, sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import numbered

FIELDS = ["Vorname", "Name", "Name2", "Strasse", "HausNummer", "Plz", "Ort", "Crefo", "Geburtstag", "Jahrgang", "Quelle_95"]
NEEDED = ["Vorname", "Name", "Strasse", "Plz"]
LAG_DAYS = 7
SYLLABLES = ["ba", "do", "fi", "ge", "ka", "lu", "mi", "no", "ra", "se", "ti", "wo"]


def canonical(df: DataFrame, key: str | None = None) -> DataFrame:
    """row_id, FIELDS as text and Erfasst as a timestamp; columns that are missing become null.

    Rows are numbered by ``key`` (unique; a number is taken as it is). Without a
    key the order is that of all fields: one sort by ranges, each numbered by itself.
    """
    if missing := [c for c in NEEDED if c not in df.columns]:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    text = lambda c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    fields = [text(c).alias(c) for c in FIELDS]
    when = (F.col("Erfasst").cast("timestamp") if "Erfasst" in df.columns else F.lit(None).cast("timestamp")).alias("Erfasst")
    if key is not None and dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint"):
        return df.select(F.col(key).cast("long").alias("row_id"), *fields, when)
    if key is not None:
        order, rows = ["key"], df.select(F.col(key).alias("key"), *fields, when)
    else:
        order, rows = FIELDS, df.select(*fields, when)
    return numbered(rows, [F.col(c) for c in order], "row_id").select("row_id", *FIELDS, "Erfasst")


def clean(df: DataFrame) -> DataFrame:
    """Trims text columns; dates that are null become empty, other nulls the text None."""
    columns = {c: F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("None")), r"^\s+|\s+$", "") for c in ("Vorname", "Name", "Name2", "Strasse", "HausNummer", "Plz", "Ort") if c in df.columns}
    columns |= {c: F.when(v != "nan", v) for c, v in columns.items()}
    columns |= {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("Geburtstag", "Jahrgang") if c in df.columns}
    return df.withColumns(columns)


def settled(df: DataFrame, now: Column | None = None, days: int = LAG_DAYS) -> DataFrame:
    """Records entered longer than ``days`` ago."""
    return df.where(F.col("Erfasst") < (F.current_timestamp() if now is None else now) - F.expr(f"INTERVAL {days} DAYS"))


def jdbc_url(server: str, database: str) -> str:
    return f"jdbc:sqlserver://{server};databaseName={database};integratedSecurity=true;encrypt=true"


def newest(df: DataFrame, limit: int | None = None, tie: str | None = None) -> DataFrame:
    """The latest entered first; ``tie`` orders those of one moment."""
    df = df.orderBy(F.desc("Erfasst"), *([tie] if tie else []))
    return df if limit is None else df.limit(limit)


def jdbc_options(url: str, table: str | None = None, query: str | None = None, partition: dict | None = None) -> dict:
    """Options of a read. partition (partitionColumn, lowerBound, upperBound, numPartitions) needs a table."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    if query is not None and partition:
        raise ValueError("only a table can be read in partitions")
    return {"url": url, **({"dbtable": table} if table else {"query": query}), **(partition or {})}


def load(spark: SparkSession, url: str, table: str | None = None, limit: int | None = None, newest_first: bool = False, partition: dict | None = None, query: str | None = None, **options) -> DataFrame:
    """Addresses from a database; projection, lag filter, order and limit are pushed down. A query is read as it is."""
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, query, partition), **options).load()
    if query is None:
        df = settled(df.select(*(c for c in [*FIELDS, "Erfasst"] if c in df.columns)))
    df = newest(df) if newest_first else df
    return df if limit is None else df.limit(limit)


def synthetic(spark: SparkSession, n: int, seed: int = 42, copies: float = 0.1) -> DataFrame:
    """n made-up records and a share of copies, each with one of four faults.

    Names are syllables put together. A copy has two letters of the last name
    exchanged, first and last name exchanged, another address, or no house number.
    """
    draw = lambda salt, m: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(m)).cast("int")
    pick = lambda salt, pool: F.element_at(F.array(*map(F.lit, pool)), draw(salt, len(pool)) + 1)
    word = lambda salt, k: F.initcap(F.concat(*(pick(f"{salt}{i}", SYLLABLES) for i in range(k))))
    address = lambda salt: {"Strasse": F.concat(word(f"street{salt}", 2), pick(f"way{salt}", ["weg", "str.", "platz", "straße"])), "HausNummer": (draw(f"house{salt}", 60) + 1).cast("string"), "Plz": F.lpad(draw(f"plz{salt}", 99_000).cast("string"), 5, "0"), "Ort": F.concat(word(f"town{salt}", 1), pick(f"end{salt}", ["au", "dorf", "tal"]))}
    rows = spark.range(n).select(
        F.col("id"),
        word("first", 2).alias("Vorname"),
        F.concat(word("last", 2), F.lit("r")).alias("Name"),
        F.lit("").alias("Name2"),
        *(c.alias(k) for k, c in address("").items()),
        F.date_add(F.lit("1930-01-01").cast("date"), draw("born", 25_000)).cast("string").alias("Geburtstag"),
        F.lit(None).cast("string").alias("Jahrgang"),
        F.concat(F.lit("C"), F.col("id")).alias("Crefo"),
    )
    fault = draw("fault", 4)
    slip = F.concat(F.substring("Name", 1, 2), F.substring("Name", 4, 1), F.substring("Name", 3, 1), F.substring("Name", 5, 99))
    turned = {"Vorname": F.when(fault == 1, F.col("Name")).otherwise(F.col("Vorname")), "Name": F.when(fault == 0, slip).when(fault == 1, F.col("Vorname")).otherwise(F.col("Name"))}
    moved = {k: F.when(fault == 2, c).otherwise(F.col(k)) for k, c in address("new").items()}
    moved["HausNummer"] = F.when(fault == 3, F.lit("")).otherwise(moved["HausNummer"])
    again = rows.where(draw("copy", 1000) < int(copies * 1000)).withColumns({**turned, **moved}).withColumn("id", F.col("id") + n)
    return canonical(rows.union(again), "id")


def from_documents(docs: DataFrame) -> DataFrame:
    """Stand-in records from a table of documents: two for each, the second altered by the id.

    Names are words of the whole text, picked by its number of words; blocks are
    language, source and the number of words modulo 7. Alterations (id modulo
    24): 1 names exchanged, 2 a letter of the last name, 3 the vowels of both
    names, 4 these exchanged as well, 5 year and birthday exchanged, 6 second
    name joined by a hyphen, 7 (one in five) blank postal code, every other
    time on both, 8 no
    street, 9 no postal code, 10 no house number and place, 11 year 0, 12 no
    year on either, 13 no address, 14 another day, 15 vowels of the first name.
    """
    w = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    word = lambda part: F.coalesce(F.get("w", F.floor(F.col("n") / part).cast("int") % F.greatest("n", F.lit(1))), F.lit(""))
    rows = docs.select("doc_id", "lang", "source", w.alias("w")).withColumn("n", F.size("w"))
    rows = rows.select("doc_id", "lang", "source", "n", word(3).alias("v"), word(2).alias("l"), word(5).alias("m"), F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
    kind, number = F.pmod("doc_id", F.lit(24)), F.regexp_replace(F.coalesce("source", F.lit("")), "[^0-9]", "")
    is_ = lambda *kinds: (F.col("side") == 1) & kind.isin(*kinds)
    none, turned = F.lit(None).cast("string"), lambda c: F.translate(c, "aeo", "eoa")
    first = F.when(is_(3, 4, 15), turned("v")).otherwise(F.col("v"))
    last = F.when(is_(3, 4), turned("l")).when(is_(2), F.replace("l", F.lit("e"), F.lit("a"))).when(is_(6), F.concat_ws("-", "l", "m")).otherwise(F.col("l"))
    born, even = (F.length("v") % 3 + 1950).cast("string"), F.when(is_(5), F.col("doc_id") % 2 == 1).otherwise(F.col("doc_id") % 2 == 0)
    undated = (kind == 12) | is_(11)
    rows = rows.select(
        (F.col("doc_id") * 2 + F.col("side")).alias("row_id"),
        F.when(is_(1, 4), last).otherwise(first).alias("Vorname"),
        F.when(is_(1, 4), first).otherwise(last).alias("Name"),
        F.when(kind == 6, F.when(F.col("side") == 1, "").otherwise(F.col("m"))).when(F.col("n") % 4 == 0, F.col("m")).when(F.col("n") % 4 == 1, none).otherwise("").alias("Name2"),
        F.when(~is_(8, 13), F.concat(F.col("lang"), F.element_at(F.array(F.lit("str."), F.lit("strasse"), F.lit("straße")), ((F.col("doc_id") + F.col("side")) % 3 + 1).cast("int")))).alias("Strasse"),
        F.when(~is_(10), number).alias("HausNummer"),
        F.when(is_(9, 13), none).when((kind == 7) & (F.col("doc_id") % 5 == 0) & ((F.col("side") == 1) | (F.floor(F.col("doc_id") / 24) % 2 == 0)), "").otherwise((F.ascii(F.substring("lang", 2, 1)) * 10 + 1000 + F.length("source") * 1000 + F.coalesce(number.try_cast("int"), F.lit(0)) * 100 + F.col("n") % 7).cast("string")).alias("Plz"),
        F.when(~is_(10), F.col("lang")).alias("Ort"),
        F.when(F.col("side") == 0, F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("C"), F.col("doc_id")))).when(F.col("doc_id") % 2 == 0, F.concat(F.lit("K"), F.col("doc_id"))).otherwise("").alias("Crefo"),
        F.when(undated, none).when(is_(14), F.concat(born, F.lit("-03-02"))).when(even, F.concat(F.lit("01.01."), born)).otherwise("").alias("Geburtstag"),
        F.when(kind == 12, none).when(is_(11), "0").when(is_(14) | even, "").otherwise(F.concat(born, F.lit(".0"))).alias("Jahrgang"),
    )
    return canonical(rows, "row_id")
