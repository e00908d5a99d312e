"""Mixing sources to target weights by repetition.

Sizes are added up per source; a source's target over its size is its
repetition rate. Each document is taken floor(rate) times and once more if its
hash-seeded draw, uniform in [0, 1), is under the rest of the rate. The draw
depends on the id, the text and, among rows equal in id, text and source, on
which of them it is: reruns and lost executors change nothing, and equal rows
are drawn apart. Equal rows are found by a count of digests; only they are
numbered, within the partitions they lie in and then over these.

Targets share ``SHARE`` of all words by weight. One that would exceed ``MOST``
times its source's size stops there and the excess is shared again by weight.
The level (words per weight) that results is found by raising it: sources that
it fills are closed and what they leave is shared among the others, until no
more are filled. Each step is one aggregate over the sources.

Defined results: null text has size 0; a null source is a source, ordered last;
sources without words have target 0 and rate 0; an empty table gives an empty
result; extra columns are ignored by ``mix`` and kept by ``sample``, whose own
column is named copy, or _copy if there is a copy already.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import shared as sh

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = 7
#: Rows of the table of sources up to which it is broadcast.
FEW_SOURCES = 50_000
#: Steps of the level; each fills sources or ends, and sizes differ by factors of 2^63 at most.
STEPS = 1000


def size_of(text: Column) -> Column:
    return F.size(sh.words(text)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """sizes: (source, source_size). Adds weight and target; the rows are as many as sources."""
    turn = (F.pmod(F.col("place"), F.lit(len(weights))) + 1).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), turn).cast("long")
    s = sh.numbered(sizes, [F.col("source").asc_nulls_last()], "place").withColumn("weight", weight)
    limit = F.lit(float(most)) * F.col("source_size")
    level, seen = 0.0, None
    for _ in range(STEPS):
        full = (limit / F.col("weight")) < level
        zero = F.lit(0).cast("long")
        total, filled, open_ = s.agg(F.coalesce(F.sum("source_size"), zero), F.coalesce(F.sum(F.when(full, F.col("source_size"))), zero), F.coalesce(F.sum(F.when(~full, F.col("weight"))), zero)).first()
        if (filled, open_) == seen or not open_:
            break
        seen, level = (filled, open_), (share * total - most * filled) / open_
    else:
        raise RuntimeError(f"the level did not settle in {STEPS} steps")
    return s.select("source", "source_size", "weight", F.least(limit, F.lit(level) * F.col("weight")).alias("target"))


def draw(id_col: Column, text: Column, which: Column | None = None, seed: int = SEED) -> Column:
    """Uniform in [0, 1), from the MD5 of seed, id, the text's MD5 and, from the second on, the number of an equal row."""
    own = [F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")).cast("binary"))]
    own += [F.when(which > 0, which.cast("string"))] if which is not None else []  # null is left out
    return F.conv(F.substring(F.md5(F.concat_ws("|", *own).cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def told_apart(df: DataFrame, key: list[Column], name: str) -> DataFrame:
    """``df`` with, in column ``name``, the number of each row among those that agree on ``key`` (nulls alike)."""
    own, part, first = (sh.fresh(c, [*df.columns, name]) for c in ("own", "part", "first"))
    named = df.withColumn(own, F.md5(F.to_json(F.struct(*(c.cast("string").alias(f"k{i}") for i, c in enumerate(key))), {"ignoreNullFields": "false"}).cast("binary")))
    many = sh.cut(named.groupBy(own).agg(F.count("*").alias("n")).where("n > 1").select(own))
    if many.isEmpty():
        return df.withColumn(name, F.lit(0).cast("long"))
    alike = sh.cut(named.join(many, own, "left_semi").withColumn(part, F.spark_partition_id()))
    before = Window.partitionBy(own).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = alike.groupBy(own, part).agg(F.count("*").alias("n")).select(own, part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(first))
    place = F.row_number().over(Window.partitionBy(own, part).orderBy(F.lit(0))) - 1
    placed = alike.withColumn(name, place.cast("long")).join(offsets, [own, part]).withColumn(name, F.col(name) + F.col(first))
    others = named.join(many, own, "left_anti").withColumn(name, F.lit(0).cast("long"))
    back = [F.col(f"`{c}`") for c in [*df.columns, name]]
    return others.select(*back).unionByName(placed.select(*back))


def rated(df: DataFrame, id_col: str, text: str, source: str) -> tuple[DataFrame, str]:
    """``df`` with a column, named second, of structs of size, source_size, target and copies."""
    which, of, out = (sh.fresh(c, df.columns) for c in ("which", "of", "mix"))
    sizes = df.groupBy(F.col(source).alias("source")).agg(F.sum(size_of(F.col(text))).alias("source_size"))
    known = sh.cut(targets(sh.cut(sizes)).select(F.struct("source", "source_size", "target").alias(of)))
    if known.count() <= FEW_SOURCES:  # else the join deals rows by source, and adaptive execution splits hot ones
        known = F.broadcast(known)
    own = told_apart(df, [F.col(id_col), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")), F.col(source)], which)
    rate = F.when(F.col(f"{of}.source_size") > 0, F.col(f"{of}.target") / F.col(f"{of}.source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + F.when(draw(F.col(id_col), F.col(text), F.col(which)) < rate - F.floor(rate), 1).otherwise(0)
    joined = own.join(known, F.col(source).eqNullSafe(F.col(f"{of}.source")))
    mix_ = F.struct(size_of(F.col(text)).alias("size"), F.col(f"{of}.source_size").alias("source_size"), F.col(f"{of}.target").alias("target"), copies.cast("int").alias("copies"))
    return joined.select(*(F.col(f"`{c}`") for c in df.columns), mix_.alias(out)), out


def mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per row of ``df``."""
    own = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source"))
    out, of = rated(own, "doc_id", "text", "source")
    return out.select("doc_id", f"{of}.*").select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def sample(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``df`` as mixed: each row as many times as it is taken, with its number in the last column."""
    out, of = rated(df, id_col, text, source)
    copies = F.explode(F.sequence(F.lit(1), F.col(f"{of}.copies"))).alias(sh.fresh("copy", df.columns))
    return out.where(F.col(f"{of}.copies") > 0).select(*(F.col(f"`{c}`") for c in df.columns), copies)


def op7_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Contract query: all ``documents``."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (SELECT doc_id, source, text, row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) - 1 AS which, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM d GROUP BY source),
c AS (SELECT *, coalesce(sum(source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
        (sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS open, (sum(source_size) OVER ())::BIGINT AS total FROM s),
l AS (SELECT *, (1.5::DOUBLE * total - 2.0::DOUBLE * capped) / open AS level FROM c),
m AS (SELECT max(level) AS level FROM l),
t AS (SELECT l.source, l.source_size, least(2.0::DOUBLE * l.source_size, m.level * l.weight) AS target FROM l, m),
r AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
        ('0x' || substr(md5('7|' || coalesce(d.doc_id::VARCHAR, '') || '|' || md5(coalesce(d.text, '')) || CASE WHEN d.which > 0 THEN '|' || d.which ELSE '' END), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""
