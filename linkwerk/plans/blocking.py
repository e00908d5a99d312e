"""Blocking keys, chunks and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names
from ..functions.phonetics import cologne

CHUNK = 10_000


def _key(plz: Column, street: Column) -> Column:
    has = lambda c: F.coalesce(c, F.lit("")) != ""

    def of(x: Column) -> Column:
        return (
            F.when(has(x["plz"]) & has(x["street"]), F.concat_ws("_", x["plz"], x["street"]))
            .when(has(x["plz"]), F.concat(F.lit("plz_only_"), x["plz"]))
            .when(has(x["street"]), F.concat(F.lit("street_only_"), x["street"]))
            .otherwise("no_address")
        )

    return names.let(F.struct(plz.alias("plz"), street.alias("street")), of)


def blocking_key(blank_plz: str = "reference", phonetic: bool = True) -> Column:
    """Postal code and street. blank_plz 'null' takes a code without digits as none, 'reference' as 00000."""
    plz = names.postal_code(F.col("Plz"))
    if blank_plz == "null":
        plz = F.when(F.coalesce("Plz", F.lit("")).rlike("[0-9]"), plz)
    key = _key(plz, names.street(F.col("Strasse")))
    if not phonetic or blank_plz != "null":  # a code is never blank otherwise, so no key is without address
        return key
    sounds = F.array(cologne(F.col("Vorname")), cologne(F.col("Name")))
    named = names.let(sounds, lambda x: F.when((x[0] != "") | (x[1] != ""), F.concat_ws("_", F.lit("phon"), x[0], x[1])).otherwise("no_address"))
    return names.let(key, lambda k: F.when(k == "no_address", named).otherwise(k))


def blocking_key_literal() -> Column:
    return _key(names.postal_code(F.col("Plz"), null_as_blank=False), names.street_literal(F.col("Strasse")))


def chunked(df: DataFrame, size: int | None = CHUNK) -> DataFrame:
    """Adds chunk_no: blocks cut into ``size`` rows by row_id; None leaves blocks whole, without a sort."""
    if size is None:
        return df.withColumn("chunk_no", F.lit(0))
    place = F.row_number().over(Window.partitionBy("block_key").orderBy("row_id")) - 1
    return df.withColumn("chunk_no", F.floor(place / size).cast("int"))


def block_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("block_key").agg(F.count("*").alias("n_rows"))


def chunk_sizes(df: DataFrame) -> DataFrame:
    """Chunks that hold a pair."""
    return df.groupBy("block_key", "chunk_no").agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def reduction(df: DataFrame) -> DataFrame:
    """One row: blocks, rows, pairs without and with blocking, and the share that is saved; 0 for no rows."""
    pairs = lambda n: (n * (n - 1) / 2).cast("long")
    by_chunk = df.groupBy("block_key", "chunk_no").agg(F.count("*").alias("n"))
    s = by_chunk.agg(
        F.count_if(F.col("n") > 1).alias("n_blocks"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(pairs(F.col("n"))), F.lit(0)).alias("pairs_blocked"),
    ).withColumn("pairs_all", pairs(F.col("n_rows")))
    saved = F.when(F.col("pairs_all") > 0, F.lit(100.0) * (F.col("pairs_all") - F.col("pairs_blocked")) / F.col("pairs_all")).otherwise(F.lit(0.0))
    return s.select("n_blocks", "n_rows", "pairs_all", "pairs_blocked", saved.alias("saved_percent"))


def statistics(df: DataFrame, size: int | None = CHUNK) -> DataFrame:
    """One row: blocks, rows, mean and largest size, and how many blocks exceed ``size``; mean and largest are null for no rows."""
    over = F.lit(0).cast("long") if size is None else F.count_if(F.col("n_rows") > size)
    return block_sizes(df).agg(F.count("*").alias("n_blocks"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.avg("n_rows").alias("mean_size"), F.max("n_rows").alias("largest"), over.alias("n_split"))
