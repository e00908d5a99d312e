"""Exports: two rows per match, the first record and the second."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import full_name
from ..storage import remove

_PERSON = {"vorname": "Vorname", "name": "Name", "name2": "Name2", "strasse": "Strasse", "hausnummer": "HausNummer", "plz": "Plz", "ort": "Ort", "crefo": "Crefo", "geburtstag": "Geburtstag", "jahrgang": "Jahrgang"}
COLUMNS = ["match_id", "confidence", "match_type", "position", "index", *_PERSON]
WIDE = ["crefo1_crefo2", "record_position", "confidence_score", "match_type", "record_index", "name", "vorname", "name_field", *list(_PERSON)[2:], "erfasst", "quelle_95", "name_similarity_normal", "name_similarity_swapped", "is_swapped", "address_match_ratio"]


def _both(matches: DataFrame, records: DataFrame) -> DataFrame:
    side = lambda s: records.select(F.col("row_id").alias(f"record_{s}"), F.struct(*(c for c in records.columns)).alias(s))
    both = matches.join(side("a"), "record_a").join(side("b"), "record_b")
    known = (F.coalesce("a.Crefo", F.lit("")) != "") & (F.coalesce("b.Crefo", F.lit("")) != "")
    name = F.when(known, F.concat_ws("_", "a.Crefo", "b.Crefo")).otherwise(F.concat_ws("_", "record_a", "record_b"))
    return both.withColumn("match_id", name).withColumn("r", F.explode(F.array(F.struct(F.lit("A").alias("position"), F.col("a").alias("of")), F.struct(F.lit("B").alias("position"), F.col("b").alias("of")))))


def export_rows(matches: DataFrame, records: DataFrame) -> DataFrame:
    person = [F.col(f"r.of.{c}").alias(k) for k, c in _PERSON.items()]
    return _both(matches, records).select("match_id", "confidence", "match_type", F.col("r.position").alias("position"), F.col("r.of.row_id").alias("index"), *person)


def export_rows_wide(matches: DataFrame, records: DataFrame) -> DataFrame:
    """With display name, source columns and, for matches by similarity, the scores."""
    of = lambda c: F.col(f"r.of.{c}")
    scored = F.col("details.best_score").isNotNull()
    person = [of(c).alias(k) for k, c in list(_PERSON.items())[2:]]
    return _both(matches, records).select(
        F.col("match_id").alias("crefo1_crefo2"),
        F.col("r.position").alias("record_position"),
        F.col("confidence").alias("confidence_score"),
        "match_type",
        of("row_id").alias("record_index"),
        full_name(of("Vorname"), of("Name")).alias("name"),
        of("Vorname").alias("vorname"),
        of("Name").alias("name_field"),
        *person,
        of("Erfasst").cast("string").alias("erfasst"),
        of("Quelle_95").alias("quelle_95"),
        F.col("details.normal_score").alias("name_similarity_normal"),
        F.col("details.swapped_score").alias("name_similarity_swapped"),
        F.col("details.is_swapped").alias("is_swapped"),
        F.when(scored, F.col("details.address_ratio")).alias("address_match_ratio"),
    )


def write_csv(rows: DataFrame, path: str) -> bool:
    """A folder of CSV files with headers, one for each task; none for no rows."""
    if rows.isEmpty():
        return False
    rows.write.options(header=True, escape='"').csv(path)
    return True


def write_single_csv(rows: DataFrame, path: str) -> bool:
    """One UTF-8 file with a byte-order mark, written by one task; none for no rows."""
    if rows.isEmpty():
        return False
    spark, parts = rows.sparkSession, f"{path}.parts"
    marked = rows.withColumnRenamed(rows.columns[0], "\ufeff" + rows.columns[0])
    marked.coalesce(1).write.options(header=True, escape='"', emptyValue="").mode("overwrite").csv(parts)
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = next(f.getPath() for f in fs.listStatus(fs_path(parts)) if f.getPath().getName().startswith("part-"))
    fs.delete(fs_path(path), False)
    fs.rename(found, fs_path(path))
    remove(spark, parts)
    return True
