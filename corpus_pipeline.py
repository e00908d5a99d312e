"""A corpus pipeline: quality rules, near duplicates, decontamination, secrets, mixing.

Each stage takes what the one before it kept. All but the last return the
columns of ``documents``; the last adds ``copy``, the number of the repetition.

Defined results of every stage: null text counts as empty; a null id is an id
(ordered last); rows that are repeated are judged alike, but near duplicates
keep one of them; an empty table gives an empty one; other columns are kept,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkwerk.llm import decontamination, quality_divergence, secret_scan, simhash_dedup, source_mixing
from linkwerk.llm.shared import small_batches
from linkwerk.storage import fresh, remove, scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and stay close to a language's reference; null and empty texts fail."""
    return quality_divergence.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id; texts without words are one group."""
    small_batches(spark)
    return simhash_dedup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, near copy of one or question alone; an empty benchmark drops none."""
    small_batches(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind and n_chars counted anew where the length changed; null stays null."""
    small_batches(spark)
    before = fresh("length", docs.columns)
    new = secret_scan.mask(docs.withColumn(before, F.length("text")))
    n_chars = F.when(F.length("text") != F.col(before), F.length("text")).otherwise(F.col("n_chars"))
    return new.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).drop(before)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards the target weights of their sources."""
    return source_mixing.sample(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
]

#: Shingle hashes and connected components are beyond SQL; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet in the shared folder and read again.

    A stage's table is removed when the next one is written; the last written
    one stays, as the rows returned are read from it.
    """
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch(spark, f"stage{k}")
            docs.write.parquet(path)
            if last:
                remove(spark, last)
            docs, last = spark.read.parquet(path), path
    return docs
