"""Cutting lineage, scratch tables and row numbers, all in the shared folder of the session."""

from __future__ import annotations

import gc
import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of one task when rows are numbered, about.
RUN = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Only where driver and executors are one process may it be unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="linkwerk-"))
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and cut from its lineage by a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def tidy(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of plans that nothing refers to any more, such as those before a large cut.

    Its cleaner waits for a collection of the driver's heap, which may be long in coming.
    """
    gc.collect()
    spark._jvm.System.gc()


def scratch(spark: SparkSession, name: str) -> str:
    """A path for a table in the shared folder, new at each call."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def run_count(n_rows: int, run: int = RUN) -> int:
    """Tasks for rows of a few numbers each."""
    return max(1, math.ceil(n_rows / run))


def fresh(name: str, taken) -> str:
    """``name``, or with underscores before it, so that no column of ``taken`` is called so in any case."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, order: list[Column], name: str, run: int = RUN) -> DataFrame:
    """``df`` with the place of each row in ``order``, from 0, in column ``name``.

    Rows are dealt by ranges and cut, then each range is numbered by itself and
    the sizes of the ranges before it are added: no task holds more than a
    range. Rows that ``order`` ties are numbered in any order.
    """
    part, first = (fresh(c, [*df.columns, name]) for c in ("range_no", "range_first"))
    n = run_count(df.count(), run)
    dealt = cut((df.repartitionByRange(n, *order) if n > 1 else df.coalesce(1)).withColumn(part, F.spark_partition_id()))
    sizes = dict(dealt.groupBy(part).count().collect()) if n > 1 else {0: 0}  # one number for each range
    before, rows = 0, []
    for k in sorted(sizes):
        rows.append((k, before))
        before += sizes[k]
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    offsets = df.sparkSession.createDataFrame(rows, f"{part} int, {first} long")
    out = dealt.withColumn(name, place.cast("long")).join(F.broadcast(offsets), part)
    return out.withColumn(name, F.col(name) + F.col(first)).drop(part, first)
