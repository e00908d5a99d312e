"""Matching new records against a stored base, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..plans import matching


def new_matches(base: DataFrame, fresh: DataFrame, s: matching.Settings = matching.Settings()) -> DataFrame:
    """Matches that involve a fresh record; only blocks with one are compared."""
    key = matching.blocking.blocking_key(s.blank_plz, s.phonetic_blocks)
    touched = fresh.select(key.alias("__key")).distinct()
    old = base.withColumn("__key", key).join(touched, "__key", "left_semi").drop("__key")
    found = matching.blocked_two_stage(old.unionByName(fresh), s)
    a, b = (fresh.select(F.col("row_id").alias(c)) for c in ("record_a", "record_b"))
    return found.join(a, "record_a", "left_semi").unionByName(found.join(a, "record_a", "left_anti").join(b, "record_b", "left_semi"))


def match_stream(stream: DataFrame, base: DataFrame, sink, s: matching.Settings = matching.Settings()) -> DataStreamWriter:
    """A writer that passes each batch's matches to ``sink(matches, batch_id)``."""
    return stream.writeStream.foreachBatch(lambda batch, k: sink(new_matches(base, batch, s), k))
