"""Reports over matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import label
from ..storage import numbered


def breakdown(matches: DataFrame) -> DataFrame:
    return matches.groupBy("match_type").agg(F.count("*").alias("n_matches"))


def histogram(matches: DataFrame) -> DataFrame:
    """One row: matches by confidence, in the bands of the command line and of the report."""
    c = F.col("confidence")
    band = lambda lo, hi: F.count_if((c >= lo) & (c < hi))
    return matches.agg(band(90, 1000).alias("ge_90"), band(80, 90).alias("from_80_to_90"), band(-1, 80).alias("under_80"), band(70, 80).alias("from_70_to_80"), band(90, 95).alias("from_90_to_95"), band(95, 1000).alias("ge_95"))


def summary(matches: DataFrame) -> DataFrame:
    """One row of totals; zeros when there are no matches."""
    kind = F.col("match_type")
    return matches.agg(
        F.count("*").alias("n_matches"),
        F.count_if(kind.startswith("exact")).alias("n_exact"),
        F.count_if(kind.startswith("fuzzy")).alias("n_fuzzy"),
        F.count_if(kind.startswith("phonetic")).alias("n_phonetic"),
        F.count_if(kind.endswith("swapped")).alias("n_swapped"),
        F.count_if(F.col("confidence") >= 80).alias("n_high"),
        F.coalesce(F.avg("confidence"), F.lit(0.0)).alias("mean_confidence"),
    )


def ranked(matches: DataFrame) -> DataFrame:
    return matches.orderBy(F.desc("confidence"), "record_a", "record_b")


def top(matches: DataFrame, k: int = 10) -> DataFrame:
    return ranked(matches).limit(k)


def listing(matches: DataFrame, records: DataFrame, k: int | None = None) -> DataFrame:
    """Matches from the first rank on, with rank_no from 1, a readable type and both names."""
    order = [F.desc("confidence"), F.col("record_a"), F.col("record_b")]
    own = numbered(matches if k is None else top(matches, k), order, "rank_no").withColumns({"rank_no": F.col("rank_no") + 1, "label": label(F.col("match_type"))})
    name = lambda s: records.select(F.col("row_id").alias(f"record_{s}"), F.concat_ws(" ", "Vorname", "Name").alias(f"name_{s}"))
    return own.join(name("a"), "record_a").join(name("b"), "record_b").select("rank_no", "label", "confidence", "record_a", "name_a", "record_b", "name_b")


def throughput(n_rows: int, seconds: float, total: int = 7_500_000) -> dict:
    """Rows a second, and the seconds that ``total`` rows would take at that pace."""
    pace = n_rows / seconds if seconds > 0 else 0.0
    return {"rows_per_second": pace, "seconds_for_total": total / pace if pace else None}


def only(matches: DataFrame, kinds: list[str] | None = None, swapped: bool | None = None, least: float | None = None) -> DataFrame:
    """Matches of some types, in swapped order or not, from a confidence on."""
    if kinds is not None:
        matches = matches.where(F.col("match_type").isin(kinds))
    if swapped is not None:
        matches = matches.where(F.col("match_type").contains("swapped") == F.lit(swapped))
    return matches if least is None else matches.where(F.col("confidence") >= least)


def sample(df: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all), the same at every run."""
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("row_id").cast("string")).cast("binary")), "row_id").limit(n)
