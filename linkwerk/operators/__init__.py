"""Checkers: one class per plan, all with the same calls."""

from __future__ import annotations

import time
from dataclasses import replace

from pyspark.sql import DataFrame

from ..plans import matching, report
from ..sources import records, sinks

PLANS = {"two_stage": matching.blocked_two_stage, "global": matching.global_two_stage, "blocked": matching.blocked_single_stage}


class DuplicateChecker:
    """Finds duplicates among records.

    mode: two_stage (blocks, exact then fuzzy with phonetics), global (no
    blocks) or blocked (blocks, one stage). use_parallel and n_workers are
    taken for compatibility; Spark schedules.
    """

    def __init__(self, mode: str = "two_stage", fuzzy_threshold: float = 0.8, use_parallel: bool = True, n_workers: int | None = None, use_phonetic: bool = True, max_block_size: int | None = matching.blocking.CHUNK, blank_plz: str = "reference"):
        self.plan = PLANS[mode]
        self.settings = matching.Settings(fuzzy=fuzzy_threshold, chunk=max_block_size, blank_plz=blank_plz, phonetic_blocks=use_phonetic)

    def find_duplicates(self, df: DataFrame, confidence_threshold: float = 70.0) -> DataFrame:
        """Matches (record_a, record_b, confidence, match_type, details) of canonical records, lazily."""
        return self.plan(df, replace(self.settings, confidence=confidence_threshold))

    analyze_duplicates = find_duplicates

    def report(self, matches: DataFrame, k: int = 10) -> dict:
        """Totals and the first matches, as plain values."""
        return {**report.summary(matches).first().asDict(), "top_matches": [r.asDict(recursive=True) for r in report.top(matches, k).collect()]}

    def export(self, matches: DataFrame, df: DataFrame, path: str, wide: bool = False, single: bool = False) -> bool:
        """Writes a folder of CSV files, or one file that a single task writes. False, and nothing, for no matches."""
        rows = (sinks.export_rows_wide if wide else sinks.export_rows)(matches, df)
        return (sinks.write_single_csv if single else sinks.write_csv)(rows, path)

    def listing(self, matches: DataFrame, df: DataFrame, k: int = 20) -> DataFrame:
        """The first k matches with rank, readable type and names."""
        return report.listing(matches, df, k)

    def block_statistics(self, df: DataFrame) -> DataFrame:
        """Number and sizes of the blocks, and how many are split."""
        key = matching.blocking.blocking_key(self.settings.blank_plz, self.settings.phonetic_blocks)
        return matching.blocking.statistics(df.withColumn("block_key", key), self.settings.chunk)

    def benchmark(self, df: DataFrame, sizes=(1_000, 5_000, 10_000), confidence: float = 70.0) -> list[dict]:
        """For each size the matches of a seeded sample, rows a second and the time all rows would take at that pace."""
        out = []
        for n in sizes:
            began = time.time()
            found = self.find_duplicates(report.sample(df, n), confidence).count()
            out.append({"n_rows": n, "n_matches": found, **report.throughput(n, time.time() - began)})
        return out

    @staticmethod
    def prepare(df: DataFrame, key: str | None = None, clean: bool = False) -> DataFrame:
        return records.canonical(records.clean(df) if clean else df, key)
