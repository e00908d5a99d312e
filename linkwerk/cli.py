"""python -m linkwerk.cli: find duplicates in a table of addresses and export them."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .operators import PLANS, DuplicateChecker
from .plans import report
from .sources import records


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("input", help="Parquet path, or a JDBC url with --table or --query")
    p.add_argument("--table")
    p.add_argument("--query", help="SQL that the database runs")
    p.add_argument("--newest-first", action="store_true")
    p.add_argument("--key", help="unique column that numbers the rows")
    p.add_argument("--mode", choices=list(PLANS), default="two_stage")
    p.add_argument("--limit", type=int)
    p.add_argument("--confidence", type=float, default=70.0)
    p.add_argument("--fuzzy-threshold", type=float, default=0.7)
    p.add_argument("--no-parallel", action="store_true", help="accepted; Spark schedules")
    p.add_argument("--benchmark", action="store_true", help="time seeded samples first")
    p.add_argument("--output", default="duplicates.csv", help="a folder of CSV files")
    p.add_argument("--single-file", action="store_true", help="one CSV file, written by one task")
    p.add_argument("--wide", action="store_true", help="with display name, source columns and scores")
    return p


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if args.table or args.query:
        df = records.load(spark, args.input, args.table, args.limit, args.newest_first, query=args.query)
    else:
        df = spark.read.parquet(args.input)
        df = df if args.limit is None else df.limit(args.limit)
    df = DuplicateChecker.prepare(df, args.key)
    checker = DuplicateChecker(args.mode, args.fuzzy_threshold, not args.no_parallel)
    for r in checker.benchmark(df, confidence=args.confidence) if args.benchmark else ():
        print(f"{r['n_rows']} rows: {r['n_matches']} matches, {r['rows_per_second']:.0f} rows/s, {r['seconds_for_total'] / 3600:.1f} h for 7.5 million")
    checker.block_statistics(df).show(truncate=False)
    matches = checker.find_duplicates(df, args.confidence).cache()
    report.breakdown(matches).show(truncate=False)
    report.summary(matches).show(truncate=False)
    checker.listing(matches, df).show(20, truncate=False)
    done = checker.export(matches, df, args.output, args.wide, args.single_file)
    print(f"written to {args.output}" if done else "no matches")


if __name__ == "__main__":
    main()
