"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut, run_count

ROUNDS = 60


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Links the larger (or the smaller-or-equal) neighbours of each node to the least of its neighbourhood."""
    low = pairs.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    out = pairs.join(low, "a")
    if large:
        return out.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = low.where("m < a").select("a", F.col("m").alias("b"))
    return out.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(own)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the least node reachable.

    edges: (a, b), any integers, either direction, repeats and loops allowed.
    A round takes a few shuffles of the edges left, rounds grow with the
    logarithm of the longest path; nothing but two numbers reaches the driver. A
    round has a task for every million edges at least: few edges, few files.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(ROUNDS):
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
        now = now.coalesce(run_count(mark[0]))
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        stars = _star(both, large=True).distinct()
        now = cut(_star(stars.where("b < a"), large=False).distinct())
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root")))
