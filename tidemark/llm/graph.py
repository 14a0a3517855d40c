"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Rows (node, root) for every node of ``edges`` (columns a, b, any order):
    ``root`` is the smallest node that can be reached.

    Each round links a node's larger neighbours to its smallest (large star),
    then its smaller ones (small star); the number of rounds grows with the
    logarithm of the longest path. Both sides of a join are stored first, so AQE
    can split the neighbours of a hub. Loops and repeated edges are harmless.
    ``batch_rows`` is for edges that are made out of long rows.
    """
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()
    now = stored(ordered, "star", batch_rows)
    before = _print(now)
    if not before[0]:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = stored(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("low")), "low")
        large = stored(both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct(), "star")
        lowest = stored(large.groupBy("a").agg(F.min("b").alias("low")), "low")
        small = large.join(lowest, "a").select(F.explode(F.array(F.struct("a", "low"), F.struct(F.col("b").alias("a"), "low"))).alias("e"))
        now = stored(small.select(F.col("e.a").alias("a"), F.col("e.low").alias("b")).where("a != b").distinct(), "star")
        after = _print(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
