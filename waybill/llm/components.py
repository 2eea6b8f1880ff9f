"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from waybill.llm.tables import forget, keep


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node tells its larger neighbours the smallest node it knows."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").filter("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node tells its smaller neighbours, and itself, the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    told = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return told.union(least.select("a", F.col("m").alias("b")))


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not its component's smallest.

    Steps end when the stars stay as they are, after about log2 of the longest path. Every step is
    stored; a node with very many neighbours is a skewed join key, which Spark splits.
    """
    now = keep(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _mark(now)
    while seen[0]:
        after = keep(_small_star(_large_star(now).distinct()).distinct(), "stars")
        forget(now)
        now, before, seen = after, seen, _mark(after)
        if seen == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
