"""Connected components by large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.llm.scratch import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its smallest neighbour (or itself)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (both.filter(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected(pairs: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, of the links in ``a`` and ``b``.

    Ends when a round leaves the edges as they were, seen by their number and an
    order-free sum of hashes; at that point every edge leads from a node to its root.
    """
    edges = written(pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u != v"), "edges")
    mark = None
    while True:
        stats = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(stats) == mark or not stats[0]:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = tuple(stats)
        edges = written(_small_star(_large_star(edges)), "edges")
