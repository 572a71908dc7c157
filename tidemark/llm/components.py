"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import materialise


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the smallest node the node sees."""
    both = _both_ways(links)
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("least"))
    joined = both.filter("b > a").join(least, F.col("a") == F.col("node"))
    return joined.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node itself, are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    low = least.withColumnRenamed("a", "node")
    joined = down.join(low, F.col("a") == F.col("node")).select(
        F.col("b").alias("a"), F.col("least").alias("b"))
    return joined.unionByName(least.select("a", F.col("least").alias("b"))) \
        .filter("a <> b").distinct()


def _sum_of(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected(links: DataFrame) -> DataFrame:
    """`node` and `component` (its smallest node) for every node that `links` (a, b) names.

    The number of rounds grows with the logarithm of the longest chain. Every round is written
    to the shared scratch folder, so a lost executor costs one round.
    """
    links = materialise(links.filter("a <> b").distinct(), "links")
    before = _sum_of(links)
    while before[0]:
        links = materialise(_small_star(_large_star(links)), "links")
        after = _sum_of(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
