"""Connected components of links between numbered nodes, by alternating star contractions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faremeter.sources.scratch import stored


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction: a large star moves larger neighbours to the least one, a small star smaller ones."""
    pairs = _both_ways(links)
    near = pairs if large else pairs.filter(F.col("b") < F.col("a"))
    least = near.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    moved = pairs.filter(F.col("b") > F.col("a")) if large else near
    joined = moved.join(least, "a")
    out = joined.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        out = out.union(least.select("a", F.col("least").alias("b")))
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the least node that can be reached, itself included.

    Each round is a large star and a small star; both keep the components and bring every node nearer to its least one.
    It ends when a round changes nothing. The links of a round are stored, so a lost executor repeats one round only.
    """
    now = stored(links.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    state = None
    while True:
        sums = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if tuple(sums) == state:
            break
        state = tuple(sums)
        now = stored(_star(_star(now, large=True), large=False), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
