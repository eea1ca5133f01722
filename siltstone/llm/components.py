"""Connected components of a link table, by alternating large and small stars.

Each round points every node's neighbours at the smallest node it knows; rounds end when no link
changes, after about as many as the logarithm of the longest chain. Links are rows and are only
grouped and joined, so no component is ever in one place. Tasks follow the number of links, however
many partitions a shuffle has: a few links in hundreds of partitions would be mostly empty files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import checkpointed

ROWS_PER_TASK = 50_000


def compact(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most so many rows, in no more partitions than these fill."""
    return df.coalesce(max(1, -(-rows // ROWS_PER_TASK)))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node."""
    edges = checkpointed(links.select("a", "b").filter("a != b").distinct())
    n = edges.count()
    edges, before = compact(edges, n), None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = compact(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), 2 * n)
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
        down = compact(compact(down, n).distinct(), n)
        least = compact(down.groupBy("a").agg(F.min("b").alias("m")), n)
        small = down.join(least, "a")
        moved = small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pointed = compact(moved.union(least.select("a", F.col("m").alias("b"))), 2 * n)
        edges = checkpointed(compact(pointed.distinct(), n))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, n = state, state[0]
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(compact(roots, n))
