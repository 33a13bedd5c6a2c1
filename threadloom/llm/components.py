"""Connected components by alternating star operations, each a join and an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.skew import skew_join
from threadloom.session import cut, discard


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a long, b long)``; ``root`` is the smallest node it can reach.

    Large and small stars (Kiveris et al., "Connected Components in MapReduce and Beyond") are repeated until the
    links no longer change; the rounds grow with the logarithm of the longest chain, not with the data. A node's
    smallest neighbour is found by an aggregate that combines before it shuffles, and a hub's many links are split
    by the join. Loops, repeated links and null ends are ignored. No links give no rows.
    """
    edges = cut(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = _digest(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("_low"))
        large = skew_join(both, lowest, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("_low").alias("b"))
        wide = cut(large.distinct())
        lowest = wide.groupBy("a").agg(F.min("b").alias("_low"))
        joined = skew_join(wide, lowest, "a")
        small = joined.filter(F.col("b") != F.col("_low")).select(F.col("b").alias("a"), F.col("_low").alias("b"))
        after = cut(small.unionByName(lowest.select("a", F.col("_low").alias("b"))).distinct())
        discard(edges, wide)
        edges, now = after, _digest(after)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _digest(edges: DataFrame) -> tuple:
    """Count and checksums of distinct links: equal when nothing has changed."""
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.bit_xor(F.xxhash64("b", "a")).alias("y")
    ).first()
    return row["n"], row["x"], row["y"]
