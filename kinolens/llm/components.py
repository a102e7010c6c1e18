"""Connected components of a large graph as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinolens.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node each one reaches; nodes without edges are not listed.

    Alternating large-star and small-star steps (Kiveris et al., "Connected
    Components in MapReduce and Beyond"): each step links neighbours to the
    least neighbour, which keeps the components and ends in stars after few
    rounds even for long chains. Every step is written to the shared folder. A
    hub's links are aggregated to its least neighbour before they are joined,
    so no neighbourhood is collected. Order is that of the node values; nulls
    are not allowed.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u") != F.col("v"))
    links = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "large-star")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        links = stored(small.select("e.u", "e.v").where(F.col("u") != F.col("v")).distinct(), "small-star")
        now = links.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
