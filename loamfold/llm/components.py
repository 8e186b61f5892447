"""Connected components of a table of links, by rounds of large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamfold.session import drop_stored, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``; the component is its smallest node.

    Nodes are longs; a link with a null end or with two equal ends joins nothing; repeated links are harmless; no
    links give no rows. A round moves each node's neighbours to the smallest of them, so a union-find forest flattens
    in rounds that grow with the logarithm of its depth. Each round is written to the shared folder and takes the place of the one before. Minima combine
    before the shuffle and links are joined on their larger end, whose partitions can be split: one hub with most
    links is harmless.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = stored(edges.distinct(), "links")
    before = None
    while True:
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38)"))).first())
        if state == before or not state[0]:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        shorter = stored(hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        drop_stored(edges)
        edges = shorter
    # a star now: every node but the smallest points to it
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
