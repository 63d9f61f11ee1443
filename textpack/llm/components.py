"""Connected components of a link table, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpack.session import materialize


def connect(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``: the smallest node reachable.

    Alternates two steps until nothing changes: each node hands its smallest neighbour to its larger
    neighbours, then each node links itself and its smaller neighbours to the smallest of them. The smallest neighbour
    is an aggregate that is reduced before the shuffle, and a node of many links is joined by a
    sort-merge join whose large keys are split, so no task holds all links of one node. Every round is written
    to the shared folder, which cuts the lineage. The rounds grow with the logarithm of the nodes.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    pairs = materialize(pairs, "links")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        large = materialize(larger.distinct(), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        smaller = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        own = least.select("u", F.col("m").alias("v"))
        pairs = materialize(smaller.unionByName(own).distinct(), "small-star")
        now = pairs.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
