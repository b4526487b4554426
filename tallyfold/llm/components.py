"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; root is the smallest node reachable.

    ``links`` has the bigint columns ``a`` and ``b``; loops, repeated links and
    links with a null are ignored; no links give an empty result. Large-star and
    small-star steps (Kiveris et al., 2014) alternate until the links are stars.
    Each step is joins and minima of rows, with map-side combining, and is written
    to the shared folder, so a lost executor costs one step at most.
    """
    edges = materialize(
        links.where("a <> b")
        .select(F.greatest("a", "b").cast("bigint").alias("a"), F.least("a", "b").cast("bigint").alias("b"))
        .distinct(),
        "links",
    )
    before = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        # Large star: every larger neighbour moves to the smallest neighbour.
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = materialize(large.where("a <> b"), "large-star")
        # Small star: smaller neighbours and the node itself move to the smallest.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = materialize(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
