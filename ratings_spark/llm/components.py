"""Connected components of a link table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node
    that can be reached.

    Alternating star contraction: each round hangs every node's larger
    neighbours on its least neighbour, then its smaller ones, until nothing
    moves; the number of rounds grows with the logarithm of the longest path.
    Aggregations are by node with only a minimum gathered, so a node with many
    links takes no more memory than others, and each round is written to the
    shared folder, which cuts the lineage."""
    edges = materialize(links.where("a <> b")
                        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .distinct(), "links")
    before = None
    while True:
        # Large star: every larger neighbour of a node joins the node's minimum.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.where("u <> v").distinct()
        # Small star: a node and its smaller neighbours join their minimum.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(small.select("u", F.col("m").alias("v")))
                 .where("u <> v").distinct())
        edges = materialize(small, "links")
        # Sums of hashes tell whether a round changed anything.
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
