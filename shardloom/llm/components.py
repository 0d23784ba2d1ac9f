"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.session import materialize


def _signature(edges: DataFrame) -> tuple:
    told = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(told)).first())


def components(links: DataFrame) -> DataFrame:
    """``a, b`` (long) -> ``node, root`` for every node of a link; root is the smallest node.

    Each round hooks every node to the smallest of its neighbours, first from
    larger neighbours, then among smaller ones, so the number of rounds grows with
    the logarithm of the longest chain. Only minima are gathered by node; rounds
    are written tables.
    """
    greater, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = links.where("a <> b").select(greater.alias("a"), smaller.alias("b")).distinct()
    edges = materialize(edges, "links")
    before = _signature(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hooked = both.join(low, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        hooked = materialize(hooked.distinct(), "hooked")
        low = hooked.groupBy("a").agg(F.min("b").alias("m"))
        down = hooked.join(low, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        edges = materialize(down.union(low.select("a", F.col("m").alias("b"))).distinct(), "stars")
        now = _signature(edges)
        if now == before:
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
        before = now
