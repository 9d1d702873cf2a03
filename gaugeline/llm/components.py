"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import remove, store


def large_star(edges: DataFrame) -> DataFrame:
    """Every node joins its larger neighbours to the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("least"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("least").alias("b")).distinct())


def small_star(edges: DataFrame) -> DataFrame:
    """Every node joins its smaller neighbours and itself to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = (edges.join(least, "a").where("b > least")
             .select(F.col("b").alias("a"), F.col("least").alias("b")))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def connected_components(links: DataFrame, name: str) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b: long); the component is its least node.

    Self-links, repeated links and either direction are allowed. Each round is stored in the shared
    folder; the driver sees a count and a checksum. Minima are combined before the shuffle, and rows
    of a node with very many links can be split by Spark, for they only meet its minimum in a join.
    """
    edges = store(links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                               F.least("a", "b").alias("b")).distinct(), name)

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    now = state(edges)
    while now[0]:
        older, before = edges, now
        edges = store(small_star(large_star(edges)), name)
        now = state(edges)
        remove(older)
        if now == before:
            break
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")))
            .distinct())
