"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import cut


def _minimum(edges: DataFrame) -> DataFrame:
    """(u, m): the least neighbour of every u; combined before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minimum(both).select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = _minimum(edges)
    joined = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return joined.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the undirected links (u, v), long: the component
    is its smallest node.

    Each round is written to the shared folder, which ends its lineage; a node with many
    links is a hot key of joins that adaptive execution splits, and of combined sums.
    Links of a node with itself, null ends and repeated links are ignored.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(
        "u <> v"
    )
    state, mark = cut(edges.distinct(), "links"), None
    while True:
        # A digest of the set of links: unchanged means that all are stars around the least.
        now = state.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.hash("v", "u"))
        ).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        state = cut(_small_star(_large_star(state)), "links")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
