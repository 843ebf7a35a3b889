"""Connected components of a large graph by alternating large-star and small-star steps.

Each step links nodes to the smallest node in their neighbourhood, until every component is a star around its
smallest node; that takes a number of rounds in the order of the logarithm of the component size. The smallest neighbour is an aggregation
combined in the map tasks; it is staged before it is joined back, so that both sides of the join are plain shuffles
and adaptive execution can split a node with very many neighbours. Every round is written to the
shared folder: its lineage is short and a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.sinks.staging import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: two bigint columns a and b. Returns (node, component) for all nodes with an edge to another;
    component is the smallest node of it. Edges from a node to itself, repeated edges and nulls do not matter."""
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = stage(links.distinct(), "edges")
    state = _state(links)
    while state["edges"]:
        links = _small_star(_large_star(links))
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _state(links: DataFrame) -> dict:
    """A fingerprint of the set of edges."""
    row = links.agg(
        F.count(F.lit(1)).alias("edges"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("hash")
    ).first()
    return row.asDict()


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "smallest")
    moved = both.where("b > a").join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stage(moved.distinct(), "edges")


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    smallest = stage(links.groupBy("a").agg(F.min("b").alias("m")), "smallest")
    moved = links.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return stage(moved.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct(), "edges")
