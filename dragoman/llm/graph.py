"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dragoman.llm.common import through_table


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (itself included)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; edges point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    linked = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of undirected ``edges`` (a, b): (node, component), component being the smallest node.

    Alternating large-star and small-star rounds; a hub's rows are only joined to one minimum, so
    AQE may split them over tasks, and no neighbour list is ever gathered. Each round is a written
    table, so lineage stays short and a lost executor rereads files. Loops and nulls are ignored;
    a node without an edge to another node has no row.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b").distinct()
    edges = through_table(edges, "components")
    state = _state(edges)
    while True:
        edges = through_table(_small_star(_large_star(edges)), "components")
        now = _state(edges)
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
