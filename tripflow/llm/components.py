"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs the larger neighbours of every node below its smallest neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m"))
    lowest = lowest.select("a", F.least("a", "m").alias("m"))
    return both.where(F.col("b") > F.col("a")).join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours below the smallest of them."""
    lowest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(lowest, "a").where(F.col("b") != F.col("m"))
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).union(lowest.select("a", F.col("m").alias("b")))


def connected(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, component): the smallest node reachable, for each node of an edge (a, b).

    Large and small stars in turn: every round keeps the components and shortens the
    paths, and at the end each node hangs below its smallest directly. Edges are only
    grouped and joined by node, so a node of very many edges is no task of its own;
    each round is written, so a lost executor repeats one round at most.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges, before = stored(edges.distinct(), "edges"), None
    for _ in range(most_rounds):
        edges = stored(_small_star(_large_star(edges)).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct()
            )
        before = now
    raise RuntimeError(f"components not settled after {most_rounds} rounds")
