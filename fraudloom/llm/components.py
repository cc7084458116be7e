"""Connected components by alternating large and small stars.

Edges are rewired until every node hangs on the smallest node of its component.
All steps are joins and aggregations on a node, each round is checkpointed, and
nothing but two numbers per round comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudloom.llm.common import stored

_MAX_ROUNDS = 60


def _smallest_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or itself)."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = _smallest_neighbour(both).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to its smallest neighbour."""
    smallest = _smallest_neighbour(edges)
    moved = edges.join(smallest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(smallest.select("a", F.col("m").alias("b")))


def _settle(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    done = stored(edges.distinct(), name)
    row = done.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return done, tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node of ``edges(a, b)``.

    Direction, order, repeats and self-loops of edges do not matter; nodes that
    occur in no edge to another node are not returned.
    """
    larger = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, mark = _settle(larger, "edges-0")
    for step in range(1, _MAX_ROUNDS):
        before = mark
        now, mark = _settle(_small_star(_large_star(now)), f"edges-{step}")
        if mark == before:
            break
    else:
        raise RuntimeError("components did not settle")
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
