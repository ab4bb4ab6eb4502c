"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node among its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    found = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return found.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them; edges point from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a long, b long); a component is named by its smallest node.

    Rounds grow with the logarithm of the longest path. A hub's edges never meet: the smallest neighbour is an
    aggregate, and joins with it can be split. Self-links and repeats are ignored; without edges there are no rows.
    """
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(ordered.distinct())
    state = _state(current)
    while state[0]:
        current = stored(_small_star(_large_star(current)))
        state, before = _state(current), state
        if state == before:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
