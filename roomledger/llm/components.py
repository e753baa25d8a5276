"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roomledger.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them; a is above b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.select(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38)))")).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the smallest node of its component.

    Each round is a few exchanges over at most as many rows as there are edges, stored in the shared
    folder. No neighbour list is gathered. The driver sees a count and a checksum a round.
    """
    now = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "components",
    )
    state = _state(now)
    while state[0]:
        now = stored(_small_star(_large_star(now)), "components")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct()
    )
