"""Connected components of an edge list, distributed (alternating large-star / small-star).

Each round replaces edges by edges to the smallest neighbour (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014); the edges never grow beyond their first number and
a few rounds are enough. Both sides of each join are checkpointed tables, so a star whose centre
has a large part of all edges is split by the skew join instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterlens.llm.common import checkpointed


def _smallest(sym: DataFrame) -> DataFrame:
    return checkpointed(sym.groupBy("a").agg(F.min("b").alias("n")).select(
        F.col("a").alias("k"), F.least("a", "n").alias("m")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the node's smallest neighbour."""
    sym = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    low = _smallest(sym)
    return checkpointed(sym.join(low, F.col("a") == F.col("k")).where("b > a")
                        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are linked to the smallest of them."""
    low = _smallest(edges)
    linked = edges.join(low, F.col("a") == F.col("k")).where("b <> m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    own = low.where("k <> m").select(F.col("k").alias("a"), F.col("m").alias("b"))
    return checkpointed(linked.union(own).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, label) of every node with an edge; label: the smallest node reachable.

    Edges are undirected pairs of longs; nulls, loops and repeated edges do no harm. An empty
    edge list gives an empty result.
    """
    e = edges.select(F.col(src).cast("long").alias("x"), F.col(dst).cast("long").alias("y")) \
        .where("x <> y").select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    e = checkpointed(e.distinct())
    state = _state(e)
    while state[0]:
        e = _small_star(_large_star(e))
        new = _state(e)
        if new == state:
            break
        state = new
    return e.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        e.select(F.col("b"), F.col("b")).distinct())
