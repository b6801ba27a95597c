"""Connected components of an edge table by alternating large-star and small-star steps.

Only joins and minima by node: a hub's neighbours are never gathered in one row, and never in one task
either. The neighbours of a node are dealt to salts (a hash of the neighbour); the node's minimum is that
of its salts' minima, goes back to each of its salts, and meets the neighbours there. Minima are combined
before the exchange. Every step is a reliable checkpoint, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

#: Into how many parts a node's neighbours are dealt, at least, and how many edges ask for one more.
SALTS, SALT_EDGES = 16, 1_000_000


def _with_least(edges: DataFrame, salts: int) -> DataFrame:
    """The edges (a, b) with m, the least neighbour of a."""
    salted = edges.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(salts)))
    parts = salted.groupBy("a", "salt").agg(F.min("b").alias("m"))
    least = parts.groupBy("a").agg(F.min("m").alias("m"))
    return salted.join(parts.select("a", "salt").join(least, "a"), ["a", "salt"]).select("a", "b", "m")


def _large_star(edges: DataFrame, salts: int) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = _with_least(both, salts).where("b > a").withColumn("m", F.least("m", "a"))
    return met.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame, salts: int) -> DataFrame:
    moved = _with_least(edges, salts).select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b")).where("a <> b")
    return moved.union(edges.groupBy("a").agg(F.min("b").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) but the roots, with the smallest node that it reaches."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut_lineage(edges)
    state = _state(edges)
    while state[0]:
        salts = max(SALTS, state[0] // SALT_EDGES)
        edges = cut_lineage(_small_star(cut_lineage(_large_star(edges, salts)), salts))
        if (now := _state(edges)) == state:
            break
        state = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
