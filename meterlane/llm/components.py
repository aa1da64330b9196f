"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlane import session
from meterlane.session import materialize


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); root is the smallest node it reaches.

    Each turn hangs all larger neighbours of a node on its smallest one, then all smaller
    ones; the forest gets flat in about log(nodes) turns, whatever its diameter. A hub's
    neighbours are never gathered: minima are aggregated and joined back. Null ends and
    loops are left out; an empty table gives an empty one.
    """
    forest = _aside(_ordered(edges.select("u", "v")), "edges")
    while True:
        forest = materialize(_small_star(_aside(_large_star(forest), "stars")), "forest")
        if _flat(forest):
            return forest.select(F.col("u").alias("node"), F.col("v").alias("root")).union(forest.select("v", "v").distinct())


def _aside(edges: DataFrame, label: str) -> DataFrame:
    """Edges as a table of their own: half a turn names them several times, and would repeat their whole plan for each."""
    return session.materialize(edges, label)


def _flat(forest: DataFrame) -> bool:
    """Whether each node either hangs on one other or carries others: then the stars are the components."""
    ends = (forest.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("carries"))
            .union(forest.select("v", F.lit(0), F.lit(1))))
    both = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("carries").alias("carries"))
    return not both.filter("hangs + carries > 1").agg(F.count("*")).first()[0]


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger end to its smaller one."""
    return (edges.filter(F.col("u") != F.col("v"))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return _ordered(both.filter(F.col("v") > F.col("u")).join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _ordered(hung.union(smallest.select("u", "m")))
