"""Connected components by alternating large-star and small-star steps.

A large-star step links every larger neighbour of a node with the smallest node around it; a
small-star step does so with the smaller neighbours and the node itself. Both keep the
components. When every node has one link, to a node without links of its own, those links
are the result. The smallest neighbour comes from an aggregation that adds up before the
shuffle, and reaches the links by an equi-join, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tapewire.llm.store import Scratch


def _with_smallest(edges: DataFrame) -> DataFrame:
    """Each edge (u, v) with the smallest of u and all its v."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    smallest = smallest.select("u", F.least("u", "m").alias("m"))
    return edges.join(smallest, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    out = _with_smallest(both).where("v > u")
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    near = _with_smallest(edges)
    ends = F.explode(F.array(F.col("v"), F.col("u"))).alias("u")
    return near.select(ends, F.col("m").alias("v")).where("u > v").distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """Whether every node on the left has one link, to a node that is never on the left."""
    ends = edges.select("u", F.lit(1).alias("left"), F.lit(0).alias("right")).union(
        edges.select("v", F.lit(0), F.lit(1)).distinct()
    )
    nodes = ends.groupBy("u").agg(F.sum("left").alias("left"), F.max("right").alias("right"))
    return nodes.where("left > 1 or (left > 0 and right > 0)").isEmpty()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) of all nodes but the smallest of each component.

    ``edges``: (u, v), longs. Links to oneself and repeats count once or not at all. A node
    without links, and the smallest node of a component, has no row. No edges give no rows.
    """
    edges = edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = scratch.save(edges.distinct(), "edges")
    while not _is_star_forest(edges):
        half = scratch.save(_large_star(edges), "large-star")
        scratch.drop(edges)
        edges = scratch.save(_small_star(half), "small-star")
        scratch.drop(half)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
