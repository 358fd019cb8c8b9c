"""Connected components of an edge table, by large-star and small-star steps in the cluster.

Every step is two grouped minima and joins; its edges are written to the shared folder, which
cuts lineage and outlives lost executors, and the edges of the step before are deleted. Steps end
when the edges are stars around smallest vertices, which one grouping of the vertices tells.
Hot vertices combine before the shuffle, and joins on them are split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import mark, stage_last


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Connect neighbours of each vertex to the smallest among them and itself: the larger
    neighbours (``large``), or the smaller ones and the vertex."""
    if large:
        pairs = edges.select("u", "v").unionByName(
            edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("hub"), F.least("hub", "m").alias("m"))
    joined = pairs.join(smallest, pairs["u"] == smallest["hub"])
    if large:
        new = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            smallest.select(F.col("hub").alias("u"), F.col("m").alias("v")))
    return new.where("u <> v").distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every vertex is either a centre alone or has one edge, to a smaller centre."""
    ends = F.inline(F.array(F.struct(F.col("u").alias("vertex"), F.lit(1).alias("out"), F.lit(0).alias("into")),
                            F.struct(F.col("v").alias("vertex"), F.lit(0).alias("out"), F.lit(1).alias("into"))))
    roles = edges.select(ends).groupBy("vertex").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return roles.where((F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))).isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``component`` (the smallest vertex reachable) for every vertex of
    ``edges`` (u, v: long) that is not itself the smallest of its component."""
    since = mark(edges.sparkSession)
    edges = stage_last(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges", since)
    while not _are_stars(edges):
        edges = stage_last(_star(_star(edges, True), False), "edges", since)
    return edges.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
