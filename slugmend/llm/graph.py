"""Connected components by alternating large-star and small-star steps.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014): each
step reconnects every vertex's neighbours to the smallest of them, until the
edge set is a star around the smallest vertex of each component. Edges live in
tables written to the shared checkpoint folder; the driver sees one number
a round, that of the vertices that are not yet settled. The smallest neighbours (a
partial and a final ``min``) are written before they meet the edges, so both sides
of that join are plain shuffles and AQE can split the hub of a large star.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slugmend.sources.cuts import materialise


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u > v)."""
    pairs = edges.select(F.col("u").alias("x"), F.col("v").alias("y"))
    if large:
        pairs = pairs.unionByName(edges.select(F.col("v").alias("x"), F.col("u").alias("y")))
    lowest = materialise(pairs.groupBy("x").agg(F.min("y").alias("low")), "lowest")
    low = F.least(F.col("x"), F.col("low"))
    joined = pairs.join(lowest, "x").select("x", "y", low.alias("m"))
    if large:  # the larger neighbours go to the smallest
        out = joined.filter(F.col("y") > F.col("x")).select(F.col("y").alias("u"), F.col("m").alias("v"))
    else:  # the smaller neighbours and the vertex itself go to the smallest
        out = joined.select(F.col("y").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select(F.col("x").alias("u"), F.col("m").alias("v"))
        )
    out = out.filter(F.col("u") > F.col("v"))
    return out if large else out.distinct()  # a large step makes no more edges than it was given


def _unsettled(edges: DataFrame) -> int:
    """Vertices that keep the edges from being stars around smallest vertices: with two centres, or centre and leaf."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("leaf"), F.lit(1).alias("centre"))
    )
    roles = ends.groupBy("x").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return roles.filter(F.col("leaf") + F.col("centre") > 1).count()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node of an edge, root the smallest node of its component."""
    now = materialise(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col("u") > F.col("v")).distinct(),
        "edges",
    )
    while _unsettled(now):
        large = materialise(_star(now, True), "large-star")
        now = materialise(_star(large, False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def merged(first: DataFrame, second: DataFrame) -> DataFrame:
    """Components ``first``, joined further as ``second`` says, whose nodes are roots of ``first`` or not in it."""
    over = second.select(F.col("node").alias("root"), F.col("root").alias("over"))
    joined = first.join(over, "root", "left").select("node", F.coalesce("over", "root").alias("root"))
    return joined.unionByName(second.join(first.select("node"), "node", "left_anti"))
