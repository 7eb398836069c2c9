"""Connected components of a graph given by its edges, by alternating large and small stars.

Every round replaces edges by edges to smaller neighbours until the graph is a set of stars, each around its smallest id:
first every node hands its larger neighbours to its smallest one, then its smaller ones. Rounds grow with the logarithm of
a component's size. All steps are minima per node (combined before the shuffle) and equi-joins; no neighbour list is ever
collected, so a hub may have a third of all edges. Each round is written to the shared folder: lineage stays short and a
lost executor costs one round at most. Only a count and a checksum come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.session import materialize


def star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (a, b), a > b, after one large or small star step."""
    if large:
        pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        moved = pairs.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return moved.distinct()
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    moved = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).join(least, "u").select(
        F.col("v").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``id, component_id`` (the smallest id reachable) of every id that has an edge to another id."""
    pairs = edges.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b"))
    now = materialize(pairs.filter("a <> b").distinct(), "edges")
    mark = signature(now)
    while mark[0]:
        now = materialize(star(star(now, True), False), "edges")
        before, mark = mark, signature(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("id"), F.col("b").alias("component_id")).unionAll(
        now.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())


def signature(edges: DataFrame) -> tuple:
    """Edges, and a sum of their hashes."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
