"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.operators.sizing import join_measured
from notewright.session import materialised


def _towards_least(edges: DataFrame, both_ways: bool) -> DataFrame:
    """Re-hang neighbours on the least node near them (the large star with ``both_ways``, else the small star)."""
    if both_ways:
        near = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = join_measured(near, least, "a")  # of a hub's many neighbours none moves
    if both_ways:
        hung = hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        hung = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return hung.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b); a component is named by its least node.

    Large and small stars take turns until each node hangs on its component's least node,
    which takes a number of rounds logarithmic in the longest path. No node's neighbours are gathered in one place.
    """
    edges = materialised(edges.select("a", "b").filter("a <> b").distinct())
    before = None
    while True:
        edges = materialised(_towards_least(_towards_least(edges, True), False))
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)
