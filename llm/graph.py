"""Connected components of an edge table, by joins and partial aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of `edges(a, b)`; the root is one vertex of the component.

    Each round merges every vertex into its smallest neighbour, or itself, and keeps the edges
    between what is left. A round takes away half of the vertices or nearly so, whatever the
    shape, chains included. A vertex with very many neighbours is one row of partial minima,
    and no list of neighbours is built. Every round is written to the shared folder.
    """
    left = stored(_ordered(edges), "edges")
    labels = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("b"))
        parents = stored(smallest.select(F.col("a").alias("v"), F.least("a", "b").alias("m")), "parents")
        if labels is None:
            labels = parents.select("v", F.col("m").alias("root"))
        else:
            step = parents.select(F.col("v").alias("root"), "m")
            labels = labels.join(step, "root", "left").select("v", F.coalesce("m", "root").alias("root"))
            labels = stored(labels, "labels")
        ends = left
        for side in ("a", "b"):
            ends = ends.join(parents.select(F.col("v").alias(side), F.col("m").alias(f"{side}_")), side)
        left = stored(_ordered(ends.select(F.col("a_").alias("a"), F.col("b_").alias("b"))), "edges")
    if labels is None:
        return left.select(F.col("a").alias("v"), F.col("b").alias("root"))
    return labels


def _ordered(edges: DataFrame) -> DataFrame:
    """Each edge once, without loops."""
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct()
