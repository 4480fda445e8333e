"""Connected components of a graph that is given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label is one of the component's nodes.

    Each round every node hooks on its smallest neighbour, chains are shortened to their ends by pointer doubling,
    and links between different ends are kept for the next round. Nodes shrink geometrically. A hub costs one row
    a link, partially aggregated; neighbours are never gathered in lists.
    """
    edges = materialize(tidy(edges.select("a", "b")), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("label"))
        parents = materialize(parents, "parents")
        while True:
            up = parents.select(F.col("node").alias("label"), F.col("label").alias("next"))
            parents = materialize(parents.join(up, "label").select("node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved")), "parents")
            moved = not parents.where("moved").isEmpty()
            parents = parents.drop("moved")
            if not moved:
                break
        if labels is None:
            labels = parents
        else:
            later = parents.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = materialize(labels.join(later, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")
        ends = lambda c: parents.select(F.col("node").alias(c), F.col("label").alias(f"{c}_end"))
        edges = materialize(tidy(edges.join(ends("a"), "a").join(ends("b"), "b").select(F.col("a_end").alias("a"), F.col("b_end").alias("b"))), "links")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")) if labels is None else labels


def tidy(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
