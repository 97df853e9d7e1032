"""Connected components of a stored graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import FEW, written


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label``, its component's smallest node, for all nodes of edges ``a``-``b``.

    Each round every node points to its smallest neighbour, if that is smaller, and the
    trees that this makes become the nodes of the next round; only edges between trees
    go on. Nodes at least halve in a round, and a group about one node is one tree, so
    that later rounds are small. It ends when no edge is left; only that, and whether
    pointers still moved, reaches the driver. Nodes are longs; loops and repeated edges
    do no harm. No edges give no rows. Frames are written by as many tasks as their
    rows need, not by all shuffle partitions.
    """
    left, labels, parts = edges.select("a", "b"), None, 1 + edges.count() // FEW
    while labels is None or left.take(1):
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = rooted(written(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
            .select("node", F.least("node", "least").alias("label")).coalesce(parts), "pointers"), parts)
        left = written(relabelled(left, roots).distinct().coalesce(parts), "edges")
        labels = roots if labels is None else written(
            labels.join(roots.select(F.col("node").alias("label"), F.col("label").alias("root")),
                        "label", "left").select("node", F.coalesce("root", "label").alias("label"))
            .coalesce(parts), "labels")
    return labels


def rooted(pointers: DataFrame, parts: int) -> DataFrame:
    """Stored ``node`` and ``label``, the end of each node's chain of pointers, written by ``parts`` tasks."""
    while True:
        above = pointers.select(F.col("node").alias("label"), F.col("label").alias("root"))
        jumped = written(pointers.join(above, "label").select(
            "node", F.col("root").alias("label"), (F.col("root") != F.col("label")).alias("moved"))
            .coalesce(parts), "pointers")
        pointers = jumped.select("node", "label")
        if not jumped.where("moved").take(1):
            return pointers


def relabelled(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between the labels of their ends, without loops; they may repeat."""
    of = [labels.select(F.col("node").alias(n), F.col("label").alias(f"of_{n}")) for n in "ab"]
    return edges.join(of[0], "a").join(of[1], "b").where("of_a != of_b").select(
        F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b"))
