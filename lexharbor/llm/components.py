"""Connected components of a table of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``a``, ``b``): the least node it reaches.

    Each round hangs every node under its least neighbour, if that is less, and takes the nodes to
    the tops of the trees so made, whose paths halve from step to step. Then a link joins the tops
    of its two ends: links within a tree go, those that fall together are one, so a round reads
    what is left, not all links again. A top either takes in a neighbour or hangs under another in
    the next round, so nodes at least halve in two rounds. What a round makes is written to the
    shared folder, which cuts the lineage. A hot node costs one row in the partial aggregation of
    each task.
    """
    left = materialize(_ordered(links), "links")
    ends = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    labels = ends.withColumn("component", F.col("node"))
    while not left.isEmpty():
        tops = _tops(materialize(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("top")),
                                 "trees"))
        labels = materialize(_moved(labels, tops, "component"), "labels")
        left = materialize(_ordered(_moved(_moved(left, tops, "a"), tops, "b")), "links")
    return labels


def _ordered(links: DataFrame) -> DataFrame:
    return (links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .filter("a != b").distinct())


def _moved(rows: DataFrame, tops: DataFrame, column: str) -> DataFrame:
    """``rows`` with the nodes of ``column`` replaced by their tops; others stay."""
    known = tops.select(F.col("node").alias(column), F.col("top").alias("of"))
    return rows.join(known, column, "left").select(
        *[F.coalesce("of", c).alias(c) if c == column else F.col(c) for c in rows.columns])


def _tops(trees: DataFrame) -> DataFrame:
    """``node, top`` of trees given as ``node, top`` with the node above each as its top."""
    while True:
        above = trees.select(F.col("node").alias("top"), F.col("top").alias("next"))
        stepped = materialize(trees.join(above, "top", "left").select(
            "node", F.coalesce("next", "top").alias("top"),
            F.col("next").isNotNull().alias("moved")), "trees")
        trees = stepped.select("node", "top")
        if stepped.filter("moved").isEmpty():
            return trees
