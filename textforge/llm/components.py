"""Connected components of a graph of links, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textforge.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the smallest node that it reaches.

    Each round takes the smallest label among the neighbours and then the label of the label, so the distance covered
    grows geometrically. Aggregates are combined before the shuffle and each round is a written table; nothing is
    collected but one number. A node with very many links is split by the join's skew handling.
    """
    both = links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct()
    both = materialize(both, "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "components")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        better = labels.join(near, "node").select("node", F.least("component", "near").alias("c"), F.col("component").alias("old"))
        jump = labels.select(F.col("node").alias("c"), F.col("component").alias("far"))
        moved = better.join(jump, "c").select("node", F.least("c", "far").alias("component"), "old")
        moved = materialize(moved, "components")
        labels = moved.select("node", "component")
        if moved.filter("component <> old").isEmpty():
            return labels
