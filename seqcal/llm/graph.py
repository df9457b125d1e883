"""Connected components by the least label of the neighbours and of the label itself, as joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .storage import written


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node, component (the smallest node that it reaches) for every node with an edge; self-loops and repeats are fine.

    A round takes each node's label to the least of its neighbours' labels, and then to the label that this node had, so
    chains shorten by half. Least labels are summed before they are shuffled, and the joins' sides are plain exchanges,
    so Spark can split a hub's rows.
    """
    ends = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = written(ends.union(ends.select("b", "a")).distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("component")), "labels")
    while True:
        heard = edges.join(labels, edges.a == labels.node).groupBy(F.col("b").alias("node")).agg(F.min("component").alias("heard"))
        nearer = labels.join(heard, "node").select("node", "component", F.least("component", "heard").alias("next"))
        known = labels.select(F.col("node").alias("next"), F.col("component").alias("onward"))
        rows = nearer.join(known, "next").select("node", F.least("next", "onward").alias("component"), (F.least("next", "onward") < F.col("component")).alias("changed"))
        rows = written(rows, "labels")
        labels = rows.select("node", "component")
        if rows.filter("changed").isEmpty():
            return labels
