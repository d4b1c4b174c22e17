"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logframe.llm.common import written


def connected(edges: DataFrame) -> DataFrame:
    """The component of every node of ``edges(a long, b long)``: ``node, label`` (its smallest node).

    Every round takes the smallest label among a node and its neighbours, then the label of that
    label, until nothing changes.  Minima are combined in the scan tasks, so a node with very many
    edges sends one row per task; its joins are skewed at most on plain keys, which adaptive
    execution splits.  Each round is written to the shared folder.  Null ends and loops are ignored.
    """
    both = edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b"), F.col("a")))
    both = written(both.distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).select(F.col("a").alias("node"), "label"), "labels")
    while True:
        near = (
            both.join(labels, both.b == labels.node)
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        hopped = labels.join(near, labels.node == near.a).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        over = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        moved = hopped.join(over, hopped.label == over.via).select(
            "node", F.least("label", "far").alias("label"), (F.least("label", "far") != F.col("old")).alias("moved")
        )
        moved = written(moved, "labels")
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels
