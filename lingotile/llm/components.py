"""Connected components of a verified edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingotile.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``edges(a, b)``: the smallest node
    it can reach.  Each round takes the least label among a node's neighbours
    and then its label's own label; rounds grow with the logarithm of the
    longest path.  Hubs are pre-aggregated (min) before the shuffle, and each
    round's table is written to the shared folder."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    both = materialize(both.where(F.col("a") != F.col("b")).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_m")).select(
        "node", F.least("node", "_m").alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("_near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("_old"),
                                                F.least("label", "_near").alias("_new"))
        up = labels.select(F.col("node").alias("_new"), F.col("label").alias("_up"))
        moved = materialize(step.join(up, "_new").select(
            "node", "_old", F.least("_new", "_up").alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where(F.col("_old") != F.col("label")).isEmpty():
            return labels
