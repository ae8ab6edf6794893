"""Connected components of a graph that no single machine need hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lavra.session import stage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Every node of the edges with the smallest node it is connected to: (node, component).

    Labels take the smallest label among their neighbours and then the label of that label, so
    long chains halve in each pass. Hot nodes are minima over their edges, summed up before the
    shuffle.
    """
    both = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = stage(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    labels = stage(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "cc")
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy("a")
            .agg(F.min("component").alias("least"))
        )
        moved = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("old"), F.least("component", "least").alias("to")
        )
        jump = labels.select(F.col("node").alias("n2"), F.col("component").alias("further"))
        after = stage(
            moved.join(jump, F.col("to") == F.col("n2"), "left").select(
                "node", "old", F.least("to", F.coalesce("further", "to")).alias("component")
            ),
            "cc",
        )
        labels = after.select("node", "component")
        if after.where("old <> component").isEmpty():
            return labels
