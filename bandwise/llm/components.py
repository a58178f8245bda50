"""Connected components of an edge table, by minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwise.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) of every node of ``edges`` (a, b).

    Each round takes the least label among a node and its neighbours and then the label
    of that label; labels are written to the shared folder between rounds.
    The number of rounds is logarithmic in the longest path on star-like groups.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                   .where("a != b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(
            F.min("component").alias("m"))
        low = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "component", F.least("component", "m").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("jumped"))
        after = written(low.join(jump, "low", "left").select(
            "node", "component", F.least("low", "jumped").alias("next")), "labels")
        changed = not after.where("next != component").isEmpty()
        labels = after.select("node", F.col("next").alias("component"))
        if not changed:
            return labels
