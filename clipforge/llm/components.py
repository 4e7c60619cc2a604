"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipforge.llm.common import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): the smallest node that each node of an edge reaches.

    Every round takes the smallest label among the neighbours and then the label of
    that label (pointer jumping), so long chains shorten by half. Rounds are written
    to the shared folder; nothing but a count of changes reaches the driver."""
    both = edges.select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m"))
                    .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy("a").agg(F.min("label").alias("m")))
        lower = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        lower = stored(lower, "labels")
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        nxt = stored(lower.join(jump, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("next", "label")).alias("label")), "labels")
        labels = nxt.select("node", "label")
        if nxt.where("old <> label").isEmpty():
            return labels
