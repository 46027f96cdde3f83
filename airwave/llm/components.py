"""Connected components by label propagation with pointer jumping, as joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airwave.session import stored


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (a, b): the smallest node that it can reach.

    Each round takes the least label of the neighbours and then that label's own label, so the number
    of rounds grows with the logarithm of a path's length. Tables are stored between rounds; joins are
    between plain shuffles, so that Spark can split a node with very many links.
    """
    both = links.select("a", "b").where("a <> b")
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(
            F.least(F.col("node"), F.min("b")).alias("label")
        )
    )
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").select("a", "label")
        least = (
            near.select(F.col("a").alias("node"), "label")
            .unionByName(labels)
            .groupBy("node")
            .agg(F.min("label").alias("label"))
        )
        least = stored(least)
        further = least.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = stored(
            least.join(further, "label").select("node", F.col("next").alias("label"))
        )
        before = labels.withColumnRenamed("label", "old")
        moved = jumped.join(before, "node").where("label <> old").limit(1).count()
        labels = jumped
        if not moved:
            return labels
