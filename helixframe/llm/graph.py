"""Connected components of links, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from helixframe.llm.common import save


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, label): the smallest node of each node's component; nodes without a link are not listed.

    Each round takes the smallest label among the neighbours and then the label of that label, so long chains halve.
    Every round is written to the shared folder; a hub's links are reduced before they are exchanged.
    """
    pairs = links.select(F.col(left).alias("x"), F.col(right).alias("y")).where("x != y")
    edges = save(pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = save(edges.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        seen = edges.join(labels, F.col("x") == F.col("node")).groupBy(F.col("y").alias("node")).agg(F.min("label").alias("near"))
        least = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("jump"))
        after = save(least.join(far, "label", "left").select("node", "old", F.least("label", F.coalesce("jump", "label")).alias("label")), "labels")
        if after.where("old != label").limit(1).count() == 0:
            return after.select("node", "label")
        labels = after.select("node", "label")
