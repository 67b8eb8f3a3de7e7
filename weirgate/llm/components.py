"""Connected components of a link table by joins; links and labels stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirgate.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node of its component) of all nodes in ``links`` (a, b).

    Each round takes the smallest label among the neighbours and then the label of that label, so
    chains shorten by more than half a round. Labels are written after each round.
    """
    both = cut_lineage(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = cut_lineage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jumped = lower.join(labels.select(F.col("node").alias("next"), F.col("label").alias("far")), "next")
        after = cut_lineage(jumped.select("node", F.col("label").alias("old"), F.least("next", "far").alias("label")))
        labels = after.select("node", "label")
        if after.filter("old <> label").isEmpty():
            return labels
