"""Connected components of a table of links, without bringing links or components to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.small import settled


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): the label is the smallest node of its component.

    Every round takes the smallest label among the neighbours (minima are combined before the shuffle) and then the
    label of the label, so long chains halve. Each round is a written table.
    """
    both = settled(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        .distinct()
    )
    labels = settled(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("near")), "other")
            .groupBy("node")
            .agg(F.min("near").alias("near"))
        )
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("lower"))
        ahead = labels.select(F.col("node").alias("lower"), F.col("label").alias("ahead"))
        jumped = settled(
            lower.join(ahead, "lower").select("node", F.least("lower", "ahead").alias("new"), F.col("label").alias("old"))
        )
        changed = not jumped.where("new <> old").isEmpty()
        labels = jumped.select("node", F.col("new").alias("label"))
        if not changed:
            return labels
