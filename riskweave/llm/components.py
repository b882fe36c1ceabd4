"""Connected components of a link table, without gathering links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.session import checkpointed


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of `links` (a, b): label is the smallest node of its component.

    Each round takes the smallest label among the neighbours and then the label of that label, so chains
    shrink geometrically. Links repeat the neighbour's label, never a list of neighbours; the minimum is
    combined before the shuffle, and a node with very many links is split by adaptive skew handling. An
    empty table gives no rows; repeated links and self links are harmless; links with a null end are ignored.
    """
    links = links.filter("a is not null and b is not null")
    both = checkpointed(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.a).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("target"), F.col("label").alias("final"))
        step = checkpointed(step.join(jump, step.label == jump.target).select(
            "node", "old", F.least("label", "final").alias("label")))
        labels = step.select("node", "label")
        if step.filter("old != label").isEmpty():
            return labels
