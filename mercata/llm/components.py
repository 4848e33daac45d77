"""Connected components of a link table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.common import pin


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` -> ``node, label``: the smallest node reachable, for every node of a link.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    the number of rounds follows the logarithm of the longest chain.  Every round is written to
    the shared folder; neighbours are combined before the shuffle, so a node with very many links
    is no hot group.
    """
    both = pin(links.select("a", "b").where("a <> b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b"))
               .distinct(), "links")
    labels = pin(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("low"))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("up"))
        # the label of a label: one more step towards the smallest node
        after = pin(low.join(up, "low", "left").select("node", "old", F.least("low", "up").alias("label")), "labels")
        labels = after.select("node", "label")
        if not after.where("label <> old").limit(1).count():
            return labels
