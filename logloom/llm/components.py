"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.storage import blocks_for, staged

LINKS_PER_TASK = 20_000


def connected_components(links: DataFrame) -> DataFrame:
    """(node, label): for every node of the links (a, b), the smallest node reachable from it.

    Each round takes the smallest label among a node's neighbours and then the label of that label, so the
    rounds grow with the logarithm of a component's diameter. A well-connected node's rows are summed before
    they are shuffled. Each round is written to the shared folder, which the links should come from, too.
    """
    tasks = blocks_for(links.count(), LINKS_PER_TASK)
    both = staged(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), tasks)
    labels = staged(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), tasks)
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("near_node")).agg(F.min("label").alias("near"))
        hooked = labels.join(near, F.col("node") == F.col("near_node")).select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        hooked = staged(hooked, tasks)
        up = hooked.select(F.col("node").alias("up_node"), F.col("label").alias("up"))
        jumped = staged(hooked.join(up, F.col("label") == F.col("up_node")).select("node", "before", F.col("up").alias("label")), tasks)
        labels = jumped.select("node", "label")
        if jumped.where(F.col("before") != F.col("label")).isEmpty():
            return labels
