"""Connected components of links, by smallest labels that spread and jump. Links and labels stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import discard, stored


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of all nodes in links (a, b); the component is the smallest node that can be reached.

    Each round takes the least label of the neighbours and then that label's own label, so a chain of n links takes
    about log n rounds. A node with very many links is summed up in each task before it is shuffled.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        spread = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        spread = stored(spread, "labels")
        jump = spread.select(F.col("node").alias("component"), F.col("component").alias("further"))
        jumped = stored(
            spread.join(jump, "component", "left").select("node", "old", F.coalesce("further", "component").alias("component")), "labels"
        )
        discard(labels, spread)
        labels = jumped
        if not jumped.filter("component <> old").limit(1).count():
            discard(both)
            return labels.drop("old")
