"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of every node in ``links`` (``a, b``): the smallest node reachable.

    Each round takes the least label among neighbours, then the label of the label; the
    labels are written between rounds.  The number of rounds grows with the logarithm of
    the longest chain.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        lower = labels.join(near, "node").select("node", F.least("component", "near").alias("next"), F.col("component").alias("was"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("beyond"))
        moved = stored(lower.join(jump, "next").select("node", "was", F.least("next", "beyond").alias("component")), "labels")
        labels = moved.select("node", "component")
        if not moved.where("component != was").head(1):
            return labels
