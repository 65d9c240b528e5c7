"""Connected components of a distributed link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over links (a, b); only linked nodes appear.

    Each round every node takes the smallest label among its own and its
    neighbours' (grouped with partial aggregation, so a hub is summed where
    its links lie), then labels are followed one step (a label is itself a
    node). Labels only fall; a round without change ends the loop, after a
    number of rounds that grows with the logarithm of the longest path.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct())
    label = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        heard = (both.join(label.withColumnRenamed("node", "b"), "b")
                 .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard")))
        lower = label.join(heard, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "heard").alias("via"))
        up = label.select(F.col("node").alias("via"), F.col("component").alias("further"))
        step = stored(lower.join(up, "via", "left").select(
            "node", F.least("via", F.coalesce("further", "via")).alias("component"),
            (F.least("via", F.coalesce("further", "via")) < F.col("old")).alias("changed")))
        label = step.select("node", "component")
        if step.filter("changed").isEmpty():
            return label
