"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch


def components(links: DataFrame, work: Scratch) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of
    ``links`` (two columns of longs).

    Each round takes the least label among a node's neighbours and then that
    label's own label, so that long chains shorten by half.  Labels are written
    every round; nothing is gathered but the number of changes.
    """
    a, b = links.columns
    pairs = links.select(F.col(a).alias("node"), F.col(b).alias("other"))
    back = pairs.select(F.col("other").alias("node"), F.col("node").alias("other"))
    edges = work.keep(pairs.unionByName(back).distinct())
    least = F.least("node", F.min("other")).alias("label")
    labels = work.keep(edges.groupBy("node").agg(least))
    while True:
        theirs = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
        offered = edges.join(theirs, "other").groupBy("node").agg(F.min("theirs").alias("theirs"))
        lower = labels.join(offered, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "theirs").alias("near")
        )
        far = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        after = work.keep(
            lower.join(far, "near").select("node", "old", F.least("near", "far").alias("label"))
        )
        labels = after.select("node", "label")
        if after.where("label < old").isEmpty():
            return labels.withColumnRenamed("label", "component")
