"""Connected components of a distributed set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecindad.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): the least node it can reach.

    Each round a node takes the least label among itself and its neighbours, and then
    the label of that label, so chains shrink by doubling.  Rounds are stored; no
    link leaves the executors.
    """
    links = links.select("a", "b")
    both = stored(links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = both.groupBy("a").agg(F.least(F.min("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node")
    while True:
        labels = stored(labels)
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, labels["node"] == near["a"]).select(
            "node", "label", F.least("label", "near").alias("low")
        )
        of = labels.select(F.col("node").alias("low"), F.col("label").alias("lower"))
        after = stored(
            lower.join(of, "low", "left").select("node", "label", F.least("low", F.coalesce("lower", "low")).alias("low"))
        )
        changed = after.where("low <> label").limit(1).count()
        labels = after.select("node", F.col("low").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")
