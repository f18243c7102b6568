"""Connected components of a link table, by label propagation on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenaflow.llm.common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) of the undirected links ``a``, ``b`` (long).

    Each round a node takes the smallest label among its own and its neighbours',
    then the label of that label, so long chains shorten by doubling.  Labels
    are written to the shared folder after each round; nothing but the number of
    changed labels reaches the driver.
    """
    links = materialize(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links"
    )
    labels = materialize(links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"), "labels")
    while True:
        near = links.join(labels, links["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        hooked = materialize(hooked, "labels")
        jump = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = hooked.join(jump, "label", "left").select("node", "old", F.coalesce(F.least("label", "further"), "label").alias("label"))
        labels = materialize(jumped, "labels")
        if labels.where("label <> old").isEmpty():
            return labels.select("node", F.col("label").alias("component"))
        labels = labels.select("node", "label")
