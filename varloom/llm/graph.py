"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import kept


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``a, b`` links; the component is its smallest node.

    Labels spread along the links and are then replaced by the label of their label, so that the number of
    rounds grows with the logarithm of a component's width.  A node with very many links is reduced by partial
    aggregation.  Nulls link nothing; loops and repeated links change nothing.
    """
    both = links.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    both = kept(both.union(both.select("b", "a")).distinct(), "links")
    labels = kept(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), "labels")
    while True:
        spread = (
            both.join(labels.withColumnRenamed("a", "b"), "b")
            .groupBy("a")
            .agg(F.min("label").alias("near"))
            .join(labels, "a")
            .select("a", F.least("label", "near").alias("to"), F.col("label").alias("old"))
        )
        jumped = spread.join(labels.select(F.col("a").alias("to"), F.col("label").alias("further")), "to").select(
            "a", F.least("to", "further").alias("label"), "old"
        )
        labels = kept(jumped, "labels")
        if not labels.where("label <> old").limit(1).count():
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))
        labels = labels.select("a", "label")
