"""Connected components of a graph given as links, by label passing with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.store import written


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is connected with, from columns ``a`` and ``b``.

    Each round takes the smallest label of the neighbours, then the label of that label, so the
    number of rounds follows the logarithm of the longest path. Every round is written to the
    shared folder. Nodes without links do not appear.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        heard = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("heard"))
        nearer = labels.join(heard, labels["node"] == heard["a"]).select("node", F.least("label", "heard").alias("next"), "label")
        known = labels.select(F.col("node").alias("next"), F.col("label").alias("beyond"))
        step = written(nearer.join(known, "next").select("node", F.least("next", "beyond").alias("next"), "label"), "labels")
        labels = step.select("node", F.col("next").alias("label"))
        if step.where("next < label").isEmpty():
            return labels
