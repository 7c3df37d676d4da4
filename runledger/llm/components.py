"""Connected components of a table of links, by label spreading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runledger.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b); the label is the
    smallest node of the component.  Each round takes the smallest label
    among the neighbours and then the label of that label, so paths shrink
    exponentially; links and labels stay distributed tables throughout."""
    both = stored(links.select("a", "b").union(links.select("b", "a"))
                  .distinct(), "links")
    # Stored tables on both sides of each join: a hub's rows can be split.
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = stored(both.join(labels, both["b"] == labels["node"]).groupBy(
            "a").agg(F.min("label").alias("near")), "labels-near")
        first = stored(labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("was"),
            F.least("label", "near").alias("label")), "labels-first")
        jump = first.select(F.col("node").alias("at"),
                            F.col("label").alias("far"))
        new = stored(first.join(jump, first["label"] == jump["at"]).select(
            "node", "was", F.least("label", "far").alias("label")), "labels")
        labels = new.select("node", "label")
        if not new.filter("label <> was").limit(1).count():
            return labels
