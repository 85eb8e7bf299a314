"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def components(links: DataFrame) -> DataFrame:
    """``links``: (a, b). Returns (id, component), component being the smallest id reachable, for
    every id in a link.

    Each round takes the smallest label among the neighbours, then the label's own label (pointer
    jumping), so long chains end after about the logarithm of their length. All tables stay
    distributed; a round reads the links once and writes the labels.
    """
    both = links.select("a", "b").where("a <> b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")).where("a <> b"))
    both = materialise(both.distinct(), "links")
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("component")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("component").alias("near"))
        own = labels.join(near, labels["id"] == near["a"]).select("id", F.col("component").alias("old"), F.least("component", "near").alias("label"))
        jump = labels.select(F.col("id").alias("label"), F.col("component").alias("further"))
        step = own.join(jump, "label").select("id", "old", F.least("label", "further").alias("component"))
        step = materialise(step, "labels")
        if step.where("old <> component").isEmpty():
            return step.select("id", "component")
        labels = step.select("id", "component")
