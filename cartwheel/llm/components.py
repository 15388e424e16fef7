"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every end of an edge ``a, b`` (longs): the label is the
    least node reachable. Each round takes the least label among the neighbours
    (a grouped minimum, combined before the shuffle, so a node with very many
    neighbours is one row a task) and then the label of that label, which halves
    the length of chains. No edges give no rows."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.where("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = (labels.join(near, labels["node"] == near["a"], "left")
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("label")))
        further = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        new = materialize(step.join(further, "label", "left")
                          .select("node", "old", F.least("label", "beyond").alias("label")), "labels")
        changed = new.where("old <> label").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
