"""Connected components of a graph given as a table of edges, by least labels and pointer jumping.

Every round each node takes the least label among its neighbours and then the label of its label, so paths shrink by
halves.  Both steps are joins and aggregates with partial sums; a hub is a hot key of a join that Spark splits, its
neighbours are never collected.  Rounds are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.llm._shared import Tables


def components(edges: DataFrame, own: Tables, name: str = "components") -> DataFrame:
    """(node, label): each node of edges (a, b) with the least node that it can reach, stored among own under name.  Nulls
    and loops are no edges."""
    both = own.stored(edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = own.stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), name)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        # A lower label is also offered to the node that the present label names.
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("least"))
        hooked = step.where("least < label").groupBy(F.col("label").alias("node")).agg(F.min("least").alias("hook"))
        step = own.stored(step.join(hooked, "node", "left").select("node", F.col("label").alias("old"), F.least("least", F.coalesce("hook", "least")).alias("label")), "hooked")
        root = step.select(F.col("node").alias("label"), F.col("label").alias("root"))
        new = own.stored(step.join(root, "label", "left").select("node", "old", F.least("label", F.coalesce("root", "label")).alias("label")), name)
        changed = new.where("label <> old").count()
        labels = new.select("node", "label")
        if not changed:
            own.drop("edges", "hooked")
            return labels
