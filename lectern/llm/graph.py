"""Connected components of an edge table, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import cut_lineage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of ``edges`` with the smallest node it reaches.

    Each round takes the smallest label among a node and its neighbours, then the label of that label.  A round
    is one join and one partially aggregated minimum, written to the shared scratch folder; rounds go on until no
    label changes.  Nodes without edges, nulls included, are not in the result; an empty table gives none.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    both = cut_lineage(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = cut_lineage(both.groupBy(F.col("u").alias("node")).agg(F.least("node", F.min("v")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("component").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("step"))
        jump = labels.select(F.col("node").alias("step"), F.col("component").alias("jumped"))
        moved = cut_lineage(
            hooked.join(jump, "step").select("node", "old", F.least("step", "jumped").alias("component")), "labels")
        done = moved.where("component <> old").isEmpty()
        labels = moved.select("node", "component")
        if done:
            return labels
