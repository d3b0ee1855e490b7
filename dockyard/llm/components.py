"""Connected components by label propagation with pointer jumping, on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.llm.tables import staged


#: Edges a task handles in a round: small graphs are not dealt over all shuffle partitions, each with a file of its own.
EDGES = 1 << 16


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of ``edges``.

    Each round a node takes the smallest label around it and then the label of
    that label, so a path of n nodes needs about log n rounds. Labels are
    written between rounds; a node with very many edges is pre-aggregated (the
    minimum) and split by the skew join. Tables have as many files as the
    edges ask for. No edges give an empty result.
    """
    parts = max(1, edges.count() // EDGES)
    one = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).filter("x <> y")
    both = staged(one.union(one.select("y", "x")).distinct().coalesce(parts))
    labels = staged(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m"))
                    .select("node", F.least("node", "m").alias("label")).coalesce(parts))
    while True:
        around = both.join(labels.select(F.col("node").alias("y"), "label"), "y").groupBy("x").agg(F.min("label").alias("m"))
        near = labels.join(around, F.col("node") == F.col("x")).select("node", "label", F.least("label", "m").alias("low"))
        # the old label of the new label is never larger than the new label
        up = labels.select(F.col("node").alias("of"), F.col("label").alias("its"))
        new = staged(near.join(up, F.col("low") == F.col("of"), "left").select(
            "node", F.least("low", "its").alias("label"), (F.least("low", "its") < F.col("label")).alias("changed")).coalesce(parts))
        labels = new.select("node", "label")
        if new.filter("changed").isEmpty():
            return labels.withColumnRenamed("label", "component")
