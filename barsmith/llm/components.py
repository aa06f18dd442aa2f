"""Connected components of an edge list by rounds of smallest labels and shortcuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith import session


def label(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node of the edges (a, b).

    Every round gives a node the smallest label among itself and its neighbours, then replaces a
    label by the label of that label, so paths shorten by halves. Rounds are written to the shared
    folder; only a count of changed rows comes to the driver. The smallest label of a node's
    neighbours is pre-aggregated before its shuffle, so a hub does not gather its edges in a task.
    """
    both = session.materialize(
        edges.select("a", "b").union(edges.select("b", "a")).toDF("a", "b").where("a <> b").distinct(), "both")
    labels = session.materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("component")), "labels")
    while True:
        own = labels.select("node", "component")
        near = both.join(own.select(F.col("node").alias("b"), F.col("component").alias("next")), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("next").alias("next"))
        stepped = own.join(near, "node").select("node", F.least("component", "next").alias("component"),
                                                   F.col("component").alias("before"))
        target = stepped.select(F.col("node").alias("component"), F.col("component").alias("jump"))
        jumped = session.materialize(stepped.join(target, "component", "left").select(
            "node", F.least("component", "jump").alias("component"), "before"), "labels")
        changed = jumped.where("component <> before").limit(1).count()
        session.discard(labels)
        labels = jumped
        if not changed:
            session.discard(both)
            return labels
