"""Connected components of an edge table, by repeated contraction on the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import discard, materialize


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Rows (node, root) for every node of `edges` (a, b); root is its component's smallest node.

    Each round hangs every node under its smallest smaller neighbour, jumps
    pointers until the trees are flat, and replaces the edges by those that
    still join different roots; at least the larger end of every edge
    disappears in a round, so few rounds are needed whatever the graph's shape.
    Loops and repeated edges count for nothing, edges with a null end are left
    out, and an empty table gives no rows.
    """
    live = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    nodes = live.select(F.col("a").alias("node")).union(live.select(F.col("b").alias("node"))).distinct()
    label = materialize(nodes.withColumn("root", F.col("node")), f"{name}-labels")
    while live.limit(1).count():
        parent = materialize(live.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")), f"{name}-parents")
        while True:
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = materialize(parent.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), f"{name}-parents")
            discard(parent)
            parent = jumped
            if not parent.where("moved").limit(1).count():
                break
        parent = parent.select("node", "up")
        old_label, old_live = label, live
        label = materialize(label.join(parent.withColumnRenamed("node", "root"), "root", "left").select("node", F.coalesce("up", "root").alias("root")), f"{name}-labels")
        ends = live
        for side in ("a", "b"):
            ends = ends.join(parent.withColumnRenamed("node", side), side, "left").withColumn(side, F.coalesce("up", side)).drop("up")
        live = materialize(ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
        discard(old_label)
        discard(old_live)
    return label
