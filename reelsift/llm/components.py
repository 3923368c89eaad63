"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelsift.session import durable


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: the least node that each node of ``edges`` is connected with.

    In each round every node takes the least label among its neighbours', and then that label's own label, so long
    chains shorten by halves. Every round is written to the shared folder, which cuts the lineage. A node's
    neighbours are reduced to one least label in the map tasks; they never meet in one task.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
    both = durable(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = durable(both.groupBy("u").agg(F.min("v").alias("least")).select(F.col("u").alias("node"), F.least("u", "least").alias("component")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("component").alias("_near"))
        lower = labels.join(near.withColumnRenamed("u", "node"), "node")
        # A component also learns what its members have heard.
        heard = lower.groupBy("component").agg(F.min(F.least("component", "_near")).alias("_heard"))
        stepped = lower.join(heard, "component").select("node", F.least("component", "_near", "_heard").alias("_next"), "component")
        jump = stepped.select(F.col("node").alias("_next"), F.col("_next").alias("_far"))
        stepped = stepped.join(jump, "_next", "left")
        done = durable(stepped.select("node", F.least("_next", F.coalesce("_far", "_next")).alias("component"), F.col("component").alias("_old")))
        labels = done.drop("_old")
        if done.where("component != _old").isEmpty():
            return labels
