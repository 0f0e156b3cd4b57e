"""Connected components of a link table by alternating minimum labels; all state in written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.llm.common import discard, tables, written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): the smallest node of its component.

    Each round points every node to the smallest label in its neighbourhood and replaces links by links between labels
    (a node keeps its pointer, so long chains halve). Rounds follow the logarithm of a component's diameter in practice.
    """
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    nodes = written(edges.select(F.col("u").alias("node")).union(edges.select("v")).distinct().withColumn("label", F.col("node")), "nodes")
    spark, mark = links.sparkSession, tables() - 2
    while True:
        discard(spark, mark, edges, nodes)  # what the rounds before left
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least"))  # map-side combined: a hub is one row a task
        least = written(least.where("least < u"), "least")
        if least.isEmpty():
            return nodes
        # follow pointers to their ends: u -> least(u) is acyclic as it always falls
        while True:
            up = least.select(F.col("u").alias("p"), F.col("least").alias("further"))
            step = written(least.join(up, least["least"] == up["p"], "left").select("u", F.coalesce("further", "least").alias("least"), F.col("p").isNotNull().alias("moved")), "least")
            least = step.select("u", "least")
            if step.where("moved").isEmpty():
                break
        up = least.select(F.col("u").alias("p"), F.col("least").alias("to"))
        nodes = written(nodes.join(up, nodes["label"] == up["p"], "left").select("node", F.coalesce("to", "label").alias("label")), "nodes")
        to_u, to_v = up.select(F.col("p").alias("pu"), F.col("to").alias("tu")), up.select(F.col("p").alias("pv"), F.col("to").alias("tv"))
        moved = edges.join(to_u, edges["u"] == to_u["pu"], "left").select(F.coalesce("tu", "u").alias("u"), "v")
        moved = moved.join(to_v, moved["v"] == to_v["pv"], "left").select("u", F.coalesce("tv", "v").alias("v"))
        edges = written(moved.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
