"""Connected components of links between long keys, by hooking to the least neighbour and contracting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyrocell.sources.shared import Rounds


def components(links: DataFrame) -> DataFrame:
    """(key, component) for every key of ``links`` (a, b); the component is its least key.

    Each round every key points to its least neighbour, pointers are followed to their ends, and the links are drawn
    again between these; rounds grow with the logarithm of the longest chain. Rounds are written, not kept in lineage.
    """
    rounds = Rounds(links.sparkSession)
    kept = rounds.put
    edges = kept(links.select("a", "b").where("a <> b").distinct())
    nodes = kept(edges.select(F.explode(F.array("a", "b")).alias("key")).distinct().withColumn("component", F.col("key")))
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        up = kept(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("key"), F.least("a", "b").alias("to")))
        while True:
            ends = up.select(F.col("key").alias("to"), F.col("to").alias("end"))
            jumped = kept(up.join(ends, "to").select("key", F.col("end").alias("new"), (F.col("end") < F.col("to")).alias("moved")))
            up = jumped.select("key", F.col("new").alias("to"))
            if not jumped.where("moved").limit(1).count():
                break
        root = up.select(F.col("key").alias("component"), F.col("to").alias("root"))
        nodes = kept(nodes.join(root, "component", "left").select("key", F.coalesce("root", "component").alias("component")))
        a, b = up.select(F.col("key").alias("a"), F.col("to").alias("ra")), up.select(F.col("key").alias("b"), F.col("to").alias("rb"))
        edges = kept(edges.join(a, "a").join(b, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    return rounds.only(nodes)
