"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelflow.session import shared_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the component's smallest node.

    Alternates two steps until nothing changes: every node links its larger
    neighbours, then its smaller ones, to the smallest node next to it. Each
    round reads the checkpoint of the round before, so lineage stays short
    and a lost executor costs one round at most. Groups are only summed
    (min), never gathered; rounds grow with the logarithm of the longest
    chain. An empty edge list gives an empty result.
    """
    shared_dir(edges.sparkSession)
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct().checkpoint()
    before = None
    while True:
        both = e.union(e.select("lo", "hi")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("hi <> lo").distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(down, "hi").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .union(down.select("hi", F.col("m").alias("lo"))).where("hi <> lo").distinct())
        e = small.checkpoint()
        now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if now == before:
            return e.groupBy("hi").agg(F.min("lo").alias("root")).withColumnRenamed("hi", "node").union(
                e.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
        before = now
