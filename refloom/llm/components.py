"""Connected components by alternating large-star and small-star steps, without collecting any neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch


def components(spark: SparkSession, links: DataFrame, scratch: Scratch) -> DataFrame:
    """links (u, v: long) -> (node, root): each linked node and the smallest node that it reaches.

    Each step is an aggregate of minima, which combine before the shuffle, and a join that Spark may split
    where a node has very many links. Steps go on until no link changes.
    """
    edges = scratch.save(links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        old, edges = edges, scratch.save(small)
        scratch.drop(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
