"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civora.llm.common import shared_table


def _signature(edges: DataFrame):
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, component): for every node of ``edges`` (a, b), the smallest node it reaches.

    Each round links a node's larger neighbours, then its smaller ones, to the
    smallest of them, until every edge is a star's ray. Minima are summed
    partially before they are shuffled and a hub is only ever a join key, which
    adaptive execution splits. Rounds are written to the shared folder.
    """
    now = shared_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .distinct(), "edges")
    before = None
    while (mark := _signature(now)) != before and mark[0]:
        before = mark
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # large star: a node's larger neighbours go to its smallest (itself included)
        large = (both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        large = shared_table(large, "large-star")
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        now = shared_table(small, "small-star")
    rays = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return rays.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
