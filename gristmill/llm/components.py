"""Connected components of a distributed graph by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill import scratch


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) for every node that is not smallest itself.

    Edges have any direction and may repeat; loops and nulls are ignored. Each round links the
    larger neighbours of every node to its smallest one, then its smaller ones; the number of
    rounds grows with the logarithm of the number of nodes. Minima are taken inside tasks before
    the shuffle, each round is written to the shared folder, and nothing but two numbers per
    round comes to the driver.
    """
    plain = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b")
    stars = scratch.materialize(plain.distinct(), "stars")
    mark = None
    while True:
        sign = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(sign) == mark or not sign[0]:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
        mark = tuple(sign)
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        small = small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).where("a > b").distinct()
        stars = scratch.materialize(small, "stars")
