"""Connected components of a table of links, by alternating large and small stars.

Each round is two aggregations and a join over the links; a node's neighbours are never gathered, only their smallest is.
Rounds grow with the logarithm of a component's diameter. Nothing but two numbers per round comes to the driver. Each round's
links are a table in the shared folder; those of rounds before are removed, the last stay for the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftworks.llm.common import forget, settle


def components(links: DataFrame) -> DataFrame:
    """links: a, b (bigint). Returns node, root (the smallest node of its component) for every node but the roots."""
    now, path = settle(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    sign = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b").distinct()
        large, middle = settle(large, "links")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a > b")
        old, (now, path) = path, settle(small.union(low.select("a", F.col("low").alias("b"))).distinct(), "links")
        forget(links.sparkSession, old)
        forget(links.sparkSession, middle)
        was, sign = sign, tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if sign == was:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
