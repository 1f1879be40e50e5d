"""Connected components of a table of links, by alternating large and small stars.

Every round is a grouping and a join over the links; nothing is gathered. A node with very many links costs one
minimum, taken with partial sums, and a join that the engine splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import staged


def _both(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _star(sided: DataFrame, larger: bool) -> DataFrame:
    """Tie each node's neighbours to the least among them and the node itself."""
    least = sided.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least")).withColumnRenamed("a", "node")
    joined = sided.join(least, F.col("a") == F.col("node"))
    tied = joined.where("b > a") if larger else joined
    out = tied.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not larger:
        out = out.unionByName(least.select(F.col("node").alias("a"), F.col("least").alias("b")))
    return out.where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component``: each node that has a link, and the least node it can reach. ``links(a, b)`` may repeat."""
    now = staged(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        total = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if total == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = total
        now = staged(_star(_star(_both(now), larger=True), larger=False), "links")
