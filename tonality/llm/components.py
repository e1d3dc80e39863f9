"""Connected components of a link table by alternating large and small stars.

Each round joins the links with a per-node minimum (a pre-aggregated group-by),
so no task holds a node's whole neighbourhood and nothing but two numbers per
round reaches the driver. Rounds grow with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of its neighbourhood."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    others = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _digest(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for each node with a link to another: the component
    is its smallest node. Self links and rows with nulls are ignored, repeated
    and reversed links count once; no links give an empty table."""
    now = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    now = materialise(now, "links")
    before = _digest(now)
    while before[0]:
        now = materialise(_small_star(materialise(_large_star(now), "large")), "small")
        after = _digest(now)
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
