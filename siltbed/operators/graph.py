"""Connected components of a table of links, by alternating large and small stars.

Every round groups links by node (pre-aggregated minima), points neighbours at the least node seen and is written to the
shared folder; links never leave the cluster. A join with the minima is split by Spark where a node has very many links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltbed.stages import BROADCAST_ROWS, dropped, staged


def least_of(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("least"))


def state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, label (the least node reachable) for every node of ``links`` (columns a, b) with a smaller one in reach."""
    links = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = staged(links, "links")
    before = state(links)
    while before[0]:
        # There are at most twice as many minima as links, and those were counted.
        sent = F.broadcast if 2 * before[0] <= BROADCAST_ROWS else (lambda df: df)
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pointed = both.join(sent(least_of(both)), "u").where("v > u").select("v", F.least("u", "least").alias("m"))
        large = staged(pointed.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "links")
        below = least_of(large)
        moved = large.join(sent(below), "u").where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        small_star = staged(moved.unionByName(below.select("u", F.col("least").alias("v"))).distinct(), "links")
        after = state(small_star)
        dropped(links, large)
        links = small_star
        if after == before:
            break
        before = after
    return links.select(F.col("u").alias("node"), F.col("v").alias("label"))
