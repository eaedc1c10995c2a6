"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabweave.session import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of the links, `root` being the smallest node that links reach from it.

    Links are rewritten as stars, in turn towards smaller neighbours of larger and of smaller nodes, until they stand
    still; each round has at most as many links as the one before, and their number of rounds grows with the logarithm of
    the longest path. Minima are aggregated before the shuffle, so a node with very many links is no burden. Every round
    is written to the shared folder. Null ends and links of a node to itself are left out.
    """
    now = written(links.select(links[a].alias("a"), links[b].alias("b")).where("a <> b").distinct(), "links")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        now = written(small.where("a <> b").distinct(), "links")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
