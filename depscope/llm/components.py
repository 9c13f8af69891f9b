"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import store


def _stored(links: DataFrame) -> tuple[DataFrame, tuple]:
    kept = store(links.distinct(), "links")
    # a sum of hashes changes with the links, whatever their order
    return kept, tuple(kept.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root (bigint) for every node of ``links`` (u, v bigint) that is not its own root.

    The root is the smallest node reachable. Repeated links and links of a node to itself do
    no harm. Rounds of joins connect each node's neighbours to its smallest one until nothing
    changes; their number grows with the logarithm of the longest path. Each round is written
    to the shared folder; minima combine on the map side, so that a node with very many links
    is no hot group. The driver sees one count and one sum a round.
    """
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current, state = _stored(ordered)
    while state[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = larger.groupBy("u").agg(F.min("v").alias("m"))
        moved = larger.join(lowest, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
        current, reached = _stored(moved.select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v"))
        if reached == state:
            break
        state = reached
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
