"""Connected components by alternating stars.

A round rewrites the links so that every node points to the smallest node it
knows of, first for its larger neighbours, then for its smaller ones. The number of rounds
grows with the logarithm of the longest chain. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.llm.base import saved


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("x")).select("x.*")


def _round(links: DataFrame) -> DataFrame:
    both = _both_ways(links)
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    large = both.join(least, "a").where("b > a and b <> m").select("b", "m")
    # Here every row points from b down to m: the smaller neighbours of b.
    least = large.groupBy("b").agg(F.min("m").alias("least"))
    pairs = large.join(least, "b")
    moved = pairs.select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")), F.struct(F.col("m").alias("a"), F.col("least").alias("b")))).alias("x"))
    return moved.select("x.*").where("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) except the roots themselves; the root is
    the smallest node of the component."""
    state, before = saved(links.where("a <> b").distinct(), "links"), None
    while True:
        count = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if count == before:
            return state.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = count
        if count[0]:
            state = saved(_round(state), "links")
