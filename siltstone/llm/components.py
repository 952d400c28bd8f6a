"""Connected components of links by alternating large and small stars, all as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import BROADCAST_ROWS, Scratch


def _star(links: DataFrame, scratch: Scratch | None, inner: bool) -> DataFrame:
    """Hang each node's larger (or, ``inner``, not larger) neighbours onto its least neighbour.

    With ``scratch`` the least neighbours are written out first: the join then shuffles both sides as they lie, where a hub is split.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if not inner:
        both = both.unionAll(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    least = least if scratch is None else scratch.save(least)
    hung = (both if inner else both.where("v > u")).join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if inner:
        hung = hung.unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return hung.where("a <> b").distinct()


def components(links: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for each node with a link (columns a and b, any order).

    Each round writes the links it leaves; it ends when a round changes nothing, which takes a number of
    rounds that grows with the logarithm of the longest path. Nothing but a count and a checksum reaches the driver.
    """
    now = scratch.save(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    few = now.count() <= BROADCAST_ROWS  # a hub of so few links is no load
    sums = None
    for _ in range(rounds):
        steps = Scratch(scratch.spark)
        if few:
            nxt = scratch.save(_star(_star(now, None, inner=False), None, inner=True))
        else:
            nxt = scratch.save(_star(steps.save(_star(now, steps, inner=False)), steps, inner=True))
        scratch.drop(now)
        steps.clear()
        now = nxt
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == sums:
            break
        sums = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    tops = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(tops)
