"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.plans.session import written


def both_ways(links: DataFrame) -> DataFrame:
    return links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    rows = both_ways(links)
    least = rows.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return rows.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("least"))
    rows = links.join(least, "u")
    moved = rows.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``u``, ``v``: every linked node that is not the smallest of its component, and the smallest.

    ``links`` has two columns u and v of long ids. Each round writes its links, so that neither lineage nor a lost executor makes
    earlier rounds run again; only two numbers about them reach the driver. The rounds end when a round changes nothing.
    """
    ordered = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    current, before = written(ordered, "links"), None
    while True:
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if mark == before or mark[0] == 0:
            return current
        before, current = mark, written(small_star(large_star(current)), "links")
