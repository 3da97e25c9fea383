"""Connected components by alternating large-star and small-star rounds.

Each round is two equi-joins and partial aggregates; links and components
stay in distributed tables and are written to the shared folder after every
round. A node with very many links is met by the map-side minimum and by the
splitting of skewed joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerflow.llm.common import staged


def _smallest(e: DataFrame) -> DataFrame:
    return e.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) -> (node, component) for every linked node, the
    component being the smallest node reachable."""
    now = staged(links.select("u", "v").where("u <> v").distinct(), "links")
    mark = None
    while True:
        now = staged(_small_star(_large_star(now)), "links")
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
