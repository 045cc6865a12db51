"""Connected components of a link table, as Spark joins (no driver-side graph)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import stage

MAX_ROUNDS = 60


def _stars(e: DataFrame) -> DataFrame:
    """One large-star step followed by one small-star step over (u, v) links, u > v.

    Each step takes the smallest neighbour with a map-side combined aggregate
    and joins it back, so no neighbour list is ever held in one row.
    """
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(low.where("m < u").select("u", F.col("m").alias("v"))).where("u <> v").distinct())
    low2 = large.groupBy("u").agg(F.min("v").alias("m"))
    return (large.join(low2, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
            .union(low2.select("u", F.col("m").alias("v"))).where("u <> v").distinct())


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of bigint nodes -> ``(node, component)``, the smallest node reachable.

    Only nodes that occur in a link between two different nodes are returned;
    NULLs and self-links are ignored. Large-star/small-star rounds, each
    written to the shared folder, until every node hangs on its root.
    """
    e = links.select(F.greatest("a", "b").cast("bigint").alias("u"), F.least("a", "b").cast("bigint").alias("v"))
    e = stage(e.where("u <> v").distinct(), "links")
    for _ in range(MAX_ROUNDS):
        # Finished when the table is a set of stars: one root per node, and no root hangs on another.
        roots = e.select(F.col("v").alias("u")).distinct().join(e, "u", "left_semi").limit(1)
        many = e.groupBy("u").count().where("count > 1").limit(1)
        if not many.union(roots.select("u", F.lit(0).cast("bigint"))).take(1):
            break
        e = stage(_stars(e), "links")
    else:
        raise RuntimeError("components did not converge")
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
