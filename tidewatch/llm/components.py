"""Connected components of a link table, in Spark jobs only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import saved


def _lowest(pairs: DataFrame) -> DataFrame:
    """Each pair (u, v) with m, the smallest of u and all its v. The smallest v are found map-side first."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """Root of every node of `links` (u, v: long): columns `node`, `root`, the root being the smallest node reachable.

    Large and small stars by turns: every node hands its larger neighbours, then its smaller ones, over to the
    smallest node it knows, until no link changes. The number of rounds grows with the logarithm of the
    longest path, links never grow in number, and each round is written to the shared folder. A node that
    is linked to itself only is its own root. Links with a null end are left out.
    """
    found = saved(links.select("u", "v").where("u IS NOT NULL AND v IS NOT NULL").distinct())
    alone = found.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("root"))
    now = found.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _lowest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _lowest(large)
        moved = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = saved(moved.unionByName(near.select("u", F.col("m").alias("v"))).distinct())
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    members = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return members.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("root").alias("root"))
