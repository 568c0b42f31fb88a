"""Connected components of links that are too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strata.cluster import checkpointed


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``node, root`` for each node of the links; ``root`` is the smallest node that links lead to.

    Alternating large and small stars: each round points nodes at smaller neighbours, and the rounds needed grow with
    the logarithm of the longest path; they end as soon as each node has one link, to a node that has none. Only minima
    and counts are taken of a node's links, in part before the shuffle, so a node may have any number of links. Each
    round is checkpointed. Links to itself, repeated links and links in both directions are allowed, NULL ends are
    ignored; no links give no rows.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    stars = checkpointed(links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
                         .select(high.alias("u"), low.alias("v")).distinct())
    nodes = stars.select(F.col("u").alias("node")).union(stars.select(F.col("v").alias("node"))).distinct()
    stars = stars.where("u != v")
    while not _are_stars(stars):
        # Large star: larger neighbours of a node point at the smallest node around it.
        around = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (around.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        # Small star: smaller neighbours and the node itself point at the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v"))))
            .alias("e")).select("e.u", "e.v").where("u != v").distinct())
        stars = checkpointed(small)
    return nodes.join(stars.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"))


def _are_stars(links: DataFrame) -> bool:
    """Whether distinct links ``u, v`` (``v`` the smaller) lead from each node straight to the smallest one it reaches."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        links.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    # No links: NULL.
    return (each.agg(F.max(F.col("up") + F.least("up", "down"))).first()[0] or 1) == 1
