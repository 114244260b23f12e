"""Connected components by alternating large and small stars.

Every round rewires links towards the smallest member and lands the link table
in the shared folder. Minima are aggregated before the shuffle, so a member
with very many links sends one row per task, and landed before links look them
up, so that the skew join can cut such a member.

Cases: a link of a member with itself says nothing; repeated links and either
direction are one link; no links give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.llm.common import landed


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = landed(both.groupBy("a").agg(F.min("b").alias("low")))
    low = F.least("a", "low")
    return both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), low.alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    lowest = landed(links.groupBy("a").agg(F.min("b").alias("low")))
    others = links.join(lowest, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return others.union(lowest.select("a", F.col("low").alias("b")))


def _seal(links: DataFrame) -> tuple:
    return tuple(links.selectExpr("count(1)", "bit_xor(xxhash64(a, b))").first())


def component_of_nodes(links: DataFrame) -> DataFrame:
    """``links`` has columns a and b, in any direction, repeats allowed. Returns
    (node, component) for every node but the smallest of its component, which
    names it. Nodes without a link do not appear. Runs jobs."""
    links = landed(
        links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    seal = _seal(links)
    while seal[0]:
        links = landed(_small_star(landed(_large_star(links).distinct())).distinct())
        before, seal = seal, _seal(links)
        if seal == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
