"""Connected components of a link table, by joins and aggregates only.

Alternating star contraction: in the large step every node hands its larger
neighbours to the smallest of its neighbourhood, in the small step its smaller
ones, until all links are stars around their smallest node, which is looked up
without another turn. The number of turns grows with the logarithm of the
longest chain. Each turn's links are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeloom.llm.common import saved
from lakeloom.operators.joins import placed_anew


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One step on links (hi, lo), lo < hi. It gives no more rows than links, but may repeat some."""
    if large:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    else:
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(placed_anew(least, ["u"]), "u")  # so that AQE can split a hub
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        moved = joined.where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).unionByName(
            least.where("u <> m").select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return moved.where("hi <> lo")


def _unsettled(links: DataFrame) -> int:
    """How many nodes have two smaller neighbours, or a smaller and a larger one."""
    ends = links.select(F.explode(F.array(F.struct(F.col("hi").alias("node"), "lo"), F.struct(F.col("lo").alias("node"), F.lit(None).cast("long").alias("lo")))).alias("end")).select("end.*")
    seen = ends.groupBy("node").agg(F.min("lo").alias("least"), F.max("lo").alias("most"), F.count("lo").alias("smaller"), F.count(F.lit(1)).alias("all"))
    return seen.where("least <> most or (smaller > 0 and smaller < all)").count()


def components(links: DataFrame) -> DataFrame:
    """Per node that has a link: node, root (the smallest node reachable). ``links``: columns a, b (longs)."""
    now = saved(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct(), "links")
    while _unsettled(now):
        now = saved(_star(_star(now, large=True), large=False).distinct(), "links")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
