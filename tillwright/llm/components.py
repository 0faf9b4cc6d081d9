"""Connected components by alternating stars, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm.common import stored


def _towards_least(edges: DataFrame, upwards: bool) -> DataFrame:
    """One star step: link neighbours of every node to the least of them.

    ``upwards`` links the larger neighbours (large star), else the smaller ones and the node
    itself (small star).  The least is a grouped minimum, combined before its shuffle; the join
    back has one row per node on one side, and AQE splits hot nodes on the other.
    """
    if upwards:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:  # from the larger to the smaller end
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
    least = least.select("node", F.least("node", "least").alias("least"))
    joined = both.join(least, both["u"] == least["node"])
    if upwards:
        linked = joined.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    else:
        linked = joined.select(F.col("v").alias("u"), F.col("least").alias("v")).union(
            least.select(F.col("node").alias("u"), F.col("least").alias("v"))
        )
    return linked.where("u != v").distinct()


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``node, component`` for every node with an edge; the component is its least node.

    ``edges`` has columns ``u`` and ``v`` (long).  Every step is stored, which cuts the lineage;
    the steps end when the edges are stars around the least nodes and stay as they are.
    """
    now = stored(spark, edges.select("u", "v").where("u != v").distinct(), "edges")
    sums = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    before = tuple(now.agg(*sums).first())
    while True:
        now = stored(spark, _towards_least(_towards_least(now, True), False), "stars")
        after = tuple(now.agg(*sums).first())
        if after == before:
            break
        before = after
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
