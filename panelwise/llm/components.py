"""Connected components by contraction, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of the undirected links, root being the smallest node it reaches.

    Each round maps every node to the smallest of its closed neighbourhood and
    contracts the links; at least half of the nodes of each component go, so the
    rounds grow with the logarithm of the longest chain. Null ends are ignored;
    no links give no rows.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = stored(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    maps = []
    while not edges.isEmpty():
        both = edges.union(edges.select("v", "u"))
        step = stored(both.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p")))
        maps.append(step)
        left = edges.join(step.withColumnRenamed("p", "pu"), "u")
        moved = left.join(step.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v").where("pu <> pv")
        edges = stored(moved.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct())
    if not maps:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    out = maps[-1].select(F.col("u").alias("node"), F.col("p").alias("root"))
    for step in reversed(maps[:-1]):
        later = out.select(F.col("node").alias("p"), "root")
        out = stored(step.join(later, "p", "left").select(F.col("u").alias("node"), F.coalesce("root", "p").alias("root")))
    return out
