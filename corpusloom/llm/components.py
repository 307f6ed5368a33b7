"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.storage import settle

ROUNDS = 60  # the number needed grows with the logarithm of the longest chain; reaching this is an error


def _least(links: DataFrame) -> DataFrame:
    """(u, v, least): every link with the lowest neighbour of u. Only the minimum is gathered per node, never a list."""
    low = links.groupBy("u").agg(F.min("v").alias("low"))
    return links.join(low, "u").select("u", "v", F.least("u", "low").alias("least"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of `links` (columns a, b); the component is its lowest node."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, mark = settle(edges), None
    for _ in range(ROUNDS):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        low = _least(large.distinct())
        small = low.select(F.explode(F.array(F.struct("u", F.col("least").alias("v")), F.struct(F.col("v").alias("u"), F.col("least").alias("v")))).alias("e"))
        edges = settle(small.select("e.u", "e.v").where("u <> v").distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == mark:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        mark = now
    raise RuntimeError("the links form chains too long for this number of rounds")
