"""Connected components by alternating large-star and small-star steps, each a partial aggregation and a join.

Edges are a table in the shared folder between steps. Nothing is collected but counts. A hub's edges are reduced by
map-side aggregation and its join side may be split by adaptive execution, so no task needs a hub's whole neighbourhood.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), each in both directions. Large star: each larger neighbour is linked with the least one; small star: the others."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = edges.join(least.hint("merge"), "u")
    if large:
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    low = joined.where(F.col("v") < F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return low.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v")


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _settled(edges: DataFrame) -> bool:
    """Whether each node of edges (u, v) is either a centre or has one centre: one aggregation."""
    roles = edges.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("leaf"), F.lit(1).alias("centre")))
    return roles.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre")).where("leaf + centre > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of edges (u, v), u <> v; component is the least id reachable (the node itself included)."""
    now = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    while not _settled(now):
        large = written(_star(both_ways(now), True).distinct(), "edges")
        now = written(_star(both_ways(large), False).distinct(), "edges")
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
