"""Connected components by alternating star contractions (a distributed union-find)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailrisk.session import new_stage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "low"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is hung on the node's smallest neighbour."""
    both = edges.select("node", "low").unionByName(edges.select(F.col("low").alias("node"), F.col("node").alias("low")))
    least = both.groupBy("node").agg(F.least(F.min("low"), F.first("node")).alias("least"))
    larger = both.filter(F.col("low") > F.col("node")).withColumnRenamed("node", "hub")
    return larger.join(least.withColumnRenamed("node", "hub"), "hub").select(
        F.col("low").alias("node"), F.col("least").alias("low")
    ).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are hung on the smallest one."""
    least = edges.groupBy("node").agg(F.min("low").alias("least"))
    moved = edges.join(least, "node").select(F.col("low").alias("node"), F.col("least").alias("low"))
    own = least.select("node", F.col("least").alias("low"))
    return moved.filter(F.col("node") > F.col("low")).unionByName(own).distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, low``: the smallest node reachable, for all nodes but those.

    ``edges`` has columns ``node > low`` of one orderable type, without nulls.
    Neighbourhoods are never gathered: a hub is a minimum with map-side
    combining and a join that adaptive execution can split. Each round is
    written, so a lost executor costs one round; rounds grow with the logarithm
    of the longest path. Empty edges give no rows.
    """
    current = new_stage(edges.select("node", "low").distinct(), name)
    mark = _mark(current.rows)
    while mark[0]:
        following = new_stage(_small_star(_large_star(current.rows)), name)
        current.remove()
        current, before, mark = following, mark, _mark(following.rows)
        if mark == before:
            break
    return current.rows
