"""Connected components by alternating large and small stars, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carestrata.llm.common import stage


def _stars(both: DataFrame, keep) -> DataFrame:
    """Link every kept neighbour of a vertex to the smallest vertex of that neighbourhood."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    linked = both.join(least, "u")
    return linked.where(keep).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(u, component)`` of every vertex of ``edges (u, v)``; ``component`` is the smallest vertex reachable.

    Edges without a second end or with equal ends name no component. Repeated and reversed edges are one edge.
    Nothing is collected but one count and one checksum per round.
    """
    now = stage(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges"
    )
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both, F.col("v") > F.col("u")).distinct()
        # the smaller neighbours of a vertex, and the vertex itself, go to the smallest of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), "m"), F.struct("u", "m"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        now = stage(small, "edges")
    return now.groupBy("u").agg(F.min("v").alias("component")).union(
        now.select(F.col("v").alias("u"), F.col("v").alias("component")).distinct()
    )
