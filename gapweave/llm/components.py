"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is two aggregations and joins on node ids; no task holds a node's whole
neighbourhood, the driver sees only two numbers a round, and every round is written to
the shared folder, so lineage stays one round long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import discard, materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v")
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges (u, v: long); component is the smallest node reachable.

    Nulls and loops are ignored; repeated edges and edges in both directions count once.
    An empty table gives an empty table.
    """
    now = materialise(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    seen = None
    while (state := _state(now)) != seen:
        seen = state
        big = materialise(_large_star(now), "large-star")
        after = materialise(_small_star(big), "small-star")
        discard(big)
        discard(now)
        now = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
