"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum (combined map-side, so a hub vertex sends one
row per task) and a join back on the vertex (a sort-merge join whose hot side
adaptive execution splits). Each round's edges are written to the shared folder,
which also ends the lineage. The driver sees one checksum row per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from donorlens.llm.common import stage


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return (both.where("v > u").join(least, F.col("u") == F.col("w"))
            .select(F.col("v").alias("u"), F.least("m", "w").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge points from the larger to the smaller vertex here
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    linked = edges.join(least, F.col("u") == F.col("w"))
    return (linked.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
            .union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every vertex of ``edges`` (u, v): label is the component's smallest vertex."""
    now = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .where("u != v").distinct(), "edges")
    was = _checksum(now)
    while True:
        now = stage(_small_star(_large_star(now)), "edges")
        here = _checksum(now)
        if here == was:
            break
        was = here
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots)
