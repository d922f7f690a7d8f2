"""Connected components of an edge table by alternating large and small stars.

Every step is a join and an aggregation; the edges are written to the shared
scratch folder after each pair of steps, which cuts the lineage and survives a
lost executor. Edges never reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import write_scratch_table


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    joined = both.filter("b > a").join(least, F.col("a") == F.col("u"))
    return joined.select(F.least("u", "m").alias("a"), F.col("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
    joined = edges.join(least, F.col("b") == F.col("u"))
    moved = joined.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is either a centre or the end of one edge."""
    ends = edges.select(F.col("b").alias("n"), F.lit(1).alias("ends"), F.lit(0).alias("centre"))
    centres = edges.select(F.col("a").alias("n"), F.lit(0).alias("ends"), F.lit(1).alias("centre"))
    seen = ends.unionByName(centres).groupBy("n").agg(F.sum("ends").alias("ends"), F.max("centre").alias("centre"))
    return seen.filter("ends + centre > 1").isEmpty()


def stars(edges: DataFrame) -> DataFrame:
    """Edges (a, b), a < b, in; edges (smallest node of the component, other node) out."""
    now = write_scratch_table(edges.filter("a < b").select("a", "b").distinct(), "edges")
    while not _are_stars(now):
        now = write_scratch_table(_small_star(_large_star(now)), "edges")
    return now
