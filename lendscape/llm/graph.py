"""Connected components as repeated star operations on edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscape.session import keep


def _stars(edges: DataFrame) -> bool:
    """Whether every node points at one centre, and centres at none."""
    centres = edges.select(F.col("v").alias("u"))
    rows, nodes = edges.agg(F.count(F.lit(1)), F.countDistinct("u")).first()
    return rows == nodes and edges.join(centres, "u", "left_semi").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``a, b``); the component is its smallest node.

    Large star and small star in turn: neighbours are tied to the smallest one
    around them until nothing moves. Groups are reduced to their minimum before
    they meet, and every step is written to the shared folder.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current = keep(pairs, "edges")
    while not _stars(current):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(lowest, "u")
        moved = tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = keep(moved.union(lowest.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
