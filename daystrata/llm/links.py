"""Classes of linked rows, by rounds of star contraction over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from daystrata.llm import common


def classes(edges: DataFrame) -> DataFrame:
    """(id, class_id): for each id in ``edges`` (a, b), the smallest id that links reach from it.

    Each round hangs the larger neighbours of an id, then the smaller ones, on the least of them.  Only minima
    are aggregated, never neighbour lists, so a hub with many links is no large group; each round is a table
    in the shared folder.  Edges with a null end or equal ends link nothing.
    """
    both = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).filter("a <> b")
    current = common.stored(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not _stars(current):
        # Larger ends of every id, to the least id around it.
        around = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = around.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Then every id and its smaller ends, to the least of those.
        lower = large.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        floor = lower.groupBy("a").agg(F.min("b").alias("m"))
        small = lower.join(floor, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(floor.select("a", F.col("m").alias("b")))
        current = common.stored(small.filter("a <> b").distinct(), "links")
    leaves = current.select(F.col("a").alias("id"), F.col("b").alias("class_id"))
    return leaves.unionByName(current.select(F.col("b").alias("id"), F.col("b").alias("class_id")).distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether each id has one smaller end, or only larger ones.  The rounds keep what is connected, so then each
    class is one star around its least id."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up > 1 or up = 1 and down = 1").isEmpty()
