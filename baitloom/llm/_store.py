"""Connected components over written tables, and tables of a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import discard, free_name, numbered, saved, scratch

__all__ = ["components", "discard", "free_name", "numbered", "saved", "scratch", "sized"]


def sized(frame: DataFrame, rows: int, most: int) -> DataFrame:
    """The frame, to be broadcast if it has at most so many rows."""
    return F.broadcast(frame) if rows <= most else frame


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of every node on an edge (a, b): the least node that it reaches.

    Large and small stars by turns, each from a written table, until no edge
    moves; then every edge goes from a node to its component's least one.
    """
    edges = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = saved(edges, name), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").unionByName(least.select("a", F.col("m").alias("b"))).distinct()
        edges = saved(small, name)
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        before = after
