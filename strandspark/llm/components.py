"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, stash


#: Links that one task takes on alone, without shuffles: a few MB.
ONE_TASK = 200_000


def _gathered(df: DataFrame, n: int) -> DataFrame:
    return df.coalesce(1) if n <= ONE_TASK else df


def _least(edges: DataFrame, n: int) -> DataFrame:
    """Each edge (u, v) with the least of u and its v's."""
    least = edges.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return edges.join(small(least, n), "u")


def components(links: DataFrame) -> DataFrame:
    """node and label (the least node it reaches) of every node of links (a, b: long).

    Each round sends every node's neighbours to its least neighbour; rounds grow with the logarithm
    of the longest chain. Links of a node to itself name it and nothing more; repeated links count once.
    """
    edges = stash(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    # Each round counts its links; once there are few, rounds run in one task.
    n, before = edges.count(), None
    while True:
        both = _gathered(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), n)
        large = _least(both, n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stash(large, "large-stars")
        own = _least(_gathered(large, n), n)
        moved = _gathered(own.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own.select("u", F.col("m").alias("v"))), n).where("u <> v").distinct()
        edges = stash(moved, "small-stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first())
        if now == before:
            break
        before, n = now, now[0]
    reached = edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return reached.unionByName(reached.select(F.col("label").alias("node"), "label").distinct())
