"""Closed intervals on the positions of a group (a chromosome, a user, ...).

Joins go through bins of a fixed width: an interval is listed under each bin it touches, a point under
one, so the join is an equality that shuffles evenly, and the exact condition is checked on what meets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import scans


def islands(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Every row with island (1, 2, ... within its keys): a row opens a new island if it starts
    after all rows before it have ended; touching intervals are one. Rows are dealt by position, however many a key has; the
    end reached and the islands opened before are carried from stretch to stretch."""
    order = (F.col(start), F.col(end))
    rows = scans.carry(scans.stretches(df, keys, *order), keys, F.max(end), F.max, "_reached")
    w = scans.within(keys, *order)
    reach = F.greatest(F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.col("_reached"))
    rows = rows.withColumn("_opens", (reach.isNull() | (F.col(start) > reach)).cast("int")).drop("_reached")
    rows = scans.carry(rows, keys, F.sum("_opens"), F.sum, "_opened")
    # By range: rows of equal start and end have one island, whichever of them came first.
    island = F.sum("_opens").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)) + F.coalesce("_opened", F.lit(0).cast("long"))
    return rows.withColumn("island", island).drop("_opens", "_opened", "_part")


def merged(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """One row per island: its keys, island, start, end and number of rows."""
    return islands(df, keys, start, end).groupBy(*keys, "island").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("n_members"))


def _bins(start: Column, end: Column, width: int) -> Column:
    return F.explode(F.sequence(F.floor(start / width), F.floor(end / width)))


def points_in(points: DataFrame, intervals: DataFrame, keys: Sequence[str], position: str, start: str, end: str, width: int) -> DataFrame:
    """Inner join of points with the intervals that hold them, both ends included."""
    p = points.withColumn("_bin", F.floor(F.col(position) / width))
    i = intervals.withColumn("_bin", _bins(F.col(start), F.col(end), width))
    return p.join(i, [*keys, "_bin"]).where(F.col(position).between(F.col(start), F.col(end))).drop("_bin")


def overlapping(left: DataFrame, right: DataFrame, keys: Sequence[str], width: int, padding: int = 0) -> DataFrame:
    """Pairs of left (l_id, l_start, l_end) and right (r_id, r_start, r_end) that overlap, or
    lie within padding of each other. A pair is met in each bin that both touch and kept in the
    first, so no distinct is needed."""
    a = left.withColumn("_bin", _bins(F.col("l_start") - padding, F.col("l_end") + padding, width))
    b = right.withColumn("_bin", _bins(F.col("r_start"), F.col("r_end"), width))
    meet = (F.col("l_start") - padding <= F.col("r_end")) & (F.col("r_start") <= F.col("l_end") + padding)
    first = F.floor(F.greatest(F.col("l_start") - padding, F.col("r_start")) / width)
    return a.join(b, [*keys, "_bin"]).where(meet & (F.col("_bin") == first)).drop("_bin")


def overlap_metrics(pairs: DataFrame) -> DataFrame:
    """overlap, fraction of either side, reciprocal (the less), Jaccard by the hull, gap."""
    overlap = F.greatest(F.lit(0), F.least("l_end", "r_end") - F.greatest("l_start", "r_start") + 1)
    hull = F.greatest("l_end", "r_end") - F.least("l_start", "r_start") + 1
    of_left, of_right = F.col("overlap") / (F.col("l_end") - F.col("l_start") + 1), F.col("overlap") / (F.col("r_end") - F.col("r_start") + 1)
    gap = F.greatest(F.lit(0), F.greatest("l_start", "r_start") - F.least("l_end", "r_end"))
    return pairs.withColumn("overlap", overlap).withColumn("left_fraction", of_left).withColumn("right_fraction", of_right).withColumn("reciprocal", F.least("left_fraction", "right_fraction")).withColumn("jaccard", F.when(F.col("overlap") > 0, F.col("overlap") / hull).otherwise(0.0)).withColumn("gap", gap)


def overlap_class(reciprocal: Column, same_lead: Column, strict: float = 0.5) -> Column:
    return F.when(same_lead, "EXACT_LEAD").when(reciprocal >= strict, "STRONG_OVERLAP").otherwise("PARTIAL")


def nearest(points: DataFrame, others: DataFrame, keys: Sequence[str], position: str, other: str) -> DataFrame:
    """points with the nearest other position of their keys and its distance, the lower one of two
    equally near; NULL without any. Both sides are dealt by position and gone through in order, no pair is made."""
    a = points.withColumn("_at", F.col(position)).withColumn("_point", F.lit(1)).withColumn("_other", F.lit(None).cast(others.schema[other].dataType))
    b = others.select(*keys, F.col(other).alias("_at"), F.lit(0).alias("_point"), F.col(other).alias("_other")).distinct()
    both = a.unionByName(b, allowMissingColumns=True)
    order = (F.col("_at"), F.col("_point"))
    rows, w = scans.stretches(both, keys, *order), scans.within(keys, *order)
    rows = scans.carry(rows, keys, F.max("_other"), F.max, "_lower")
    rows = scans.carry(rows, keys, F.min("_other"), F.min, "_higher", backwards=True)
    before = F.coalesce(F.max("_other").over(w.rowsBetween(Window.unboundedPreceding, 0)), "_lower")
    after = F.coalesce(F.min("_other").over(w.rowsBetween(0, Window.unboundedFollowing)), "_higher")
    near = rows.withColumn("_b", before).withColumn("_a", after).where("_point = 1")
    pick = F.when(F.col("_a").isNull() | (F.col(position) - F.col("_b") <= F.col("_a") - F.col(position)), F.col("_b")).otherwise(F.col("_a"))
    return near.withColumn("nearest", pick).withColumn("distance", F.abs(F.col(position) - F.col("nearest"))).drop("_at", "_point", "_other", "_b", "_a", "_part", "_lower", "_higher")


def window_around(position: Column, half_width: int, least: int = 1) -> tuple[Column, Column]:
    return F.greatest(F.lit(least), position - half_width), position + half_width
