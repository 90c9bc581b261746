"""Running values along an order without one task a key.

Rows are dealt over tasks by range of keys and order, so each task has a stretch of the order and a key may lie on
several. Each stretch is gone through alone; what stands before it within its key (an end reached, a count, a position) is
carried in from a table that has one row a stretch at most, as only the first key of a stretch can have begun before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .graphs import _saved

_FIRST, _LAST = Window.unboundedPreceding, Window.unboundedFollowing


def stretches(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """df with _part, the stretch of a row; equal places in the order are in one."""
    return _saved(df.repartitionByRange(*(F.col(k) for k in keys), *order).withColumn("_part", F.spark_partition_id()))


def within(keys: Sequence[str], *order: Column) -> WindowSpec:
    return Window.partitionBy("_part", *keys).orderBy(*order)


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    met = F.lit(True)
    for c in names:
        met = met & left[c].eqNullSafe(right[f"_r_{c}"])
    return met


def _beside(df: DataFrame, table: DataFrame, names: Sequence[str], how: str = "left") -> DataFrame:
    """df and the row of table with equal names, a null being equal to a null."""
    renamed = table.select(*(F.col(c).alias(f"_r_{c}") for c in names), *(c for c in table.columns if c not in names))
    return df.join(renamed, _same(df, renamed, names), how).drop(*(f"_r_{c}" for c in names))


def carry(parts: DataFrame, keys: Sequence[str], value: Column, over: Callable[[str], Column], into: str, backwards: bool = False) -> DataFrame:
    """parts with a column that has value (an aggregate) over the rows of its key in all stretches before its own, or
    after it: over joins the values of several stretches. NULL where there are none."""
    each = parts.groupBy("_part", *keys).agg(value.alias("_value"))
    order = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(F.col("_part").desc() if backwards else F.col("_part"))
    before = each.select("_part", *keys, over("_value").over(order.rowsBetween(_FIRST, -1)).alias(into)).where(F.col(into).isNotNull())
    return _beside(parts, F.broadcast(before), ["_part", *keys])


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[Column], into: str) -> DataFrame:
    """df with its place from 1 within its keys; order should leave no ties."""
    parts = carry(stretches(df, keys, *order), keys, F.count(F.lit(1)), F.sum, "_before")
    place = F.row_number().over(within(keys, *order)) + F.coalesce("_before", F.lit(0).cast("long"))
    return parts.withColumn(into, place.cast("long")).drop("_part", "_before")


def value_places(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, value, same and before of each distinct value that is not NULL: rows that have it, and rows with a lower one. Rows
    are counted before they move, so a value of very many rows is one row here."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("same"))
    parts = carry(stretches(counts, keys, F.col(value)), keys, F.sum("same"), F.sum, "_before")
    run = F.sum("same").over(within(keys, F.col(value)).rowsBetween(_FIRST, -1))
    return parts.withColumn("before", F.coalesce(run, F.lit(0).cast("long")) + F.coalesce("_before", F.lit(0).cast("long"))).drop("_before")


def min_ranks(df: DataFrame, keys: Sequence[str], value: str, into: str) -> DataFrame:
    """df with the rank of its value, ties having the first of their places; NULL has none."""
    places = value_places(df, keys, value).select(*keys, value, (F.col("before") + 1).alias(into))
    return _beside(df, places, [*keys, value])


def percentile_ranks(df: DataFrame, keys: Sequence[str], value: str, into: str, lone_is_zero: bool = True) -> DataFrame:
    """df with the average rank of ties over the number of values, NULL for NULL. With lone_is_zero, one value or
    none gives 0.0 for all rows of the key."""
    places = _saved(value_places(df, keys, value).drop("_part"))
    n = places.groupBy(*keys).agg(F.sum("same").alias("_n"))
    share = (F.col("before") + (F.col("same") + 1) / 2.0) / F.col("_n")
    ranks = _beside(places, n, keys, "inner").select(*keys, value, share.alias(into)) if keys else places.join(F.broadcast(n)).select(value, share.alias(into))
    out = _beside(df, ranks, [*keys, value])
    if not lone_is_zero:
        return out
    lone = n.where("_n > 1").withColumn("_many", F.lit(True)).drop("_n")
    counted = _beside(out, lone, keys) if keys else out.join(F.broadcast(lone), how="left")
    return counted.withColumn(into, F.when(F.col("_many").isNull(), F.lit(0.0)).otherwise(F.col(into))).drop("_many")


def bh_fdr(df: DataFrame, p: str, into: str, keys: Sequence[str] = ()) -> DataFrame:
    """df with the adjusted value: least of p n / rank from here to the largest p of its keys, at most 1; NULL for
    NULL, which doesn't count. All that share a p have the value of the last of them."""
    keys = list(keys)
    places = value_places(df, keys, p)
    n = df.groupBy(*keys).agg(F.count(p).alias("_n"))
    raw = F.col(p) * F.col("_n") / (F.col("before") + F.col("same"))
    priced = (_beside(places, n, keys, "inner") if keys else places.join(F.broadcast(n))).withColumn("_raw", raw)
    priced = carry(_saved(priced), keys, F.min("_raw"), F.min, "_after", backwards=True)
    least = F.least(F.min("_raw").over(within(keys, F.col(p)).rowsBetween(0, _LAST)), F.col("_after"), F.lit(1.0))
    return _beside(df, priced.select(*keys, p, least.alias(into)), [*keys, p])
