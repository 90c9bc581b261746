"""Hard negatives by distributed radix selection.

A window asks for the k highest integer scores of one anchor within [lo, hi], among rows of its label or of the
others. Each pass deals a window's range into 2**digit_bits buckets of equal width: every shard counts its own scores
by bucket, from the highest bucket down and no further than the window still needs, counts of all shards
are summed, and the bucket that holds the k-th score becomes the window's range in the next pass. Once a window's
threshold is known, a last pass gathers the rows that reach it. Positives are such windows over all scores of the
anchor's label; each positive found then opens a window of its own over the other labels.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ball_tree import _matrix, scaled, usable
from .common import stash

#: Anchors whose scores against one shard are held at a time.
AT_ONCE = 128
ANCHOR = ("anchor_id", "anchor_key")
WINDOW = (*ANCHOR, "window")
_COUNTED = "anchor_id long, anchor_key long, window int, digit long, n long"
_FOUND = "anchor_id long, anchor_key long, window int, row_id long, row_key long, score long"


def _pack(shard: pa.Table) -> pa.Table:
    """A shard in one piece; components are whole numbers below 2**26, so four bytes hold one."""
    width, out = shard["width"][0].as_py(), io.BytesIO()
    np.savez(out, ids=shard["vec_id"].to_numpy(), keys=shard["key"].to_numpy(), labels=shard["label"].to_numpy(), rows=_matrix(shard["v"], width).astype(np.int32))
    return pa.table({"width": pa.array([width], pa.int32()), "shard": shard["shard"][:1].combine_chunks(), "rows": pa.array([out.getvalue()], pa.binary())})


def _scores(key, shards: pa.Table, anchors: pa.Table):
    """(scores, ids, keys of rows, anchor_id, anchor_key, window) of each window, scores within its range."""
    if not shards.num_rows or not anchors.num_rows:
        return
    width = key[0].as_py()
    with np.load(io.BytesIO(shards["rows"][0].as_py())) as shard:
        ids, keys, labels, rows = shard["ids"], shard["keys"], shard["labels"], shard["rows"].astype(np.float64)
    for first in range(0, anchors.num_rows, AT_ONCE):
        part = anchors.slice(first, AT_ONCE)
        scores = _matrix(part["q_v"], width) @ rows.T
        asked = zip(part["q_anchor_id"].to_pylist(), part["q_anchor_key"].to_pylist(), part["q_label"].to_pylist(), part["q_windows"].to_pylist(), strict=True)
        for score, (anchor, anchor_key, label, windows) in zip(scores.astype(np.int64), asked, strict=True):
            mine, other = labels == label, ids != anchor
            for w in windows:
                at = np.flatnonzero((mine if w["same"] else ~mine) & other & (score >= w["lo"]) & (score <= w["hi"]))
                if len(at):
                    yield score[at], ids[at], keys[at], anchor, anchor_key, w


def _rows(found: list[tuple], schema: str) -> pa.Table:
    names = [c.strip().split(" ") for c in schema.split(",")]
    columns = list(zip(*found, strict=True)) or [()] * len(names)
    return pa.table({c: pa.array(x, pa.int32() if kind == "int" else pa.int64()) for (c, kind), x in zip(names, columns, strict=True)})


def _count(key, shards: pa.Table, anchors: pa.Table) -> pa.Table:
    found: list[tuple] = []
    for score, _ids, _keys, anchor, anchor_key, w in _scores(key, shards, anchors):
        digit = (score - w["lo"]) >> w["shift"]
        if len(digit) > w["need"]:  # the bucket sought is not below the one that holds this shard's own k-th score
            digit = digit[digit >= np.partition(digit, len(digit) - w["need"])[len(digit) - w["need"]]]
        found += [(anchor, anchor_key, w["window"], d, n) for d, n in zip(*(x.tolist() for x in np.unique(digit, return_counts=True)), strict=True)]
    return _rows(found, _COUNTED)


def _gather(k: int):
    def run(key, shards: pa.Table, anchors: pa.Table) -> pa.Table:
        found: list[tuple] = []
        for score, ids, keys, anchor, anchor_key, w in _scores(key, shards, anchors):
            best = np.lexsort((keys, ids, -score))[:k]  # all above the threshold; of those at it, the first ids
            found += [(anchor, anchor_key, w["window"], *x) for x in zip(ids[best].tolist(), keys[best].tolist(), score[best].tolist(), strict=True)]
        return _rows(found, _FOUND)

    return run


class _Selection:
    """Shards of rows and blocks of anchors, met in one pass after another."""

    def __init__(self, clean: DataFrame, shard_rows: int, anchor_rows: int, digit_bits: int) -> None:
        sizes = clean.agg(F.count("*").alias("n"), F.sum(F.col("asked").cast("long")).alias("q")).first()
        self.shards, self.blocks, self.digit_bits = max(1, -(-sizes["n"] // shard_rows)), max(1, -(-(sizes["q"] or 0) // anchor_rows)), digit_bits
        dealt = clean.withColumn("shard", F.pmod(F.xxhash64("vec_id", "key"), F.lit(self.shards)))
        self.rows = stash(dealt.groupBy("width", "shard").applyInArrow(_pack, "width int, shard long, rows binary"), "shards")
        self.anchors = clean.where("asked").select(F.col("vec_id").alias("anchor_id"), F.col("key").alias("anchor_key"), "label", "v", "width", F.pmod(F.xxhash64("vec_id", "key", F.lit(7)), F.lit(self.blocks)).alias("block"))

    def _meet(self, windows: DataFrame, run, schema: str) -> DataFrame:
        fields = ("window", "same", "lo", "hi", "shift", "need")
        asked = windows.groupBy(*ANCHOR).agg(F.collect_list(F.struct(*fields)).alias("windows"))  # as many as an anchor has positives
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
        sent = self.anchors.join(asked, [*ANCHOR]).withColumn("shard", every(self.shards))
        left, key = self.rows.withColumn("block", every(self.blocks)), ("width", "shard", "block")
        right = sent.select(*(F.col(c).alias(f"q_{c}") for c in (*key, *ANCHOR, "label", "v", "windows")))
        return left.groupBy(*key).cogroup(right.groupBy(*(f"q_{c}" for c in key))).applyInArrow(run, schema)

    def select(self, windows: DataFrame, k: int) -> DataFrame:
        """anchor_id, anchor_key, window, rank, row_id, score: of each window (anchor_id, anchor_key, window, same,
        lo, hi) the k highest scores of rows within it, ties to the smaller id."""
        bits = F.length(F.bin(F.col("hi") - F.col("lo"))).cast("int")
        shift = F.greatest(bits - self.digit_bits, F.lit(0)).alias("shift")
        fields = [*WINDOW, "same"]
        # Ranges end at top; open ones have [lo, hi] still to search for need rows.
        state = stash(windows.select(*fields, "lo", "hi", F.col("hi").alias("top"), F.lit(k).cast("long").alias("need"), F.lit(True).alias("open")), "windows")
        done = state.where("not open")
        while True:
            asked = state.select("*", shift)
            counts = self._meet(asked, _count, _COUNTED).groupBy(*WINDOW, "digit").agg(F.sum("n").alias("n"))
            above = F.sum("n").over(Window.partitionBy(*WINDOW).orderBy(F.desc("digit")))
            reached = counts.withColumn("upto", above)
            # The highest bucket with which the need is met; without one, every row of the range is wanted.
            hit = reached.join(asked.select(*WINDOW, "need"), [*WINDOW]).where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
            found = asked.join(hit.select(*WINDOW, "digit", "n", "upto"), [*WINDOW], "left")
            size = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("shift"))
            base = F.col("lo") + size * F.coalesce("digit", F.lit(0).cast("long"))
            last = F.least("hi", base + size - 1)
            # A bucket of one score, or one that is wanted whole, ends the search.
            more = F.col("digit").isNotNull() & (F.col("shift") > 0) & (F.col("upto") > F.col("need"))
            moved = found.select(*fields, base.alias("lo"), F.when(F.col("digit").isNull(), F.col("hi")).otherwise(last).alias("hi"), "top", F.when(F.col("digit").isNull(), F.col("need")).otherwise(F.col("need") - (F.col("upto") - F.col("n"))).alias("need"), more.alias("open"))
            state = stash(moved, "windows")
            done = done.unionByName(state.where("not open"))
            state = state.where("open")
            if state.isEmpty():
                break
        wanted = done.select(*fields, "lo", F.col("top").alias("hi"), F.lit(0).alias("shift"), F.lit(k).cast("long").alias("need"))
        order = Window.partitionBy(*WINDOW).orderBy(F.desc("score"), "row_id", "row_key")
        return self._meet(wanted, _gather(k), _FOUND).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("row_key")


def _floor_div(x: Column, by: int) -> Column:
    return ((x - F.pmod(x, F.lit(by))) / F.lit(by)).cast("long")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column | None = None, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
    shard_rows: int = 16_384, anchor_rows: int = 4_096, digit_bits: int = 10,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and each of its
    positives (the rows of its label with the highest inner products) the first rows of other labels whose score lies
    within low to high per cent of the positive's.

    vectors has vec_id, embedding and label, or any label column given. Rows with a null id, label or vector, an empty
    vector or a null or non-finite component take no part. Vectors are compared with those of the same length only.
    Repeated rows count once; an id with several labels or vectors is an anchor with each of them, under the
    one id, and never its own positive or negative. Ties go to the smaller vec_id. A positive with a negative score has an
    empty window. Components times scale must fit 26 bits: products are summed in doubles, exactly up to 2**53.
    """
    v, label = F.col("embedding"), F.col("label") if label is None else label
    usable_rows = vectors.where(usable(v) & F.col("vec_id").isNotNull() & label.isNotNull())
    whole = usable_rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), scaled(v, scale).alias("v"), is_anchor.alias("asked"), F.size(v).alias("width"))
    clean = stash(whole.withColumn("key", F.xxhash64("label", "v")).dropDuplicates(["vec_id", "label", "v"]), "rows")
    chosen = _Selection(clean, shard_rows, anchor_rows, digit_bits)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda n, x: n + x.cast("double") * x.cast("double")))
    longest = clean.agg(F.max(norm)).first()[0] or 0.0
    bound = (F.ceil(norm * F.lit(longest)) + 1).cast("long")  # no product is larger
    first = clean.where("asked").select(F.col("vec_id").alias("anchor_id"), F.col("key").alias("anchor_key"), F.lit(0).alias("window"), F.lit(True).alias("same"), (-bound).alias("lo"), bound.alias("hi"))
    near = stash(chosen.select(first, positives), "positives")
    p = F.col("score")
    windows = near.select(*ANCHOR, F.col("rank").alias("window"), F.lit(False).alias("same"), (-_floor_div(-p * low, 100)).alias("lo"), _floor_div(p * high, 100).alias("hi")).where("lo <= hi")
    found = chosen.select(windows, negatives).withColumnRenamed("row_id", "negative_id").withColumnRenamed("score", "negative_score")
    named = near.select(*ANCHOR, F.col("rank").alias("window"), F.col("row_id").alias("positive_id"), p.alias("positive_score"))
    return found.join(named, [*WINDOW]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
