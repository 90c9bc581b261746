"""Exact top-k by inner product: a ball tree over each shard, searched by branch and bound.

Vectors are dealt to shards of about shard_rows rows. A shard's ball tree (median splits along the
direction of the farthest pair) is built once and saved; queries go to the shards in blocks of query_rows. A
search bounds the scores in a ball by q.centre + |q| radius, and opens nodes in order of that bound until
it falls below the query's k-th score. Shards are searched in waves, each WAVE_GROWTH times as wide as the one
before: a wave begins from the k-th scores that all shards before it have given together.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

LEAF = 128
WAVE_GROWTH = 4


class BallTree:
    def __init__(self, ids: np.ndarray, rows: np.ndarray) -> None:
        order = np.arange(len(rows))
        self.nodes: list[tuple[int, int, int, int]] = []  # first, end, left, right
        centres, radii, waiting = [], [], [(0, len(rows), -1, False)]
        while waiting:
            lo, hi, parent, right = waiting.pop()
            k, mine = len(self.nodes), rows[order[lo:hi]]
            if parent >= 0:
                a, b, x, y = self.nodes[parent]
                self.nodes[parent] = (a, b, x, k) if right else (a, b, k, y)
            centre = mine.mean(0)
            far = ((mine - centre) ** 2).sum(1)
            centres.append(centre)
            radii.append(float(np.sqrt(far.max())) if len(far) else 0.0)
            self.nodes.append((lo, hi, -1, -1))
            if hi - lo > LEAF and radii[-1] > 0:
                one = mine[far.argmax()]
                two = mine[((mine - one) ** 2).sum(1).argmax()]
                order[lo:hi] = order[lo:hi][np.argpartition(mine @ (two - one), (hi - lo) // 2)]
                mid = (lo + hi) // 2
                waiting += [(mid, hi, k, True), (lo, mid, k, False)]
        self.ids, self.rows = ids[order], np.ascontiguousarray(rows[order])
        self.centres, self.radii = np.array(centres), np.array(radii)

    def saved(self) -> bytes:
        """All of the tree; components are whole numbers below 2**26, so four bytes hold one."""
        out = io.BytesIO()
        np.savez(out, ids=self.ids, rows=self.rows.astype(np.int32), centres=self.centres, radii=self.radii, nodes=np.array(self.nodes, np.int64))
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> BallTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as found:
            tree.ids, tree.rows, tree.centres, tree.radii = found["ids"], found["rows"].astype(np.float64), found["centres"], found["radii"]
            tree.nodes = [tuple(x) for x in found["nodes"].tolist()]
        return tree

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floors: np.ndarray) -> list[dict[int, int]]:
        """Per query the k best ids of the shard, ties to the smaller, that reach its floor, with their highest scores."""
        # The bound is rounded up a little, so that it never cuts off an equal score.
        bounds = queries @ self.centres.T + np.sqrt((queries**2).sum(1))[:, None] * self.radii
        bounds += 1e-9 * np.abs(bounds) + 1e-6
        out = []
        for q, mine, floor, bound in zip(queries, own.tolist(), floors.tolist(), bounds, strict=True):
            best: dict[int, int] = {}
            level, heap = floor, [(-bound[0], 0)]
            while heap:
                top, node = heapq.heappop(heap)
                if -top < level:
                    break
                lo, hi, left, right = self.nodes[node]
                if left >= 0:
                    for child in (left, right):
                        if bound[child] >= level:
                            heapq.heappush(heap, (-bound[child], child))
                    continue
                scores = self.rows[lo:hi] @ q
                at = np.flatnonzero((scores >= level) & (self.ids[lo:hi] != mine))
                for s, v in zip(scores[at].tolist(), self.ids[lo:hi][at].tolist(), strict=True):
                    if s < level or best.get(v, s - 1) >= s:
                        continue
                    best[v] = int(s)
                    if len(best) > k:
                        del best[min(best, key=lambda x: (best[x], -x))]
                    if len(best) == k:
                        level = max(level, min(best.values()))
            out.append(best)
        return out


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.array(column.combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, width)


def _build(shard: pa.Table) -> pa.Table:
    width = shard["width"][0].as_py()
    tree = BallTree(shard["vec_id"].to_numpy(), _matrix(shard["v"], width))
    return pa.table({"width": pa.array([width], pa.int32()), "shard": shard["shard"][:1].combine_chunks(), "tree": pa.array([tree.saved()], pa.binary())})


def _search(k: int):
    def run(key, trees: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if trees.num_rows and queries.num_rows:
            tree = BallTree.load(trees["tree"][0].as_py())
            asked, floors = queries["q_vec_id"].to_numpy(), queries["q_floor"].to_numpy().astype(np.float64)
            q = _matrix(queries["q_v"], key[0].as_py())
            found = [(a, v, s) for a, best in zip(asked.tolist(), tree.search(q, asked, k, floors), strict=True) for v, s in best.items()]
        columns = list(zip(*found, strict=True)) or [()] * 3
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    return run


def scaled(vector: Column, by: int) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(by))))


def usable(vector: Column) -> Column:
    inf = F.lit(float("inf"))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == inf))


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, shard_rows: int = 16_384, query_rows: int = 4_096) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query row
    with every other row, ties to the smaller vec_id.

    Vectors that are null or empty, or hold a null or non-finite component, take no part, and so do null
    ids; vectors are compared with those of the same length only. A vec_id that occurs on several rows is
    one query for each distinct vector and never its own candidate; repeated candidates count once.
    Components times scale must fit 26 bits, as products are summed in doubles, exactly up to 2**53.
    """
    spark = vectors.sparkSession
    v = F.col("embedding")
    clean = stash(vectors.where(usable(v) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), scaled(v, scale).alias("v"), is_query.alias("asked"), F.size(v).alias("width")).dropDuplicates(["vec_id", "v"]), "vectors")
    sizes = clean.agg(F.count("*").alias("n"), F.sum(F.col("asked").cast("long")).alias("q")).first()
    shards, q_blocks = max(1, -(-sizes["n"] // shard_rows)), max(1, -(-(sizes["q"] or 0) // query_rows))
    # Rows of one id are dealt by their vectors too, so that an id with many of them fills no shard.
    rows = clean.select("vec_id", "v", "width", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).alias("shard"))
    trees = stash(rows.groupBy("width", "shard").applyInArrow(_build, "width int, shard long, tree binary"), "trees")
    asked = clean.where("asked").select("vec_id", "v", "width", F.pmod(F.xxhash64("vec_id", "v", F.lit(7)), F.lit(q_blocks)).alias("q_block"))
    key = ("width", "shard", "q_block")

    def each(first: int, end: int) -> Column:
        return F.explode(F.sequence(F.lit(first).cast("long"), F.lit(end - 1).cast("long")))

    def best_of(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        highest = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return highest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    def wave(first: int, end: int, floors: DataFrame) -> DataFrame:
        left = trees.where(F.col("shard").between(first, end - 1)).withColumn("q_block", each(0, q_blocks))
        sent = asked.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-(1 << 62)))).withColumn("shard", each(first, end))
        right = sent.select(*(F.col(c).alias(f"q_{c}") for c in (*key, "vec_id", "v", "floor")))
        return left.groupBy(*key).cogroup(right.groupBy(*(f"q_{c}" for c in key))).applyInArrow(_search(k), "query_id long, vec_id long, score long")

    best = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    first, wide = 0, 1
    while first < shards:
        end = min(shards, first + wide)
        floors = best.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
        best = stash(best_of(best.drop("rank").unionByName(wave(first, end, floors))), "best-so-far")
        first, wide = end, wide * WAVE_GROWTH
    return best
