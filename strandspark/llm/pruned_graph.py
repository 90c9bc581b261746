"""Approximate nearest neighbours by cosine: a robust-pruned directed graph over each shard, searched by beam.

Vectors are scaled to length one, so the nearest by distance is the nearest by cosine. A shard's graph grows in
batches: a greedy search from the entry node proposes neighbours for each new node, and pruning keeps an
edge to the nearest, drops every candidate that lies much closer to it than to the node (relax times, in squared
distances), and goes on with the rest, so that up to degree diverse edges stay. Edges are then offered backwards, and a
node with too many is pruned again. Nodes that no path from the entry reaches at the end get an edge from the nearest
node that one does. Queries go to every shard; the best of all shards are ranked by their exact cosines.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ball_tree import _matrix, usable
from .common import stash

#: Nodes that are searched or pruned together.
TOGETHER = 256
#: Nodes of a beam whose edges are followed in one step.
FAN = 4
#: Edges a node may gather beyond degree before it is pruned again.
SLACK = 16


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows at length one; a power of two comes off first, so that no square overflows or vanishes."""
    plain = np.ldexp(rows, -np.frexp(np.abs(rows).max(1, initial=0.0))[1][:, None])
    return plain / np.sqrt((plain * plain).sum(1))[:, None]


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of the query with each row, in double precision, from the vectors as they are."""
    q, r = (np.ldexp(x, -np.frexp(np.abs(x).max(-1, keepdims=True))[1]) for x in (query, rows))
    return (r * q).sum(1) / (np.sqrt((q * q).sum()) * np.sqrt((r * r).sum(1)))


def beam_search(rows: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, inner products) of the beam of each query, best first; -1 and -inf where the beam is not full.
    edges has a row of distinct node numbers for each node, -1 where there is none."""
    n, fan = len(queries), min(FAN, width)
    nodes, scores = np.full((n, width), -1, np.int64), np.full((n, width), -np.inf)
    ahead = np.full((n, width), -np.inf)  # scores of nodes whose edges have not been followed yet
    nodes[:, 0] = entry
    ahead[:, 0] = scores[:, 0] = queries @ rows[entry]
    seen = np.zeros((n, len(rows)), np.int16)  # 0: not met, else the place at which it was offered
    seen[:, entry] = 1
    live, place = np.arange(n), np.arange(1, fan * edges.shape[1] + 1, dtype=np.int16)
    while len(live):
        at = np.argpartition(ahead[live], width - fan, 1)[:, width - fan :]
        on = np.isfinite(np.take_along_axis(ahead[live], at, 1))
        going = on.any(1)
        live, at, on = live[going], at[going], on[going]
        if not len(live):
            break
        near = np.where(on[:, :, None], edges[nodes[live[:, None], at]], -1).reshape(len(live), fan * edges.shape[1])
        ahead[live[:, None], at] = -np.inf
        row, col = np.nonzero((near >= 0) & (seen[live[:, None], near] == 0))
        node, mine = near[row, col], live[row]
        seen[mine, node] = place[col]
        once = seen[mine, node] == place[col]  # offered by several of the nodes followed: kept once
        row, col, node, mine = row[once], col[once], node[once], mine[once]
        got = np.full(near.shape, -np.inf)
        got[row, col] = np.einsum("ed,ed->e", rows[node], queries[mine])
        both, score, todo = np.concatenate([nodes[live], near], 1), np.concatenate([scores[live], got], 1), np.concatenate([ahead[live], got], 1)
        best = np.argpartition(score, score.shape[1] - width, 1)[:, score.shape[1] - width :]
        nodes[live], scores[live], ahead[live] = (np.take_along_axis(x, best, 1) for x in (both, score, todo))
    order = np.argsort(-scores, 1, kind="stable")
    nodes, scores = np.take_along_axis(nodes, order, 1), np.take_along_axis(scores, order, 1)
    return np.where(np.isfinite(scores), nodes, -1), scores


def robust_prune(rows: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Up to degree diverse edges of each node of own, -1 beyond; candidates (-1: none) has a row for each."""
    n, m = candidates.shape
    points = rows[candidates]
    left = (candidates >= 0) & (candidates != own[:, None])
    far = np.where(left, 2 - 2 * np.einsum("nmd,nd->nm", points, rows[own]), np.inf)
    between = 2 - 2 * (points @ points.transpose(0, 2, 1))
    out, k = np.full((n, degree), -1, np.int64), np.arange(n)
    for d in range(degree):
        best = far.argmin(1)
        some = np.isfinite(far[k, best])
        if not some.any():
            break
        out[some, d] = candidates[some, best[some]]
        far[k, best] = np.inf
        far[some[:, None] & ((relax * between[k, best] <= far) | (candidates == candidates[k, best][:, None]))] = np.inf
    return out


class PrunedGraph:
    """edges over rows of length one, with the entry node: the one nearest to their mean."""

    def __init__(self, rows: np.ndarray, degree: int, width: int, relax: float) -> None:
        self.rows, n = rows, len(rows)
        self.entry = int((rows @ rows.mean(0)).argmax())
        self.edges, self.used = np.full((n, degree + SLACK), -1, np.int32), np.zeros(n, np.int64)
        order = np.random.default_rng(n).permutation(n)
        order, first = np.r_[self.entry, order[order != self.entry]], 1
        while first < n:  # each batch at most as large as the graph before it
            mine = order[first : first + min(first, TOGETHER)]
            first += len(mine)
            found, _ = beam_search(rows, self.edges, self.entry, rows[mine], width)
            kept = robust_prune(rows, mine, found, degree, relax)
            self.edges[mine, :degree], self.used[mine] = kept, (kept >= 0).sum(1)
            self._back(mine, kept, degree, relax)
        self._reach(width)

    def _reach(self, width: int) -> None:
        known, front = np.zeros(len(self.rows), bool), np.array([self.entry])
        while True:
            while len(front):
                known[front] = True
                front = np.unique(self.edges[front])
                front = front[(front >= 0) & ~known[np.maximum(front, 0)]]
            lost = np.flatnonzero(~known)[:TOGETHER]
            if not len(lost):
                return
            found, _ = beam_search(self.rows, self.edges, self.entry, self.rows[lost], width)
            for node, near in zip(lost.tolist(), found[:, 0].tolist(), strict=True):
                if self.used[near] == self.edges.shape[1]:
                    self.edges = np.concatenate([self.edges, np.full((len(self.rows), SLACK), -1, np.int32)], 1)
                self.edges[near, self.used[near]] = node
                self.used[near] += 1
            front = lost

    def _back(self, mine: np.ndarray, kept: np.ndarray, degree: int, relax: float) -> None:
        edges, used, room = self.edges, self.used, self.edges.shape[1]
        at = np.nonzero(kept >= 0)
        target, source = kept[at], mine[at[0]]
        known = (edges[target] == source[:, None]).any(1)
        target, source = target[~known], source[~known]
        while len(target):
            order = np.argsort(target, kind="stable")
            target, source = target[order], source[order]
            begin = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
            place = np.arange(len(target)) - np.repeat(begin, np.diff(np.r_[begin, len(target)]))
            fits = used[target] + place < room
            edges[target[fits], (used[target] + place)[fits]] = source[fits]
            np.add.at(used, target[fits], 1)
            target, source = target[~fits], source[~fits]
            for part in np.array_split(np.unique(target), max(1, len(target) // TOGETHER)):
                if len(part):
                    pruned = robust_prune(self.rows, part, edges[part], degree, relax)
                    edges[part], used[part] = -1, (pruned >= 0).sum(1)
                    edges[part, :degree] = pruned

    def saved(self, vectors: np.ndarray) -> bytes:
        out, plain = io.BytesIO(), vectors.astype(np.float32)
        np.savez(out, vectors=plain if (plain == vectors).all() else vectors, edges=self.edges, entry=self.entry)
        return out.getvalue()


def _build(degree: int, width: int, relax: float):
    def run(shard: pa.Table) -> pa.Table:
        vectors, ids = _matrix(shard["v"], shard["width"][0].as_py()), shard["ids"].to_pylist()
        order = sorted(range(len(ids)), key=lambda r: (ids[r], vectors[r].tobytes()))  # rows come in any order
        vectors, ids = vectors[order], [ids[r] for r in order]
        graph = PrunedGraph(unit(vectors), degree, width, relax)
        return pa.table({"width": shard["width"][:1].combine_chunks(), "shard": shard["shard"][:1].combine_chunks(), "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))), "graph": pa.array([graph.saved(vectors)], pa.binary())})

    return run


def _search(k: int, beam: int):
    def run(key, graphs: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if graphs.num_rows and queries.num_rows:
            with np.load(io.BytesIO(graphs["graph"][0].as_py())) as saved:
                vectors, edges, entry = saved["vectors"].astype(np.float64), saved["edges"], int(saved["entry"])
            rows, ids = unit(vectors), graphs["ids"][0].as_py()
            asked, q = queries["q_vec_id"].to_pylist(), _matrix(queries["q_v"], key[0].as_py())
            for first in range(0, len(asked), TOGETHER):
                nodes, _ = beam_search(rows, edges, entry, unit(q[first : first + TOGETHER]), beam)
                for own, vector, near in zip(asked[first:], q[first : first + TOGETHER], nodes, strict=False):
                    near = near[near >= 0]
                    each = [(-s, v) for s, node in zip(cosines(vector, vectors[near]).tolist(), near.tolist(), strict=True) for v in ids[node] if v != own]
                    found += [(own, v, -s) for s, v in sorted(each)[:k]]
        columns = list(zip(*found, strict=True)) or [()] * 3
        return pa.table({c: pa.array(x, kind) for c, x, kind in zip(("query_id", "vec_id", "score"), columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)})

    return run


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, beam: int = 128, degree: int = 32, width: int = 64, relax: float = 1.2, shard_rows: int = 16_384, query_rows: int = 4_096
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest by cosine that a beam of the given width finds for each query
    row among all other rows, nearest first, ties to the smaller vec_id; fewer only where there are fewer candidates.

    Vectors that are null, empty or zero, or hold a null or non-finite component, take no part, and so do null ids;
    vectors are compared with those of the same length only. Equal vectors are one node of a graph with their k + 1
    smallest ids, which is all that k results besides the query's own can need. An id that occurs on several rows is
    a query with each distinct vector and never its own candidate; it counts once, with its highest score. degree, width and relax are
    those of the graph, which holds every vector; nothing is sampled. Which shard and place a vector has follows from the vectors
    alone, so that results do not change between runs.
    """
    v = F.col("embedding")
    fit = usable(v) & F.exists(v, lambda x: x.cast("double") != 0.0) & F.col("vec_id").isNotNull()
    clean = stash(vectors.where(fit).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), is_query.alias("asked"), F.size(v).alias("width")).dropDuplicates(["vec_id", "v"]), "vectors")
    first = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    nodes = clean.withColumn("n", first).where(F.col("n") <= k + 1).groupBy("v", "width").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    rows, asked_rows = clean.agg(F.count("*"), F.count(F.when(F.col("asked"), 1))).first()
    shards, blocks = max(1, -(-rows // shard_rows)), max(1, -(-asked_rows // query_rows))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)))
    graphs = stash(dealt.groupBy("width", "shard").applyInArrow(_build(degree, width, relax), "width int, shard long, ids array<array<long>>, graph binary"), "graphs")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    key = ("width", "shard", "block")
    asked = clean.where("asked").select("vec_id", "v", "width", F.pmod(F.xxhash64("vec_id", "v", F.lit(7)), F.lit(blocks)).alias("block")).withColumn("shard", each(shards))
    left, right = graphs.withColumn("block", each(blocks)), asked.select(*(F.col(c).alias(f"q_{c}") for c in (*key, "vec_id", "v")))
    found = left.groupBy(*key).cogroup(right.groupBy(*(f"q_{c}" for c in key))).applyInArrow(_search(k, max(beam, k + 1)), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
