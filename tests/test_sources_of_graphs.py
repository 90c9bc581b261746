"""Searches from sources by whole arrays: dense graphs against plain loops, and blocks of sources against rounds."""

import random

import numpy as np
import pyarrow as pa

from strandspark.operators import graphs

EDGES = "a long, b long, score double, distance double"


def dense_graph():
    rng = random.Random(5)
    pairs = {(a, b) for a in range(20) for b in range(20, 90) if rng.random() < 0.7} | {(200, 201)}
    return [(a, b, 1.0, rng.choice([0.9, 0.91, 1.0])) for a, b in sorted(pairs)]


def test_dense_as_one_by_one():
    both = [x for a, b, _, d in dense_graph() for x in ((a, b, d), (b, a, d))]
    graph = graphs._graph(pa.table(dict(zip(("u", "v", "step"), map(list, zip(*both, strict=True)), strict=True))))
    n = len(graph[1]) - 1
    one, all_at_once = np.zeros(n), np.zeros(n)
    for s in range(n):
        graphs._from_source(s, graph[1], graph[2], graph[3], one)
        graphs._from_dense(graph, s, all_at_once)
    assert np.allclose(one, all_at_once) and one.any()


def test_blocks_of_seeds_write_no_rounds(spark):
    edges, seeds = dense_graph(), [0, 25, 200, 999]
    near = {}
    for a, b, _, d in edges:
        near.setdefault(a, {})[b] = near.setdefault(b, {})[a] = d
    want = {}
    for seed in seeds:
        far = {seed: (0, 0.0)}
        for _ in near:
            for u in list(far):
                for v, d in near.get(u, {}).items():
                    k, x = far.get(v, (10**9, 1e9))
                    far[v] = (min(k, far[u][0] + 1), min(x, far[u][1] + d))
        want |= {(seed, v): (k, round(x, 9)) for v, (k, x) in far.items()}
    spark.sparkContext.setJobGroup("blocks of seeds", "")
    rows = graphs.distances(spark.createDataFrame(edges, EDGES), spark.createDataFrame([(s,) for s in [*seeds, 0, None]], "node long")).collect()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("blocks of seeds")) <= 8
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(rows) == len(want) and {(r.seed, r.node): (r.hops, round(r.distance, 9)) for r in rows} == want


def test_packed_graphs_give_the_same_rows(spark):
    """Beyond shared_edges a graph is dealt a row a node, not in rounds: no folder of a round is written."""
    rng = random.Random(6)
    edges = [(a, b, s, rng.random() if a > 80 else d) for a, b, s, d in dense_graph()]  # some 700 steps, more than a byte tells apart
    df, seeds = spark.createDataFrame(edges, EDGES), spark.createDataFrame([(s,) for s in (0, 25, 200, 999)], "node long")
    few = spark.createDataFrame(dense_graph(), EDGES)
    asked = {
        "distances": lambda n: graphs.distances(df, seeds, shared_edges=n),
        "few steps": lambda n: graphs.distances(few, seeds, shared_edges=n),
        "paths": lambda n: graphs.hops(df, seeds, with_path=True, shared_edges=n),
        "texts": lambda n: graphs.hops(df, seeds, with_path=True, shared_edges=n, joined=">"),
        "closeness": lambda n: graphs.closeness(few, shared_edges=n),
        "betweenness": lambda n: graphs.betweenness(few, shared_edges=n),
    }
    for what, rows in asked.items():
        saved, folders = graphs._saved, []
        graphs._saved = lambda df: folders.append(1) or saved(df)  # noqa: B023
        try:
            packed = rows(400)
        finally:
            graphs._saved = saved
        assert len(folders) <= 5, what
        key = lambda r: tuple(r)[:2] if len(r) > 2 else r.node
        got, want = ({key(r): r for r in x.collect()} for x in (packed, rows(10**6)))
        assert got.keys() == want.keys() and len(got) > 50
        for k, r in got.items():
            assert all(abs(x - y) < 1e-12 if isinstance(x, float) else x == y for x, y in zip(r, want[k], strict=True)), (what, k)


def test_paths_as_text(spark):
    df, seeds = spark.createDataFrame(dense_graph(), EDGES), spark.createDataFrame([(s,) for s in (25, 200, 999)], "node long")
    want = {(r.seed, r.node): ">".join(map(str, r.path)) for r in graphs.hops(df, seeds, with_path=True).collect()}
    for shared in (10**6, 400, 0):
        assert {(r.seed, r.node): r.path for r in graphs.hops(df, seeds, with_path=True, shared_edges=shared, joined=">").collect()} == want
