"""Networks against plain loops on random graphs, with ties, pendants, several components and no edges."""

import random
from collections import deque

import pytest

from strandspark.operators import graphs

EDGES = "a long, b long, score double, distance double"


def random_graph(seed, n=26, m=50):
    rng = random.Random(seed)
    pairs = {tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)} | {(100, 101), (200, 201), (201, 202)}
    return [(a, b, s, 1 - s) for a, b in sorted(pairs) for s in [rng.choice([0.25, 0.5, 0.75])]]  # many paths are equally long


def neighbours(edges):
    near = {}
    for a, b, s, d in edges:
        near.setdefault(a, {})[b] = (s, d)
        near.setdefault(b, {})[a] = (s, d)
    return near


def all_paths_through(edges):
    """Betweenness from counts of shortest paths between all pairs."""
    near = neighbours(edges)
    nodes, inf = sorted(near), float("inf")
    far = {(u, v): 0.0 if u == v else near[u].get(v, (0, inf))[1] for u in nodes for v in nodes}
    for k in nodes:
        for u in nodes:
            for v in nodes:
                far[u, v] = min(far[u, v], far[u, k] + far[k, v])
    count = {}
    for s in nodes:
        count[s, s] = 1
        for v in sorted((v for v in nodes if v != s and far[s, v] < inf), key=lambda v: far[s, v]):
            count[s, v] = sum(count[s, u] for u, (_, d) in near[v].items() if abs(far[s, u] + d - far[s, v]) < 1e-9)
    n = len(nodes)
    out = {}
    for x in nodes:
        total = sum(count[s, x] * count[x, t] / count[s, t] for s in nodes for t in nodes if s != t and x not in (s, t) and far[s, t] < inf and abs(far[s, x] + far[x, t] - far[s, t]) < 1e-9)
        out[x] = total / ((n - 1) * (n - 2))
    return out


def first_reached(near, seed):
    """Hops and paths breadth first; of several ways to a node that by the least node before it."""
    path, queue = {seed: [seed]}, deque([seed])
    while queue:
        level = list(queue)
        queue.clear()
        offered = {}
        for u in level:
            for v in near.get(u, ()):
                if v not in path:
                    offered[v] = min(offered.get(v, u), u)
        for v, u in offered.items():
            path[v] = [*path[u], v]
            queue.append(v)
    return path


@pytest.mark.parametrize(("seed", "shared"), [(1, 10_000), (1, 0), (2, 0)])
def test_betweenness(spark, seed, shared):
    edges = random_graph(seed)
    got = {r.node: r.betweenness for r in graphs.betweenness(spark.createDataFrame(edges, EDGES), shared_edges=shared, block_pairs=300 if seed == 2 else 10**6).collect()}
    want = all_paths_through(edges)
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-9 for x in want)


def test_paths_and_closeness(spark):
    edges = random_graph(3)
    near, df = neighbours(edges), spark.createDataFrame(edges, EDGES)
    seeds = spark.createDataFrame([(0,), (5,), (100,), (999,), (0,), (None,)], "node long")
    got = {(r.seed, r.node): (r.hops, r.path) for r in graphs.hops(df, seeds, with_path=True).collect()}
    assert got == {(s, v): (len(p) - 1, p) for s in (0, 5, 100, 999) for v, p in first_reached(near, s).items()}
    close = {r.node: r.closeness for r in graphs.closeness(df).collect()}
    for v in near:
        far = [len(p) - 1 for p in first_reached(near, v).values()]
        assert abs(close[v] - (len(far) - 1) ** 2 / (sum(far) * (len(near) - 1))) < 1e-12
    none = df.limit(0)
    assert graphs.hops(none, seeds.limit(0)).count() == graphs.closeness(none).count() == graphs.betweenness(none).count() == graphs.communities(none).count() == 0


def modularity(edges, label):
    total, inside, degree = sum(e[2] for e in edges), 0.0, {}
    for a, b, s, _ in edges:
        inside += s * (label[a] == label[b])
        for x in (a, b):
            degree[label[x]] = degree.get(label[x], 0.0) + s
    return inside / total - sum((d / (2 * total)) ** 2 for d in degree.values()), degree


@pytest.mark.parametrize("seed", [4, 5])
def test_communities_cannot_gain_by_one_more_merge(spark, seed):
    rng = random.Random(seed)
    edges = [(a, b, 1.0, 1.0) for a in range(40) for b in range(a + 1, 40) if rng.random() < (0.6 if a // 10 == b // 10 else 0.04)]
    edges += [(50, k, 1.0, 1.0) for k in range(51, 90)]  # a hub with leaves
    label = {r.node: r.community for r in graphs.communities(spark.createDataFrame(edges, EDGES)).collect()}
    quality, degree = modularity(edges, label)
    total = len(edges)
    between = {}
    for a, b, s, _ in edges:
        if label[a] != label[b]:
            key = tuple(sorted((label[a], label[b])))
            between[key] = between.get(key, 0.0) + s
    assert all(w / total - degree[x] * degree[y] / (2 * total**2) <= 1e-9 for (x, y), w in between.items())
    planted, _ = modularity(edges, {v: v // 10 if v < 40 else 50 for v in label})
    assert quality >= 0.85 * planted and len({label[k] for k in range(50, 90)}) == 1
    assert all(min(v for v in label if label[v] == c) == c for c in set(label.values()))


def test_communities_gain_by_any_weight_beside_a_great_one(spark):
    edges = [(1, 2, 1e13, 1.0), (3, 4, 1.0, 1.0), (4, 5, 1.0, 1.0)]
    label = {r.node: r.community for r in graphs.communities(spark.createDataFrame(edges, EDGES)).collect()}
    assert label == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3}  # gains of 1e-13 of the whole were none before


def test_communities_with_links_below_zero(spark):
    edges = [("a", "b", 3.0), ("b", "c", 3.0), ("a", "c", -1.0), ("x", "y", 2.0), ("c", "x", 0.5)]
    label = {r.node: r.community for r in graphs.communities(spark.createDataFrame(edges, "a string, b string, score double")).collect()}
    assert label == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}
    none = spark.createDataFrame([("a", "b", 0.0)], "a string, b string, score double")
    assert {r.node: r.community for r in graphs.communities(none).collect()} == {"a": "a", "b": "b"}


def test_page_rank_spreads_what_dead_ends_hold(spark):
    edges = [(1, 2, 1.0), (2, 3, 2.0), (4, 5, 0.0)]
    rank = {r.node: r.rank for r in graphs.page_rank(spark.createDataFrame(edges, "a long, b long, score double"), tolerance=1e-12, rounds=60).collect()}
    n, flow, x = 5, {1: {2: 1.0}, 2: {1: 1 / 3, 3: 2 / 3}, 3: {2: 1.0}}, dict.fromkeys((1, 2, 3, 4, 5), 0.2)
    for _ in range(200):
        lost = x[4] + x[5]
        x = {v: 0.15 / n + 0.85 * (sum(x[u] * to.get(v, 0.0) for u, to in flow.items()) + lost / n) for v in x}
    assert all(abs(rank[v] - x[v]) < 1e-5 for v in x) and abs(sum(rank.values()) - 1) < 1e-9
