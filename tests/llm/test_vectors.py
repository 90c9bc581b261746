"""Nearest neighbours and hard negatives against plain loops, with repeats, ties and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandspark.llm import hard_negatives, pruned_graph

SCHEMA = "vec_id long, embedding array<double>, label int"
ODD = [(None, [1.0, 2.0, 0.5, 1.0], 1), (900, None, 1), (901, [], 1), (902, [1.0, None, 0.0, 1.0], 1), (903, [float("nan"), 1.0, 1.0, 1.0], 2), (904, [float("inf"), 1.0, 1.0, 1.0], 2), (905, [0.0] * 4, 2), (906, [1.0, 2.0], 1), (907, [1e200, 2e200, 0.0, 1e200], 3), (908, [1.0, 1.0, 1.0, 1.0], None)]


def rows(n=400, width=4, seed=0, labels=3):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, width)).round(2)
    v[n // 2 : n // 2 + n // 3] = v[0]  # a third of all rows are one vector
    v[-20:] = v[:20]
    return [(i, x, int(k)) for (i, x), k in zip(enumerate(v.tolist()), rng.integers(0, labels, n), strict=True)]


def clashing(df):
    return df.select("*", *(F.lit("clash").alias(c) for c in ("v", "width", "asked", "shard", "block", "key", "rank", "score", "window", "n", "ids")))


def fits(data, need_label=False, zero=True):
    for i, v, k in data:
        if i is not None and v and None not in v and np.isfinite(v).all() and (zero or any(v)) and not (need_label and k is None):
            yield i, v, k


def brute_nearest(data, every, k):
    data, want = list(fits(data, zero=False)), {}
    for q, x, _ in data:
        if q % every == 0:
            found: dict = {}
            for i, v, _ in data:
                if i != q and len(v) == len(x):
                    s = float(pruned_graph.cosines(np.array(x), np.array([v]))[0])
                    found[i] = max(s, found.get(i, -2.0))
            want.setdefault(q, {}).update(found)
    return {q: sorted(((-s, i) for i, s in found.items()))[:k] for q, found in want.items()}


@pytest.mark.parametrize("shard_rows", [60, 10_000])
def test_graph_finds_the_nearest(spark, shard_rows):
    data = rows() + ODD + rows()[:5]
    got = pruned_graph.nearest(clashing(spark.createDataFrame(data, SCHEMA)), F.col("vec_id") % 50 == 0, shard_rows=shard_rows, query_rows=3).collect()
    want, found = brute_nearest(data, 50, 5), {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert {q: len(x) for q, x in found.items()} == {q: len(x) for q, x in want.items() if x}
    assert all(x == sorted(x) for x in found.values())
    assert sum(len(set(found[q]) & set(x)) for q, x in want.items() if x) >= 0.98 * sum(map(len, want.values()))


def test_recall_of_a_beam_narrower_than_the_table(spark):
    data = rows(4_000, 24, 1)
    got = pruned_graph.nearest(spark.createDataFrame(data, SCHEMA), F.col("vec_id") % 50 == 0, shard_rows=2_000).collect()
    want, found = brute_nearest(data, 50, 5), {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(found[q] & {i for _, i in x}) for q, x in want.items()) >= 0.95 * sum(map(len, want.values()))
    assert pruned_graph.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0
    assert pruned_graph.nearest(spark.createDataFrame([(0, [1.0], 1)], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


def test_every_node_is_reached():
    rng = np.random.default_rng(3)
    far = np.repeat(np.eye(12), 60, 0) + 1e-4 * rng.normal(size=(720, 12))  # tight groups, far apart
    graph = pruned_graph.PrunedGraph(pruned_graph.unit(far), degree=4, width=6, relax=1.2)
    known, front = set(), {graph.entry}
    while front:
        known |= front
        front = {int(x) for node in front for x in graph.edges[node] if x >= 0} - known
    assert known == set(range(720))
    assert all(len(set(e[e >= 0].tolist())) == (e >= 0).sum() for e in graph.edges)


def brute_negatives(data, every, k=5, low=80, high=100, scale=256):
    seen = sorted({(i, lab, tuple(int(np.floor(x * scale)) for x in v)) for i, v, lab in fits(data, need_label=True)})
    out = []
    for a, lab, x in seen:
        if a % every == 0:
            score = [(-sum(p * q for p, q in zip(x, y, strict=True)), i, other) for i, other, y in seen if i != a and len(x) == len(y)]
            for s, p, other in sorted(r for r in score if r[2] == lab)[:k]:
                fit = sorted((t, i) for t, i, o in score if o != lab and low * -s <= 100 * -t <= high * -s)
                out += [(a, p, n + 1, i, -s, -t) for n, (t, i) in enumerate(fit[:k])]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"shard_rows": 50, "anchor_rows": 3, "digit_bits": 2}, {"positives": 2, "negatives": 40, "low": 20, "high": 90, "digit_bits": 4, "shard_rows": 90}])
def test_hard_negatives_equal_the_loop(spark, options):
    data = [x for x in rows() + ODD if x[0] != 907]
    data += rows()[:7]
    got = hard_negatives.hard_negatives(clashing(spark.createDataFrame(data, SCHEMA)), F.col("vec_id") % 20 == 0, **options).collect()
    k, n = options.get("positives", 5), options.get("negatives", 5)
    want = [r for r in brute_negatives(data, 20, max(k, n), options.get("low", 80), options.get("high", 100)) if r[2] <= n]
    if k < max(k, n):
        first = brute_positives(data, 20, k)
        want = [r for r in want if (r[0], r[1]) in first]
    assert sorted(map(tuple, got)) == want and want


def brute_positives(data, every, k, scale=256):
    seen = sorted({(i, lab, tuple(int(np.floor(x * scale)) for x in v)) for i, v, lab in fits(data, need_label=True)})
    return {(a, p) for a, lab, x in seen if a % every == 0 for _, p in sorted((-sum(c * d for c, d in zip(x, y, strict=True)), i) for i, other, y in seen if i != a and other == lab and len(x) == len(y))[:k]}


def test_hard_negatives_of_nothing(spark):
    empty = hard_negatives.hard_negatives(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0)
    assert empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and empty.count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0], 1), (1, [1.0, 2.0], 2)], SCHEMA)  # no positive
    assert hard_negatives.hard_negatives(alone, F.col("vec_id") % 20 == 0).count() == 0
    several = spark.createDataFrame([(0, [1.0, 2.0], 1), (0, [2.0, 1.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 2)], SCHEMA)
    got = hard_negatives.hard_negatives(several, F.col("vec_id") % 20 == 0).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 2, 3 * 256**2, 3 * 256**2)] * 2  # each of its vectors is an anchor
