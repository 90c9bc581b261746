"""Running values over stretches: one key that holds most rows lies on many of them."""

import random

import pytest
from pyspark.sql import functions as F

from strandspark.operators import intervals, scans


@pytest.fixture
def many_stretches(spark):
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "9"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(seed, n=300):
    rng = random.Random(seed)
    return [(rng.choice(["big"] * 8 + ["s1", "s2", None]), i, rng.choice([None, *range(0, 40)]), rng.randrange(400)) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_ranks_of_all_kinds(many_stretches, seed):
    data = rows(seed)
    df = many_stretches.createDataFrame(data, "k string, id long, v long, s long")
    parts = scans.stretches(df, ["k"], F.col("id"))
    assert parts.where("k = 'big'").select("_part").distinct().count() > 3  # the premise of all this
    by = {}
    for k, i, v, _ in data:
        by.setdefault(k, []).append((v, i))
    values = {k: sorted(v for v, _ in x if v is not None) for k, x in by.items()}
    assert {r.id: r.n for r in scans.row_numbers(df, ["k"], [F.col("v").desc_nulls_last(), F.col("id")], "n").collect()} == {i: n + 1 for x in by.values() for n, (_, i) in enumerate(sorted(x, key=lambda p: (p[0] is None, -(p[0] or 0), p[1])))}
    every = sorted((v is not None, v, i) for _, i, v, _ in data if v is not None)
    assert {r.id: r.n for r in scans.row_numbers(df.where("v is not null"), [], [F.col("v"), F.col("id")], "n").collect()} == {i: n + 1 for n, (_, _, i) in enumerate(every)}
    ranks = {i: None if v is None else sum(x < v for x in values[k]) + 1 for k, i, v, _ in data}
    assert {r.id: r.n for r in scans.min_ranks(df, ["k"], "v", "n").collect()} == ranks
    share = {i: None if v is None else (ranks[i] + (values[k].count(v) - 1) / 2) / len(values[k]) for k, i, v, _ in data}
    assert {r.id: r.n for r in scans.percentile_ranks(df, ["k"], "v", "n", lone_is_zero=False).collect()} == share
    lone = many_stretches.createDataFrame([("a", 1, 5), ("b", 2, None), ("c", 3, 1), ("c", 4, 1), ("c", 5, None)], "k string, id long, v long")
    assert {r.id: r.n for r in scans.percentile_ranks(lone, ["k"], "v", "n").collect()} == {1: 0.0, 2: 0.0, 3: 0.75, 4: 0.75, 5: None}
    assert {r.id: r.n for r in scans.percentile_ranks(lone, [], "v", "n").collect()} == {1: 1.0, 2: None, 3: 0.5, 4: 0.5, 5: None}


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_adjusted_p_values(many_stretches, keys):
    data = [(k, i, None if v is None else (v + 1) / 50) for k, i, v, _ in rows(3)]
    got = {r.id: r.q for r in scans.bh_fdr(many_stretches.createDataFrame(data, "k string, id long, p double"), "p", "q", keys).collect()}
    groups = {}
    for k, i, p in data:
        groups.setdefault(k if keys else 0, []).append((p, i))
    for group in groups.values():
        known, least = sorted(x for x in group if x[0] is not None), 1.0
        for rank in range(len(known), 0, -1):
            p, i = known[rank - 1]
            least = min(least, p * len(known) / rank)
            assert abs(got[i] - least) < 1e-12
        assert all(got[i] is None for p, i in group if p is None)


def test_islands_and_nearest_across_stretches(many_stretches):
    rng = random.Random(4)
    data = [(rng.choice(["big"] * 8 + ["s", None]), i, s, s + rng.choice([1, 2, 3, 400 if i == 7 else 4])) for i in range(300) for s in [rng.randrange(900)]]
    df = many_stretches.createDataFrame(data, "k string, id long, s long, e long")
    want, state = {}, {}
    for k, i, s, e in sorted(data, key=lambda r: (str(r[0]), r[2], r[3])):
        n, reach = state.get(k, (0, -1))
        n, reach = (n + 1, e) if n == 0 or s > reach else (n, max(reach, e))
        state[k], want[i] = (n, reach), n
    assert {r.id: r.island for r in intervals.islands(df, ["k"], "s", "e").collect()} == want
    others = [(k, p) for k, _, p, _ in data[:9]]
    found = intervals.nearest(df, many_stretches.createDataFrame(others, "k string, o long"), ["k"], "s", "o").collect()
    for r in found:
        near = sorted((abs(r.s - o), o) for k, o in others if k == r.k)
        assert (r.nearest, r.distance) == ((near[0][1], near[0][0]) if near else (None, None)), r
    assert len(found) == len(data) and intervals.islands(df.limit(0), ["k"], "s", "e").count() == 0
