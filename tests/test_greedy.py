"""Choices in rounds against going through all rows one by one, with ties, chains and repeats."""

import random

import pytest
from pyspark.sql import functions as F

from strandspark.operators import greedy


def clump_one_by_one(variants, links, index_p, member_p, window, least_r2):
    near = {}
    at = {(c, i): (pos, p) for c, pos, i, p in variants if p is not None and p <= member_p}
    for c, a, b, r2 in links:
        if r2 is not None and r2 >= least_r2 and (c, a) in at and (c, b) in at and abs(at[c, a][0] - at[c, b][0]) <= window:
            near.setdefault((c, a), set()).add((c, b))
            near.setdefault((c, b), set()).add((c, a))
    free, out = set(at), set()
    for v in sorted(at, key=lambda v: (at[v][1], at[v][0], v[1])):
        if v in free and at[v][1] <= index_p:
            mine = {v} | (near.get(v, set()) & free)
            free -= mine
            out |= {(v[0], v[1], x[1], at[x][1]) for x in mine}
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_clumps(spark, seed):
    rng = random.Random(seed)
    variants = [(c, rng.randrange(400), f"v{k}", rng.choice([1e-9, 1e-9, 1e-8, 1e-7, 1e-3, 0.5, None])) for c in (1, 2) for k in range(60)]
    variants += [(3, 10 * k, f"c{k}", 10.0 ** -(50 - k)) for k in range(12)]  # a chain: each is linked to the next only
    links = [(c, f"v{a}", f"v{b}", rng.random()) for c in (1, 2) for a in range(60) for b in range(60) if rng.random() < 0.08] + [(3, f"c{k}", f"c{k + 1}", 0.9) for k in range(11)] + [(1, "v0", "nowhere", 1.0)]
    options = {"index_p": 1e-7, "member_p": 0.01, "window": 150, "least_r2": 0.2}
    v = spark.createDataFrame(variants, "chrom int, pos long, id string, p double")
    ld = spark.createDataFrame(links, "chrom int, a string, b string, r2 double")
    assert {tuple(r) for r in greedy.clump(v, ld, **options).collect()} == clump_one_by_one(variants, links, **options)
    assert greedy.clump(v.limit(0), ld, **options).count() == 0
    alone = greedy.clump(v, ld.limit(0), **options).collect()
    assert len(alone) == sum(p is not None and p <= 1e-7 for *_, p in variants) and all(r.lead == r.id for r in alone)


@pytest.mark.parametrize("bound", [4_000_000, 40])
def test_clumps_by_place_make_few_pairs(spark, monkeypatch, bound):
    """Links by place are asked for leads alone: 900 variants within reach of 60 others each, several at one place."""
    rng, asked = random.Random(3), []
    monkeypatch.setattr(greedy, "PAIRS", bound)
    variants = [(k % 2, rng.randrange(1500), f"v{k}", rng.choice([1e-9, 1e-9, 1e-8, 1e-3, 0.5, None])) for k in range(900)] + [(0, None, "nowhere", 1e-9), (0, None, "there", 1e-9), (0, None, "weak", 1e-3)]

    def linked(left, right):
        pairs = left.join(right, "chrom").where("abs(l_pos - r_pos) <= 100").withColumn("r2", 1 - F.abs(F.col("l_pos") - F.col("r_pos")) / 100)
        asked.append(pairs.count())
        return pairs

    v = spark.createDataFrame(variants, "chrom int, pos long, id string, p double")
    links = [(c, a, b, 1 - abs(x - y) / 100) for c, x, a, _ in variants for d, y, b, _ in variants if c == d and a != b and None not in (x, y) and abs(x - y) <= 100]
    found = {tuple(r) for r in greedy.clump(v, linked, index_p=1e-7, member_p=0.01, window=90, least_r2=0.2).collect()}
    assert found == clump_one_by_one([x for x in variants if x[1] is not None], links, 1e-7, 0.01, 90, 0.2) | {(0, i, i, 1e-9) for i in ("nowhere", "there")}
    assert asked[-1] < len(links) / 10
    assert greedy.clump(v.limit(0), linked).count() == 0


@pytest.mark.parametrize("bound", [4_000_000, 30])
def test_rounds_do_not_grow_with_a_chain(spark, monkeypatch, bound):
    """90 variants of one p on a row, each linked to the next two: every third leads, whatever stretches they are dealt to."""
    saved, count = greedy._saved, []
    monkeypatch.setattr(greedy, "PAIRS", bound)
    monkeypatch.setattr(greedy, "_saved", lambda df: count.append(1) or saved(df))
    v = spark.createDataFrame([(1, k, k, 1e-9) for k in range(90)], "chrom int, pos long, id long, p double")
    ld = spark.createDataFrame([(1, k, k + d, 0.5) for k in range(90) for d in (1, 2) if k + d < 90], "chrom int, a long, b long, r2 double")
    assert {(r.lead, r.id) for r in greedy.clump(v, ld, window=2).collect()} == {(k - k % 3, k) for k in range(90)}
    assert len(count) < (15 if bound > 30 else 40)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches(spark, seed):
    rng = random.Random(seed)
    pairs = [(k, rng.randrange(12), rng.randrange(12), rng.choice([0.1, 0.5, 0.5, 0.9])) for k in ("s", "t") for _ in range(70)] + [("u", k, k + d, 1 - (2 * k + d) / 50) for k in range(12) for d in (0, 1)]
    pairs += [pairs[0], ("s", None, 1, 0.9), ("s", 1, 1, None)]
    want, used = set(), set()
    for k, a, b, s in sorted({p for p in pairs if None not in p}, key=lambda p: (-p[3], p[1], p[2])):
        if (k, "a", a) not in used and (k, "b", b) not in used:
            used |= {(k, "a", a), (k, "b", b)}
            want.add((k, a, b, s))
    df = spark.createDataFrame(pairs, "k string, a long, b long, score double")
    assert {tuple(r) for r in greedy.greedy_match(df, "k").collect()} == want
    assert greedy.greedy_match(df.limit(0), "k").count() == 0


def plain_clusters(rows, threshold):
    """One by one, in order."""
    out, representatives = {}, {}
    for c, term, _, genes in sorted(rows, key=lambda r: (r[2] is None, r[2] or 0, r[1])):
        mine, best, at = set(genes or ()), 0.0, None
        for k, (_, theirs) in enumerate(representatives.setdefault(c, [])):
            j = len(mine & theirs) / max(1, len(mine | theirs))
            if j >= threshold and j > best:
                best, at = j, k
        if at is None:
            at = len(representatives[c])
            representatives[c].append((term, mine))
        out[c, term] = (at + 1, representatives[c][at][0])
    return out


@pytest.mark.parametrize("threshold", [0.5, 0.7])
def test_clusters_equal_one_by_one(spark, threshold):
    draw = random.Random(int(threshold * 10))
    rows = [(draw.choice(["g", "h", None]), f"t{k}", draw.choice([None, 0.1, 0.2, 0.3, 0.4]), draw.choice([None, []] + [draw.sample(range(8), draw.randint(1, 6)) for _ in range(12)])) for k in range(150)]
    t = spark.createDataFrame(rows, "c string, term string, fdr double, genes array<int>")
    found = {(r.collection, r.term): (r.cluster, r.representative) for r in greedy.redundancy_clusters(t, "c", threshold).collect()}
    assert found == plain_clusters(rows, threshold)


def test_no_terms_and_repeated_terms(spark):
    schema = "c string, term string, fdr double, genes array<int>"
    assert greedy.redundancy_clusters(spark.createDataFrame([], schema), "c").count() == 0
    t = spark.createDataFrame([("g", "x", 0.2, [1]), ("g", "x", 0.1, [1, 2]), ("g", "y", 0.3, [1, 2]), ("g", None, 0.0, [1, 2])], schema)
    assert {(r.term, r.cluster, r.representative) for r in greedy.redundancy_clusters(t, "c").collect()} == {("x", 1, "x"), ("y", 1, "x")}


def test_redundancy_holds_terms_against_representatives_only(spark):
    """300 terms, one gene short of ten each, are all alike: only the first ones and the representative may meet the others."""
    everything = [f"g{k}" for k in range(12)]
    terms = [("c", f"t{k:03}", k / 1000, [g for i, g in enumerate(everything) if i not in (k % 12, k // 12 % 12)]) for k in range(300)]
    df = spark.createDataFrame(terms, "collection string, term string, fdr double, genes array<string>")
    rows = {r.term: r.representative for r in greedy.redundancy_clusters(df, "collection", 0.6).collect()}
    leads = []
    for _, term, _, genes in terms:
        like = [(len(set(genes) & set(g)) / len(set(genes) | set(g)), -i, t) for i, (t, g) in enumerate(leads)]
        best = max((x for x in like if x[0] >= 0.6), default=None)
        if best is None:
            leads.append((term, genes))
        assert rows[term] == (term if best is None else best[2])
    assert len(rows) == 300


def test_no_terms_pass_through_the_driver(spark, monkeypatch):
    """What grows with terms is joined by shuffle, though saved tables are small files; only rows of a stretch each are sent to all tasks."""
    saved, plans = greedy._saved, []
    monkeypatch.setattr(greedy, "_saved", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or saved(df))
    terms = [("c", f"t{k}", k / 100, [f"g{(k * 7 + i * i) % 23}" for i in range(1 + k % 9)]) for k in range(100)]
    out = greedy.redundancy_clusters(spark.createDataFrame(terms, "collection string, term string, fdr double, genes array<string>"), "collection", 0.5)
    sent = [line for plan in [*plans, out._jdf.queryExecution().executedPlan().toString()] for line in plan.splitlines() if "BroadcastHashJoin" in line]
    assert len(plans) > 5 and all("_part" in line for line in sent)
    assert {(r.collection, r.term): (r.cluster, r.representative) for r in out.collect()} == plain_clusters(terms, 0.5)
