"""Classifiers on held-out labels, top-k against brute force, the URL filter and the pipeline's stages."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandspark.llm import ball_tree, quality, queries, toxicity, urls

SF = "/root/testdata/sf0.01"


def area(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    n = label.sum()
    return (rank[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


@pytest.mark.parametrize(("query", "label", "mod", "rest", "least"), [("op4_boosted_toxicity", "toxic", 5, 0, 0.97), ("op5_ftrl_quality", "quality", 4, 2, 0.98)])
def test_held_out_labels(spark, query, label, mod, rest, least):
    found = queries.QUERIES[query](spark, SF).toPandas()
    assert found.score.between(0, 1).all() and len(found) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % mod == rest for i in found.doc_id]).all()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")[label]
    held = found[found.held_out & found.doc_id.isin(labels.index)]
    reached = area(held.score.to_numpy(), labels[held.doc_id].to_numpy())
    assert reached >= least, reached


def test_scores_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "you idiot, you pathetic moron"), (4, "fine words"), (4, "fine words"), (None, "no id"), (5, "w " * 40_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 1), (9, 1, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    for module in (toxicity, quality):
        found = module.score(docs, labels, F.lit(True)).collect()
        assert len(found) == 7 and all(0 <= r.score <= 1 for r in found)
        assert module.score(docs, labels.limit(0), F.lit(True)).count() == 7 and module.score(docs.limit(0), labels, F.lit(True)).count() == 0


def test_trees_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = toxicity.Model(x[:3000], y[:3000], np.arange(3000) % 4)
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.95
    assert (np.diff(model.shares) >= 0).all()


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(400, 8)).round(2)
    v[50:60] = v[0]  # ties
    rows = [(i, x.tolist()) for i, x in enumerate(v)] + [(900, None), (1000, [1.0, None] + [0.0] * 6), (1100, [float("nan")] * 8), (1200, [1.0, 2.0]), (20, v[20].tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    whole = np.floor(1024 * v)
    for shard in (16_384, 60):
        found = {}
        for r in ball_tree.top_k(table, F.col("vec_id") % 10 == 0, shard_rows=shard, query_rows=15).collect():
            found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
        expected = {}
        for q in range(0, 400, 10):
            s = whole @ whole[q]
            order = [i for i in np.lexsort((np.arange(400), -s)) if i != q][:10]
            expected[q] = [(k + 1, int(i), int(s[i])) for k, i in enumerate(order)]
        assert {q: sorted(x) for q, x in found.items()} == expected
    assert ball_tree.top_k(table.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_top_k_counts_an_id_of_many_vectors_once(spark):
    rng = np.random.default_rng(2)
    ids, v = np.r_[np.arange(60), np.full(300, 7), np.full(5, 20)], rng.normal(size=(365, 6)).round(2)
    v[60:360] += 3  # the id with most rows has the highest scores of all
    table = spark.createDataFrame([(int(i), x.tolist()) for i, x in zip(ids, v, strict=True)], "vec_id long, embedding array<double>")
    whole = np.floor(1024 * v)
    expected = {}
    for q in range(0, 60, 10):
        s = (whole @ whole[ids == q].T).max(1)
        best = {int(i): int(s[ids == i].max()) for i in np.unique(ids) if i != q}
        expected[q] = [(i, best[i]) for i in sorted(best, key=lambda i: (-best[i], i))[:10]]
    for shard in (16_384, 30):
        found = {}
        for r in ball_tree.top_k(table, F.col("vec_id") % 10 == 0, shard_rows=shard, query_rows=4).orderBy("query_id", "rank").collect():
            found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert found == expected


@pytest.mark.parametrize(("url", "host", "path", "rule", "verdict"), [
    ("https://www.example.net/en/1?x", "www.example.net", "/en/1", "example.net/en/", "allow"), ("http://A.NET/spam", "a.net", "/spam", "net/", "block"),
    ("http://x.net", "x.net", "", None, "allow"), ("http://anet/", "anet", "/", None, "allow"), ("http://example.com/de/1#t", "example.com", "/de/1", "example.com/de/", "block"),
    ("http://a.org/spam-1", "a.org", "/spam-1", None, "block"), ("http://a.org/spammer", "a.org", "/spammer", None, "allow"), ("http://a.org/free-BONUS", "a.org", "/free-BONUS", None, "block"),
    ("http://a.org/free-free", "a.org", "/free-free", None, "allow"), ("http://a.org/hot-deal", "a.org", "/hot-deal", None, "allow"),
    ("http://a.org/hot-deal-free", "a.org", "/hot-deal-free", None, "block"), ("http://a.org/?win=" + "x" * 100_000 + "&free+bonus", "a.org", "/", None, "block"), (None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("", "", "", None, "allow"),
])
def test_urls(spark, url, host, path, rule, verdict):
    row = urls.judge(spark.createDataFrame([(1, url, "clash")], "page_id long, url string, host string")).first()
    assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)


def test_urls_of_repeated_rows_empty_tables_and_own_vocabularies(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x", "k"), (1, "http://a.org/x", "k"), (None, "http://b.org/y-z", "k")], "page_id long, url string, host string")
    assert sorted((r.page_id or 0, r.verdict) for r in urls.judge(pages).collect()) == [(0, "allow"), (1, "allow"), (1, "allow")]
    own = urls.judge(pages, strict=("x",), soft=(("y", 3), ("z", 1)), soft_limit=4).collect()
    assert sorted((r.page_id or 0, r.verdict, r.soft_weight) for r in own) == [(0, "block", 4), (1, "block", 0), (1, "block", 0)]
    assert {r.verdict for r in urls.judge(pages, strict=(), soft=(("y", 9),)).collect()} == {"allow"}  # one soft term never rejects
    assert urls.judge(pages.limit(0)).count() == 0 and {r.n_soft for r in urls.judge(pages, strict=(), soft=()).collect()} == {0}


@pytest.mark.parametrize("name", sorted(__import__("strandspark.llm.oracles", fromlist=["ORACLES"]).ORACLES))
def test_same_rows_as_sql(spark, name):
    import os

    import duckdb

    from strandspark.llm import oracles

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{sf}/{f}')")
    cursor = con.execute(oracles.ORACLES[name])
    names = [d[0] for d in cursor.description]
    found = sorted(tuple(map(str, r)) for r in queries.QUERIES[name](spark, sf).select(*names).collect())
    assert found == sorted(tuple(map(str, r)) for r in cursor.fetchall())


def test_pipeline_stages_keep_what_is_clean(spark):
    import corpus_pipeline as pipeline

    text = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").first().text
    rows = [(i, text(i), "en", "s", 0) for i in range(5)] + [(10, text(1), "en", "s", 0), (11, text(2) + " extra", "en", "s", 0), (12, text(12) + " " + bench, "en", "s", 0), (13, text(13) + " a.b@c.de", "en", "s", 0), (14, None, "en", "s", 0), (3, text(3), "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(pipeline.STAGES)
    one = stages["near_copies"](spark, docs, SF)
    assert sorted(r.doc_id for r in one.collect()) == [0, 1, 2, 3, 4, 12, 13, 14] and one.columns == docs.columns
    clean = stages["decontamination"](spark, one, "/root/testdata/sf0.001")
    assert sorted(r.doc_id for r in clean.collect()) == [0, 1, 2, 3, 4, 13, 14] and clean.columns == docs.columns
    safe = stages["private_data"](spark, clean, SF)
    assert {r.doc_id: r.text for r in safe.collect()}[13].endswith("<EMAIL>") and safe.columns == docs.columns
    packed = stages["packing"](spark, safe, SF).toPandas()
    assert set(packed.doc_id) == {0, 1, 2, 3, 4, 13, 14}
