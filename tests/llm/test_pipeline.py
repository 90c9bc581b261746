"""The pipeline's stages on odd rows, and the whole of it on hand-made documents."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("_id", "_again", "_rank", "_n", "_toxicity", "_text", "_row", "spans", "score", "hits", "items", "node", "label", "n_words", "pivot", "key")


def prose(k, n=60):
    return " ".join(f"w{k}x{j}" for j in range(n))


ODD = [(1, None, "en", "s", None), (2, "", "en", None, 0), (3, " \n\t ", None, "s", 4), (4, prose(4), "en", "s", 1), (4, prose(4), "en", "s", 1), (5, prose(5), "en", "s", 1), (6, prose(6) + " " + "long " * 60_000, "en", "s", 1), (None, prose(7), "en", "s", 1)]


@pytest.mark.parametrize("name", [n for n, _ in pipeline.STAGES])
def test_stages_take_odd_rows(spark, name):
    stage, docs = dict(pipeline.STAGES)[name], spark.createDataFrame(ODD, COLUMNS)
    clashing = docs.select("*", *(F.lit("clash").alias(c) for c in CLASHES))
    kept = stage(spark, clashing, SF)
    ids = sorted({r.doc_id for r in kept.select("doc_id").distinct().collect()} - {None})
    assert ids == [1, 2, 3, 4, 5, 6]
    if name != "packing":
        assert kept.columns == clashing.columns and {r._id for r in kept.select("_id").distinct().collect()} == {"clash"}
        assert kept.count() == len(ODD) - (name == "near_copies") * 1
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_one_row_of_each_group_stays_where_ids_repeat(spark):
    a, b, c = prose(1), prose(2), prose(3)
    rows = [(3, a), (5, b), (5, a + " more"), (7, c), (None, c + " more"), (None, "no other text is like this one"), (8, b), (9, None), (9, ""), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], COLUMNS)
    kept = dict(pipeline.STAGES)["near_copies"](spark, docs, SF).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept) == [(False, 3, a), (False, 5, b), (False, 7, c), (False, 9, ""), (True, 0, "no other text is like this one")]


def test_the_whole_pipeline(spark, tmp_path):
    from strandspark.llm import tokens
    from tokenizers import Tokenizer

    item = prose(99, 14)
    rows = [(10, prose(10)), (11, prose(10) + " more"), (12, prose(12)), (13, prose(13) + " " + item), (14, "mail a.b@c.de " + prose(14)), (15, None), (16, prose(16, 3000))]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = pipeline.run(spark, str(tmp_path)).toPandas()
    encode = Tokenizer.from_file(tokens.vocabulary_path()).encode
    kept = {10: prose(10), 12: prose(12), 14: "mail <EMAIL> " + prose(14), 15: "", 16: prose(16, 3000)}
    want = {i: len(encode(t, add_special_tokens=False).ids) + 1 for i, t in kept.items()}
    assert {i: int(g.length.sum()) for i, g in found.groupby("doc_id")} == want
    for _, g in found.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.to_numpy() == np.r_[0, np.cumsum(g.length)][:-1]).all() and g.length.sum() <= 2048
