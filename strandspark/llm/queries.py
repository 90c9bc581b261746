"""The corpus queries: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ball_tree, decontaminate, hard_negatives, jaccard_join, packing, private_data, pruned_graph, quality, substring_dedup, token_alignment, token_files, toxicity, urls
from .common import crc32_of_id, table


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op2_fm_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, sf_dir, "documents"))


def op3_ball_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc32_of_id() % 5 == 0
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_ftrl_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = crc32_of_id() % 4 == 2
    scored = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held)
    return scored.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    found = private_data.find_private(table(spark, sf_dir, "documents"))
    plain = F.filter("spans", lambda s: s["plain"])
    kinds = F.transform(plain, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in private_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(plain), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), F.size(F.filter("spans", lambda s: ~s["plain"])).alias("n_disguised"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_copies(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def op8_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, files = token_files.write_token_files(table(spark, sf_dir, "documents"))
    return token_files.read_token_files(spark, folder, files).drop("ids")


def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(items):
        return F.struct(F.size(items).cast("long").alias("n"), F.sha2(F.array_join(items, ","), 256).alias("sha256"))

    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), describe=digest)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.col("items.n").alias("n_items"), F.col("items.sha256").alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def op11_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pruned_graph.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op12_radix_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_dangling_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_harmonic_packing, op2_fm_substring_dedup, op3_ball_tree_topk, op4_boosted_toxicity, op5_ftrl_quality, op6_private_data, op7_jaccard_join, op8_url_vocabulary, op9_token_files, op10_winnowing, op11_pruned_graph, op12_radix_negatives, op13_dangling_suffix)}
