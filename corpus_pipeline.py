"""From documents to packed sequences: five stages, each an operator at work on all that its
predecessor kept.

toxicity drops what the classifier rejects; near_copies keeps the document with the least doc_id of each group
(five-word shingles, similarity 0.8 or more); decontamination drops documents that share ten words with a
benchmark item; private_data writes the kind in place of each identifier; packing lays token ids out in sequences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandspark.llm import decontaminate, jaccard_join, packing, private_data, toxicity
from strandspark.llm.common import crc32_of_id, new_folder, passing, remove_folder, small, stash, table, unused

REJECT_FROM = 0.5


def _others(docs: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c != "doc_id")


def _whole_text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Labels of rows held out by op4's rule train nothing here either."""
    into = unused("_toxicity", *docs.columns)
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"), crc32_of_id() % 5 != 0, keep=_others(docs), into=into)
    return scored.where(F.col(into) < REJECT_FROM).select(*docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows are told apart by id and text, so one document of a group stays even where several have one id: the least
    id, rows without an id last. Of rows that repeat both id and text one stays."""
    key, rank = (unused(c, *docs.columns) for c in ("_key", "_rank"))
    doc_id = F.col("doc_id").cast("long")
    named = F.struct(doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0).cast("long")).alias("id"), F.md5(_whole_text()).alias("md5"))
    found = stash(jaccard_join.near_copies(docs.select(named.alias("doc_id"), "text"), k=5, num=80, den=100), "near-copies")
    least = F.col("doc_id") == F.col("component_id")
    gone = found.where(~least).select(F.col("doc_id").alias(key)).distinct()
    again = found.where(least).groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("n")).where("n > 1").select(key)
    rows = docs.withColumn(key, named).join(gone, key, "left_anti")
    # Rows that repeat both are few.
    again = stash(again, "repeated-rows")
    few = small(again, again.count())
    order = Window.partitionBy(key).orderBy(*(F.col(c) for c in docs.columns))
    several = rows.join(few, key, "left_semi").withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return rows.join(few, key, "left_anti").select(*docs.columns).unionByName(several.select(*docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = unused("_md5", *docs.columns)
    found = stash(decontaminate.contaminated_texts(docs, table(spark, sf_dir, "benchmark")), "contaminated")
    return docs.withColumn(key, F.md5(_whole_text())).join(found.select(F.col("text_md5").alias(key)), key, "left_anti").select(*docs.columns)


def replace_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return private_data.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", keep_one_of_each_group),
    ("decontamination", drop_contaminated),
    ("private_data", replace_private_data),
    ("packing", pack_sequences),
]

#: Trees, links and token ids have no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is written whole; then its predecessor and what it made on the way are removed."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        into = new_folder(spark, name)
        with passing(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(into)
        if before:
            remove_folder(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(into), into
    return docs
