"""Summaries of stage tables by locus. The reports' words for nothing are NULL before anything is counted, and rows
without a locus are a group of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean

# Categories that the report counts, and biotypes that it takes for long non-coding.
CATEGORIES = {"coding_n": "CODING", "intronic_n": "INTRONIC", "intergenic_n": "INTERGENIC", "ncrna_n": "NONCODING_RNA", "vep_splice_n": "SPLICING"}
LONG_NONCODING = "lncrna|lincrna|antisense|processed_transcript"


def reported(df: DataFrame) -> DataFrame:
    """Text columns with the reports' words for nothing as NULL."""
    return df.select(*(F.when(~F.col(f"`{c}`").isin(*clean.NULL_REPORT), F.col(f"`{c}`")).alias(c) if kind == "string" else F.col(f"`{c}`") for c, kind in df.dtypes))


def credible_sets(df: DataFrame) -> DataFrame:
    """LOCUS_ID, PIP: LOCUS_ID, cs95_n, cs95_max_pip, and how many reach 0.1 and 0.5; text that is no number reaches none."""
    pip = clean.numeric(F.col("PIP"))
    return reported(df).groupBy("LOCUS_ID").agg(F.count("*").alias("cs95_n"), F.max(pip).alias("cs95_max_pip"), F.count_if(pip >= 0.1).alias("cs95_pip_ge_010"), F.count_if(pip >= 0.5).alias("cs95_pip_ge_050"))


def consequences(df: DataFrame) -> DataFrame:
    """LOCUS_ID, FUNCTIONAL_CATEGORY and BIOTYPE or ALL_BIOTYPES, each of which may be absent: counts by category. A row
    without one is not coding; without biotypes lncrna_n is NULL."""
    rows = reported(df)
    category = F.upper(F.coalesce("FUNCTIONAL_CATEGORY", F.lit(""))) if "FUNCTIONAL_CATEGORY" in df.columns else F.lit("")
    kind = next((c for c in ("BIOTYPE", "ALL_BIOTYPES") if c in df.columns), None)
    long = F.count_if(F.lower(F.coalesce(kind, F.lit(""))).rlike(LONG_NONCODING)) if kind else F.lit(None).cast("long")
    counts = [F.count_if(category == v).alias(k) for k, v in CATEGORIES.items()]
    return rows.groupBy("LOCUS_ID").agg(F.count("*").alias("vep_n"), F.count_if(category != "CODING").alias("noncoding_n"), *counts, long.alias("lncrna_n"))


def best_signal(df: DataFrame, kind: str, score: str = "LCLPP_MULTICAUSAL") -> DataFrame:
    """Per locus the row of a QTL_TYPE, in any case, with the greatest score (NULL last), then the first by all columns
    from the left; by aggregation, whatever a locus holds."""
    rows = df.where(F.lower("QTL_TYPE") == kind.lower())
    row = F.struct(*(F.col(c) for c in df.columns))
    rank = F.struct(F.col(score).isNull().alias("none"), (-F.col(score)).alias("falling"), row.alias("row"))
    return rows.groupBy(F.col("LOCUS_ID").alias("_locus")).agg(F.min(rank).alias("first")).select("first.row.*")
