"""Tables that one stage of the evidence chain hands to the next, as text with a header: required columns, types, rows
that count, and one row a key. A column that a stage may lack is added as NULL; columns it doesn't know stay as they are."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean

KINDS = {
    "text": lambda x: clean.not_null_word(x),
    "chromosome": lambda x: clean.chromosome(x),
    "position": lambda x: clean.numeric(x).cast("long"),
    "allele": lambda x: F.nullif(F.upper(F.trim(clean.not_null_word(x))), F.lit("")),
    "number": lambda x: clean.numeric(x),
    "flag": lambda x: clean.as_bool(x),
    "gene": lambda x: clean.gene_base(F.nullif(F.trim(clean.not_null_word(x)), F.lit(""))),
}


@dataclass(frozen=True)
class Stage:
    """columns: kind by name; required: an error if absent; whole: rows with NULL in one of them go; key: one row of
    each, the first by order (a name, or (name, "desc"); NULL last), then by all columns from the left."""

    columns: dict[str, str]
    required: tuple[str, ...]
    whole: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    order: tuple = field(default=())


_VARIANT = {"LOCUS_ID": "text", "CHR": "chromosome", "REFERENCE_POS": "position", "REFERENCE_REF": "allele", "REFERENCE_ALT": "allele", "PIP": "number"}
_PLACE = ("LOCUS_ID", "CHR", "REFERENCE_POS", "REFERENCE_REF", "REFERENCE_ALT")
_BY_LOCUS = ("LOCUS_ID", ("PIP", "desc"))

FINE_MAPPED = Stage(_VARIANT, (*_PLACE, "PIP"), (*_PLACE, "PIP"))
ANNOTATED = Stage({"VEP_ID": "text"} | _VARIANT, ("VEP_ID", *_PLACE, "PIP"), ("VEP_ID", *_PLACE), ("VEP_ID",), _BY_LOCUS)
WITH_EXPRESSION = Stage({"VEP_ID": "text"} | _VARIANT, ("VEP_ID", *_PLACE, "PIP"), ("VEP_ID", *_PLACE, "PIP"), ("VEP_ID",), _BY_LOCUS)
INTERPRETED = Stage(_VARIANT | {"IN_95_CREDIBLE_SET": "flag"}, (*_PLACE, "PIP"))
COLOCALISED = Stage({"LOCUS_ID": "text", "QTL_TYPE": "text", "QTL_GENE": "gene", "QTL_PHENOTYPE": "gene", "LCLPP_MULTICAUSAL": "number"}, ("LOCUS_ID",))
LOCUS_GENES = Stage({"STUDY_ACCESSION": "text", "LOCUS_ID": "text", "EFFECTOR_GENE_ID": "gene", "EFFECTOR_GENE_SYMBOL": "text", "BEST_H4": "number"}, ("STUDY_ACCESSION", "LOCUS_ID", "EFFECTOR_GENE_ID", "BEST_H4"))


def _rank(order: Sequence) -> list[Column]:
    out = []
    for o in order:
        name, falling = (o[0], True) if isinstance(o, tuple) else (o, False)
        out += [F.col(name).isNull(), -F.col(name) if falling else F.col(name)]
    return out


def one_of_each(df: DataFrame, key: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of each key by order, then by all columns from the left; by aggregation, so that a key of many rows
    is made small before it travels. Columns must be of kinds that can be ordered."""
    row = F.struct(*(F.col(c) for c in df.columns))
    rank = F.struct(*(x.alias(f"_{k}") for k, x in enumerate(_rank(order))), row.alias("_row"))
    groups = [F.col(c).alias(f"_key{k}") for k, c in enumerate(key)]
    return df.groupBy(*groups).agg(F.min(rank).alias("_first")).select("_first._row.*")


def load(df: DataFrame, stage: Stage) -> DataFrame:
    """df as the stage's table. Names are matched in any case and written as the stage has them. A table without rows
    gives none."""
    have = {c.lower(): c for c in df.columns}
    missing = [c for c in stage.required if c.lower() not in have]
    if missing:
        raise ValueError(f"missing columns {missing}")
    known = {c.lower() for c in stage.columns}
    typed = [KINDS[k](F.col(f"`{have[c.lower()]}`") if c.lower() in have else F.lit(None).cast("string")).alias(c) for c, k in stage.columns.items()]
    out = df.select(*typed, *(F.col(f"`{c}`") for c in df.columns if c.lower() not in known))
    for c in stage.whole:
        out = out.where(F.col(c).isNotNull())
    return one_of_each(out, stage.key, stage.order) if stage.key else out


def with_key(df: DataFrame) -> DataFrame:
    """VARIANT_KEY of the reference place and alleles."""
    return df.withColumn("VARIANT_KEY", clean.variant_key(*(F.col(c) for c in _PLACE[1:])))


def splice_eligible(df: DataFrame) -> DataFrame:
    """VALID_DNA_ALLELES, and of these SPLICEAI_ALLELE_ELIGIBLE: one side is a single base."""
    ref, alt = F.col("REFERENCE_REF"), F.col("REFERENCE_ALT")
    valid = F.coalesce(ref.rlike("^[ACGT]+$") & alt.rlike("^[ACGT]+$"), F.lit(False))
    return df.withColumn("VALID_DNA_ALLELES", valid).withColumn("SPLICEAI_ALLELE_ELIGIBLE", F.col("VALID_DNA_ALLELES") & ((F.length(ref) == 1) | (F.length(alt) == 1)))


def prioritised(df: DataFrame, least_pip: float) -> DataFrame:
    """Variants of FINE_MAPPED, all of them, with why each would be chosen: it is in a credible set (IN_95_CREDIBLE_SET
    or, without that column, a named CREDIBLE_SET), has least_pip, or leads its locus (the first place of equals); and one
    row of each allele, that of the greatest PIP."""
    if "IN_95_CREDIBLE_SET" in df.columns:
        credible = clean.as_bool(F.col("IN_95_CREDIBLE_SET"))
    elif "CREDIBLE_SET" in df.columns:
        credible = ~F.lower(F.trim(F.coalesce(F.col("CREDIBLE_SET"), F.lit("")))).isin(*clean.NULL_TEXT, "na")
    else:
        credible = F.lit(False)
    place = F.struct(*_PLACE[1:])
    tops = df.groupBy("LOCUS_ID").agg(F.min_by(place, F.struct(-F.col("PIP"), place)).alias("_top"))
    out = df.join(tops, "LOCUS_ID").select(*df.columns, credible.alias("SELECTED_CREDIBLE_SET"), (F.col("PIP") >= least_pip).alias("SELECTED_PIP_THRESHOLD"), (place == F.col("_top")).alias("SELECTED_TOP_LOCUS"))
    for name, bound in (("PIP_GE_0_01", 0.01), ("PIP_GE_0_10", 0.1), ("PIP_GE_0_50", 0.5), ("PIP_GE_0_90", 0.9)):
        out = out.withColumn(name, F.col("PIP") >= bound)
    why = F.col("SELECTED_CREDIBLE_SET") | F.col("SELECTED_PIP_THRESHOLD") | F.col("SELECTED_TOP_LOCUS")
    return one_of_each(out.withColumn("PRIORITIZED", why), _PLACE[1:], (("PIP", "desc"),))


def effective_gene(df: DataFrame) -> DataFrame:
    """COLOCALISED with QTL_GENE_EFFECTIVE: the gene, else what the phenotype names."""
    return df.withColumn("QTL_GENE_EFFECTIVE", F.coalesce("QTL_GENE", "QTL_PHENOTYPE"))
