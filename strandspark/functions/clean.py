"""Cleaning of scalar values as Columns. Junk becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that stand for a missing value, by kind of column.
NULL_ALLELES = ("", "NAN", "NA", ".", "<NA>")
NULL_TEXT = ("", "nan", "none", ".")
NULL_SUMMARY = ("", "na", "n/a", "nan", "none", "no", "false", "0", "not available", "nr")
NULL_REPORT = ("NA", "NaN", "nan", "None", "")
NULL_TABLE = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
TRUE_WORDS = ("1", "true", "yes", "y", "t")
FALSE_WORDS = ("0", "false", "no", "n", "f")


def numeric(x: Column) -> Column:
    """Double, or NULL for junk, NaN and infinities."""
    v = x.try_cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), v)


def not_null_word(x: Column) -> Column:
    """Text, or NULL where it is a word that tables use for nothing."""
    text = x.cast("string")
    return F.when(~text.isin(*NULL_TABLE), text)


def chromosome(x: Column) -> Column:
    """1..22 with any "chr" in front, else NULL."""
    n = F.regexp_replace(F.lower(F.trim(x.cast("string"))), "^chr", "").try_cast("double").try_cast("int")
    return F.when(n.between(1, 22), n)


def allele(x: Column) -> Column:
    up = F.upper(F.trim(x.cast("string")))
    return F.when(~up.isin(*NULL_ALLELES), up)


def variant_key(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """chr:pos:ref:alt, NULL if any part is."""
    whole = chrom.isNotNull() & pos.isNotNull() & ref.isNotNull() & alt.isNotNull()
    return F.when(whole, F.concat_ws(":", chrom.cast("string"), pos.cast("string"), ref, alt))


_VARIANT = r"^(?:chr)?([0-9XYMT]+)[:_]([0-9]+)[:_]([A-Za-z]+)[:_]([A-Za-z]+)(?:_b3[78])?$"


def parse_variant_key(x: Column) -> Column:
    """struct(chrom, pos, ref, alt) of chr:pos:ref:alt with : or _, or NULL."""
    part = [F.regexp_extract(F.trim(x), _VARIANT, k) for k in (1, 2, 3, 4)]
    return F.when(part[0] != "", F.struct(part[0].alias("chrom"), part[1].try_cast("long").alias("pos"), F.upper(part[2]).alias("ref"), F.upper(part[3]).alias("alt")))


def pair_key(a: Column, b: Column) -> Column:
    """The two values in order, NULL if either is missing."""
    return F.when(a.isNotNull() & b.isNotNull(), F.concat_ws("|", F.least(a, b), F.greatest(a, b)))


def gene_base(x: Column) -> Column:
    """Stable gene identifier without its version; other tokens stay as they are."""
    found = F.regexp_extract(F.upper(x), r"(ENS[GTP][0-9]+)", 1)
    return F.coalesce(F.nullif(found, F.lit("")), x)


def normal_text(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))


def slug(x: Column) -> Column:
    return F.replace(normal_text(x), F.lit(" "), F.lit("_"))


def as_bool(x: Column) -> Column:
    return F.coalesce(F.lower(F.trim(x.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def as_bool_or_null(x: Column) -> Column:
    word = F.lower(F.trim(x.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def first_nonempty(*values: Column, default: Column | None = None) -> Column:
    """The first value that is not a word for nothing."""
    kept = [F.when(~F.lower(F.trim(v.cast("string"))).isin(*NULL_TEXT), F.trim(v.cast("string"))) for v in values]
    return F.coalesce(*kept, default if default is not None else F.lit(""))


def has_full_summary(x: Column) -> Column:
    return F.coalesce(~F.lower(F.trim(x)).isin(*NULL_SUMMARY), F.lit(False))


def sample_size(text: Column) -> Column:
    """Sum of the numbers from 100 on in prose, else the first number, else NULL, as a decimal of 38 digits. A number,
    or a sum, of more digits than that makes it NULL: it is not left out in silence."""
    kind = "decimal(38,0)"
    found = F.transform(F.regexp_extract_all(text, F.lit("[0-9][0-9,]*"), F.lit(0)), lambda t: F.replace(t, F.lit(","), F.lit("")))
    numbers = F.transform(found, lambda t: t.try_cast(kind))
    large = F.filter(numbers, lambda n: n.isNull() | (n >= 100))
    total = F.aggregate(large, F.lit(0).cast(kind), lambda a, n: F.try_add(a, n).cast(kind))
    return F.when(F.size(large) > 0, total).otherwise(F.try_element_at(numbers, F.lit(1)))


def effect_from_odds_ratio(beta: Column, odds: Column) -> Column:
    return F.coalesce(beta, F.when(odds > 0, F.ln(F.when(odds > 0, odds))))


def standard_error(se: Column, lower: Column, upper: Column) -> Column:
    """SE, else from the 95 % bounds of an odds ratio; not positive or not finite is NULL."""
    bound = F.when((lower > 0) & (upper > 0), (F.ln(F.when(upper > 0, upper)) - F.ln(F.when(lower > 0, lower))) / (2 * 1.959963984540054))
    v = numeric(F.coalesce(se, bound))
    return F.when(v > 0, v)


def z_score(z: Column, beta: Column, se: Column) -> Column:
    return F.coalesce(z, F.try_divide(beta, se))


def oriented(z: Column, effect: Column, ref: Column, alt: Column) -> Column:
    """z towards ref: kept if the effect allele is ref, negated if it is alt, else NULL."""
    return F.when(effect == ref, z).when(effect == alt, -z)


def effective_n(cases: Column, controls: Column) -> Column:
    """round(4 / (1/cases + 1/controls)), halves to even."""
    good = (cases > 0) & (controls > 0)
    return F.when(good, F.bround(F.try_divide(F.lit(4.0), F.try_divide(F.lit(1.0), cases) + F.try_divide(F.lit(1.0), controls)))).cast("long")


def bucket_directory(accession: Column) -> Column:
    """Folder of a catalogue accession: thousands, zero padded to the accession's width."""
    n = F.regexp_extract(accession, "([0-9]+)", 1).try_cast("long")
    low = F.floor((n - 1) / 1000) * 1000 + 1
    width = F.greatest(F.length(F.regexp_extract(accession, "([0-9]+)", 1)), F.lit(8))
    pad = lambda v: F.concat(F.lit("GCST"), F.lpad(v.cast("string"), width, F.lit("0")))
    return F.concat_ws("-", pad(low), pad(low + 999))


def format_rank(name: Column) -> Column:
    """Preference among result files; NULL for files that hold no results."""
    low = F.lower(name)
    skip = low.rlike(r"(index|\.log|\.ya?ml|readme|md5)")
    return F.when(skip, F.lit(None).cast("int")).when(low.endswith(".h.tsv.gz"), 1).when(low.endswith(".h.tsv"), 2).when(low.endswith(".tsv.gz"), 3).when(low.endswith(".tsv"), 4)


def tokens_of(x: Column, pattern: str = r"[;,|]") -> Column:
    """Distinct trimmed tokens of a delimited text, words for nothing left out."""
    parts = F.transform(F.split(x, pattern), lambda t: F.trim(t))
    return F.array_distinct(F.filter(parts, lambda t: ~F.lower(t).isin("", "nan", "none", "na", "<na>", ".")))


def term_score(trait: Column, mapped: Column, title: Column, term: str) -> Column:
    """100 exact trait, 95 exact mapped trait, 80/70/40 where trait, mapped trait or title contain
    the term; short terms without blanks must stand apart from letters and digits."""
    low = term.lower()
    if len(low) <= 5 and " " not in low:
        inside = lambda c: F.lower(c).rlike(rf"(?<![a-z0-9])\Q{low}\E(?![a-z0-9])")
    else:
        inside = lambda c: F.contains(F.lower(c), F.lit(low))
    return F.when(F.lower(trait) == low, 100).when(F.lower(mapped) == low, 95).when(inside(trait), 80).when(inside(mapped), 70).when(inside(title), 40).otherwise(0)


def phenotype_match(phenotype: Column, text: Column, stop: tuple[str, ...] = ("disease", "disorder", "syndrome", "with", "type")) -> Column:
    """Either contains the other, or they share min(2, n) of the phenotype's words of four letters or more."""
    a, b = normal_text(phenotype), normal_text(text)
    stops = F.array(*map(F.lit, stop))
    long_words = lambda c: F.array_except(F.array_distinct(F.filter(F.split(c, " "), lambda w: F.length(w) >= 4)), stops)
    need = F.least(F.lit(2), F.size(long_words(a)))
    return F.coalesce((a != "") & (b != "") & (F.contains(b, a) | F.contains(a, b)) | (need > 0) & (F.size(F.array_intersect(long_words(a), long_words(b))) >= need), F.lit(False))


def flatten_json(df: DataFrame, key: str, text: str) -> DataFrame:
    """key, path and value (text) of every leaf of a JSON object, however deep: paths are dotted, the members of a list are
    joined by ; and a JSON null has no value; other texts give no rows. Each level is read once, and rounds end with the
    deepest object."""
    from ..operators.graphs import _saved

    tvf, done = df.sparkSession.tvf, []
    level = _saved(df.select(key, F.lit("").alias("_under"), F.try_parse_json(text).alias("_value")).where(F.schema_of_variant("_value").startswith("OBJECT")))
    while True:
        members = level.lateralJoin(tvf.variant_explode(F.col("_value").outer())).select(key, F.concat(F.col("_under"), F.when(F.col("_under") == "", "").otherwise("."), F.col("key")).alias("_under"), F.col("value").alias("_value"))
        members = _saved(members.withColumn("_kind", F.schema_of_variant("_value")))
        done.append(members.where(~F.col("_kind").startswith("OBJECT")))
        level = members.where(F.col("_kind").startswith("OBJECT")).drop("_kind")
        if level.isEmpty():
            break
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    value = F.when(F.col("_kind").startswith("ARRAY"), F.array_join(F.try_variant_get("_value", "$", "array<string>"), ";")).otherwise(F.try_variant_get("_value", "$", "string"))
    return every.select(key, F.col("_under").alias("path"), value.alias("value"))


def json_first(text: Column, *paths: str) -> Column:
    """The text at the first of several paths that has one."""
    value = F.try_parse_json(text)
    return F.coalesce(*(F.try_variant_get(value, p, "string") for p in paths))
