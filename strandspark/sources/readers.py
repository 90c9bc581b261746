"""Readers of the text and columnar formats of the domain, as DataFrames with stable schemas.

Text comes in as lines and is split in the JVM; a gzip file is one partition, so readers
take `partitions` to spread its lines right after the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean
from ..operators import grouping, intervals


def tsv(spark: SparkSession, path, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """The named columns of tab-separated files with a header, all as strings."""
    df = spark.read.option("sep", "\t").option("header", True).option("inferSchema", False).csv(path)
    df = df.select(*(F.col(f"`{c}`") for c in columns))
    return df.repartition(partitions) if partitions else df


def bind(df: DataFrame, roles: dict[str, Sequence[str]], required: Sequence[str] = (), kinds: dict[str, str] | None = None) -> DataFrame:
    """One column per role: the first of its candidate names that df has, in any case; NULL where
    none is there, an error for required roles."""
    have = {c.lower(): c for c in reversed(df.columns)}
    out = []
    for role, names in roles.items():
        found = next((have[n.lower()] for n in names if n.lower() in have), None)
        kind = (kinds or {}).get(role, "string")
        if found is None and role in required:
            raise ValueError(f"none of {list(names)} is a column ({role})")
        out.append((F.lit(None).cast(kind) if found is None else F.col(f"`{found}`").try_cast(kind)).alias(role))
    return df.select(*out)


def _table_after(lines: DataFrame, mark: str, columns: Sequence[str], sep: str = "\t") -> DataFrame:
    """Rows of the lines that don't begin with mark, split to the given columns; short lines are dropped."""
    parts = F.split(F.col("value"), sep, -1)
    rows = lines.where(~F.col("value").startswith(mark) & (F.length("value") > 0)).select(parts.alias("p")).where(F.size("p") >= len(columns))
    return rows.select(*(F.col("p")[k].alias(c) for k, c in enumerate(columns)))


def header_of(spark: SparkSession, path, mark: str) -> list[str]:
    """Names on the line that begins with mark, without its sign."""
    line = spark.read.text(path).where(F.col("value").startswith(mark)).first()
    if line is None:
        raise ValueError(f"no line begins with {mark}")
    return line[0].lstrip("#").split("\t")


def vcf(spark: SparkSession, path, partitions: int | None = None, split_alternatives: bool = False) -> DataFrame:
    """chrom, pos, id, ref, alt, info of VCF or variant tables; malformed lines are skipped. With
    split_alternatives each alternative allele has its row."""
    names = header_of(spark, path, "#CHROM")
    lines = spark.read.text(path)
    df = _table_after(lines.repartition(partitions) if partitions else lines, "#", names)
    info = F.col("INFO") if "INFO" in names else F.lit(None).cast("string")
    alt = F.explode(F.split("ALT", ",")) if split_alternatives else F.col("ALT")
    df = df.select(F.col("CHROM").alias("chrom"), F.col("POS").try_cast("long").alias("pos"), F.col("ID").alias("id"), F.upper("REF").alias("ref"), alt.alias("alt"), info.alias("info"))
    return df.withColumn("alt", F.upper("alt")).where("pos is not null and ref <> ''")


def annotation_tab(spark: SparkSession, path) -> DataFrame:
    """Tab output of a variant annotator, all strings, its key column named variant_id."""
    names = header_of(spark, path, "#Uploaded_variation")
    return _table_after(spark.read.text(path), "#", names).withColumnRenamed("Uploaded_variation", "variant_id")


# Order of the four scores and offsets in a splice prediction.
SPLICE_EVENTS = ("ACCEPTOR_GAIN", "ACCEPTOR_LOSS", "DONOR_GAIN", "DONOR_LOSS")


def splice_scores(df: DataFrame, info: str = "info", key: str = "SpliceAI") -> DataFrame:
    """df with allele, gene, max_score, event and offset of each prediction of ten fields; the first of
    equal scores names the event."""
    of = F.try_element_at(F.str_to_map(F.col(info), F.lit(";"), F.lit("=")), F.lit(key))
    tuples = F.filter(F.transform(F.split(of, ","), lambda x: F.split(x, r"\|")), lambda p: F.size(p) == 10)
    rows = df.withColumn("_p", F.explode(tuples))
    scored = F.array(*(F.struct(clean.numeric(F.col("_p")[2 + k]).alias("s"), F.lit(-k).alias("o"), F.lit(e).alias("event"), F.col("_p")[6 + k].try_cast("int").alias("offset")) for k, e in enumerate(SPLICE_EVENTS)))
    best = F.array_max(F.filter(scored, lambda x: x["s"].isNotNull()))
    return rows.withColumn("_b", best).select(*df.columns, F.col("_p")[0].alias("allele"), F.col("_p")[1].alias("gene"), F.col("_b.s").alias("max_score"), F.col("_b.event").alias("event"), F.col("_b.offset").alias("offset"))


def splice_csv(spark: SparkSession, path) -> DataFrame:
    """chrom, pos, ref, alt, variant_id, gene, gain, gain_pos, loss, loss_pos, event of a CSV whose sixth
    field holds commas: gene|pos:gain|pos:loss|..., several by comma."""
    lines = spark.read.text(path).where(~F.col("value").startswith("CHROM"))
    p = lines.select(F.split("value", ",", 6).alias("p")).where(F.size("p") == 6)
    rows = p.select(F.col("p")[0].alias("chrom"), F.col("p")[1].try_cast("long").alias("pos"), F.col("p")[2].alias("ref"), F.col("p")[3].alias("alt"), F.col("p")[4].alias("variant_id"), F.explode(F.split(F.col("p")[5], ",")).alias("x"))
    rows = rows.withColumn("x", F.split("x", r"\|")).where(F.size("x") >= 3)
    at = lambda k, j: F.try_element_at(F.split(F.col("x")[k], ":"), F.lit(j))
    rows = rows.select("chrom", "pos", "ref", "alt", "variant_id", F.col("x")[0].alias("gene"), clean.numeric(at(1, 2)).alias("gain"), at(1, 1).try_cast("int").alias("gain_pos"), clean.numeric(at(2, 2)).alias("loss"), at(2, 1).try_cast("int").alias("loss_pos"))
    return rows.withColumn("event", F.when(F.abs("gain") >= F.abs("loss"), "GAIN").otherwise("LOSS"))


def gtf(spark: SparkSession, path, features: Sequence[str] = ("gene", "exon", "CDS", "UTR")) -> DataFrame:
    """chrom (1..22), feature, start, end, strand, gene_id, gene_name, gene_type of the given features."""
    names = ("seqname", "source", "feature", "start", "end", "score", "strand", "frame", "attributes")
    df = _table_after(spark.read.text(path), "#", names).where(F.col("feature").isin(*features))
    get = lambda k: F.nullif(F.regexp_extract("attributes", rf'{k} "([^"]*)"', 1), F.lit(""))
    return df.select(clean.chromosome(F.col("seqname")).alias("chrom"), "feature", F.col("start").try_cast("long").alias("start"), F.col("end").try_cast("long").alias("end"), "strand", clean.gene_base(get("gene_id")).alias("gene_id"), get("gene_name").alias("gene_name"), F.coalesce(get("gene_type"), get("gene_biotype")).alias("gene_type")).where("chrom is not null")


def gmt(spark: SparkSession, path) -> DataFrame:
    """term, description, gene: ragged lines of three fields or more, genes distinct."""
    p = spark.read.text(path).select(F.split("value", "\t").alias("p")).where(F.size("p") >= 3)
    genes = F.explode(F.array_distinct(F.filter(F.transform(F.slice("p", F.lit(3), F.size("p")), lambda g: F.upper(F.trim(g))), lambda g: g != "")))
    return p.select(F.col("p")[0].alias("term"), F.col("p")[1].alias("description"), genes.alias("gene"))


def json_documents(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """One JSON object per file with state: OK, or CORRUPT where it doesn't parse; NaN and infinities become NULL."""
    whole = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    df = spark.read.schema(whole).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("allowNonNumericNumbers", True).json(path)
    finite = {f.name: clean.numeric(F.col(f.name)) for f in schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(finite).withColumn("source_file", F.input_file_name()).withColumn("state", F.when(F.col("_corrupt").isNotNull(), "CORRUPT").otherwise("OK")).drop("_corrupt")


def parquet_by_keys(spark: SparkSession, path, column: str, keys: DataFrame) -> DataFrame:
    """Shards with their schemas united, rows of the wanted keys (a semi-join, never a list of literals)."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    return df.join(keys.select(F.col(keys.columns[0]).cast("string").alias("_k")), df[column].cast("string") == F.col("_k"), "left_semi")


def parquet_health(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, state (READABLE, CORRUPT_OR_TRUNCATED) and rows of each shard, so that lost shards are
    not taken for absent evidence. Paths are a listing; each shard is one task, read by footer."""

    def run(batches):
        import pyarrow as pa
        import pyarrow.fs
        import pyarrow.parquet as pq

        for batch in batches:
            out = []
            for path in batch.column("path").to_pylist():
                try:
                    store, name = pyarrow.fs.FileSystem.from_uri(path)
                    out.append((path, "READABLE", pq.read_metadata(name, filesystem=store).num_rows))
                except (OSError, pa.ArrowException):
                    out.append((path, "CORRUPT_OR_TRUNCATED", None))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))], ["path", "state", "n_rows"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return listed.mapInArrow(run, "path string, state string, n_rows long")


def files_with_names(spark: SparkSession, path: str, suffixes: Sequence[str], glob: str = "*") -> DataFrame:
    """Lines of files under path with tissue: the file's name less a known suffix."""
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    tissue = name
    for s in suffixes:
        tissue = F.regexp_replace(tissue, rf"\Q{s}\E$", "")
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path).withColumn("file", name).withColumn("tissue", tissue)


def allele_frequencies(spark: SparkSession, path) -> DataFrame:
    """id and maf of whitespace-separated frequency tables; of a list the first frequency counts."""
    p = F.split(F.trim(F.col("value")), r"\s+")
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(p.alias("p")).where(F.size("p") >= 5)
    af = clean.numeric(F.element_at(F.split(F.col("p")[4], ","), 1))
    return rows.select(F.col("p")[1].alias("id"), F.least(af, 1 - af).alias("maf")).where("maf is not null")


def last_numbers(spark: SparkSession, path, pattern: str) -> DataFrame:
    """file and the groups of the last match of pattern in each (small) log file."""
    found = F.regexp_extract_all("value", F.lit(f"({pattern})"), F.lit(1))
    last = F.try_element_at(found, F.lit(-1))
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), last.alias("last"))


def manifest(df: DataFrame, names: dict[str, Sequence[str]], types: dict[str, str], keep: Column | None = None) -> DataFrame:
    """Dataset descriptors with canonical names; method mapped to a type (unmapped rows dropped), paths not empty."""
    out = bind(df, names)
    kind = F.create_map(*(F.lit(x) for pair in types.items() for x in pair))[F.lower("method")]
    out = out.withColumn("qtl_type", kind).where(F.col("qtl_type").isNotNull() & (F.coalesce(F.trim("path"), F.lit("")) != ""))
    return out.where(keep) if keep is not None else out


def registry(spark: SparkSession, rows: Sequence[dict]) -> DataFrame:
    """One canonical table of the files a small registry describes: each row has path, format and a map
    from role to column."""
    parts = []
    for r in rows:
        reader = spark.read.format(r["format"])
        df = (reader.option("sep", r.get("sep", "\t")).option("header", True) if r["format"] == "csv" else reader).load(r["path"])
        parts.append(bind(df, {role: [name] for role, name in r["columns"].items()}).withColumn("dataset", F.lit(r["dataset"])))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def pages_of(df: DataFrame, rows: str) -> DataFrame:
    """Rows of landed API pages (one JSON page per row or file) with an array of objects under rows."""
    return df.select(F.inline_outer(F.col(rows)))


#: Chromosomes whose hulls a scan of regions names one by one.
MOST_HULLS = 100


def regions(spark: SparkSession, path: str, wanted: DataFrame, width: int = 100_000) -> DataFrame:
    """Rows of what write_by_position wrote that lie in one of many regions (chrom, start, end, and any others of their own;
    both ends included), with the region's columns. Only folders of the regions' chromosomes are listed, and only stretches of
    their hulls are read; more than MOST_HULLS chromosomes share one hull."""
    hulls = wanted.where("chrom IS NOT NULL").groupBy("chrom").agg(F.min("start").alias("low"), F.max("end").alias("high"))
    ends = hulls.agg(F.count("*"), F.min("low"), F.max("high")).first()
    rows = spark.read.parquet(path)
    near = rows.where(F.col("pos").between(ends[1], ends[2]) if ends[0] else F.lit(False))
    if 0 < ends[0] <= MOST_HULLS:
        within = F.lit(False)
        for h in hulls.collect():
            within = within | ((F.col("chrom") == h.chrom) & F.col("pos").between(h.low, h.high))
        near = near.where(within)
    return intervals.points_in(near, wanted, ["chrom"], "pos", "start", "end", width)


def best_pairs(summaries: DataFrame, sensitivity: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key of summaries (keys, hit1, hit2, PP.H0.abf to PP.H4.abf, as text) the pair of signals with the greatest finite
    H4, the first of equal ones by hits: n_signal_pairs, hit1, hit2, h0 to h4 and, from sensitivity (keys, hit1, hit2,
    PP.H4.abf, PRIOR_SET), the H4 of that very pair under each prior. A key without a finite H4 has NULLs."""
    number = lambda c: clean.numeric(F.col(f"`{c}`"))
    h = [number(f"PP.H{k}.abf").alias(f"h{k}") for k in range(5)]
    n = summaries.count()
    rows = grouping.spread(summaries.select(*keys, "hit1", "hit2", *h), keys, n)
    best = F.min_by(F.struct("hit1", "hit2", *(f"h{k}" for k in range(5))), F.when(F.col("h4").isNotNull(), F.struct(-F.col("h4"), "hit1", "hit2")))
    chosen = rows.groupBy(*keys).agg(F.count("*").alias("n_signal_pairs"), best.alias("best")).select(*keys, "n_signal_pairs", "best.*")
    under = sensitivity.select(*keys, "hit1", "hit2", F.col("PRIOR_SET").alias("prior"), number("PP.H4.abf").alias("h"))
    names = {"LOW_P12": "h4_low", "DEFAULT": "h4_default", "HIGH_P12": "h4_high"}
    # By keys alone, as chosen is, so that only what belongs to the chosen pair is grouped.
    of_pair = grouping.spread(under, keys, n).join(chosen.select(*keys, F.col("hit1").alias("_1"), F.col("hit2").alias("_2")), list(keys)).where("hit1 = _1 AND hit2 = _2")
    each = of_pair.groupBy(*keys).agg(*(F.max(F.when(F.col("prior") == p, F.col("h"))).alias(c) for p, c in names.items()))
    return chosen.join(each, list(keys), "left")
