"""Readers and sinks on small written files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandspark.sources import readers, sinks


def put(path, text):
    path.write_text(text)
    return str(path)


def test_tsv_and_alias_binding(spark, tmp_path):
    with gzip.open(tmp_path / "a.tsv.gz", "wt") as f:
        f.write("CHR\tPosition\tP_VALUE\tjunk\n1\t55\t0.5\tx\n2\tbad\tNA\ty\n")
    df = readers.tsv(spark, str(tmp_path / "a.tsv.gz"), ["CHR", "Position", "P_VALUE"], partitions=2)
    got = readers.bind(df, {"chrom": ["chr"], "pos": ["pos", "position"], "p": ["p_value", "p"], "se": ["se"]}, ["chrom"], {"pos": "long", "p": "double"})
    assert {tuple(r) for r in got.collect()} == {("1", 55, 0.5, None), ("2", None, None, None)}
    with pytest.raises(ValueError, match="beta"):
        readers.bind(df, {"beta": ["beta", "effect"]}, ["beta"])


def test_vcf_and_splice_scores(spark, tmp_path):
    head = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\n"
    path = put(tmp_path / "a.vcf", head + "1\t5\tv1\ta\tc,g\t.\t.\tSpliceAI=c|G1|0.1|0.9|0.9|.|1|2|3|4,g|G2|bad;FLAG\n1\tx\tv2\tA\tT\t.\t.\t.\n1\t6\n")
    assert {(r.pos, r.alt) for r in readers.vcf(spark, path, split_alternatives=True).collect()} == {(5, "C"), (5, "G")}
    got = readers.splice_scores(readers.vcf(spark, path)).collect()
    assert [(r.allele, r.gene, r.max_score, r.event, r.offset) for r in got] == [("c", "G1", 0.9, "ACCEPTOR_LOSS", 2)]


def test_annotation_splice_csv_gtf_gmt(spark, tmp_path):
    a = readers.annotation_tab(spark, put(tmp_path / "a.txt", "## v\n#Uploaded_variation\tGene\nv1\tG1\n")).collect()
    assert [(r.variant_id, r.Gene) for r in a] == [("v1", "G1")]
    p = readers.splice_csv(spark, put(tmp_path / "p.csv", "CHROM,POS,REF,ALT,ID,Pangolin\n1,5,A,T,v1,G1|3:0.5|4:-0.6|w,G2|1:0.2|2:-0.1|w\n")).collect()
    assert {(r.gene, r.gain, r.loss, r.event) for r in p} == {("G1", 0.5, -0.6, "LOSS"), ("G2", 0.2, -0.1, "GAIN")}
    g = readers.gtf(spark, put(tmp_path / "g.gtf", '#!x\nchr1\ts\tgene\t1\t9\t.\t+\t.\tgene_id "ENSG01.2"; gene_name "N"; gene_type "t";\nchrX\ts\tgene\t1\t9\t.\t+\t.\tgene_id "E";\nchr1\ts\ttranscript\t1\t9\t.\t+\t.\tx\n')).collect()
    assert [(r.chrom, r.start, r.gene_id, r.gene_name, r.gene_type) for r in g] == [(1, 1, "ENSG01", "N", "t")]
    m = readers.gmt(spark, put(tmp_path / "m.gmt", "T1\td\ta\tb\ta\nT2\td\n")).collect()
    assert {(r.term, r.gene) for r in m} == {("T1", "A"), ("T1", "B")}


def test_json_documents_and_shards(spark, tmp_path):
    (tmp_path / "j").mkdir()
    put(tmp_path / "j/a.json", '{"h4": NaN, "name": "a"}')
    put(tmp_path / "j/b.json", '{"h4": 0.5, "name": "b"}')
    put(tmp_path / "j/c.json", '{"h4": 0.5, ')
    schema = T.StructType([T.StructField("h4", T.DoubleType()), T.StructField("name", T.StringType())])
    assert {(r.name, r.h4, r.state) for r in readers.json_documents(spark, str(tmp_path / "j"), schema).collect()} == {("a", None, "OK"), ("b", 0.5, "OK"), (None, None, "CORRUPT")}
    spark.range(5).write.parquet(str(tmp_path / "q"))
    part = next((tmp_path / "q").glob("part*.parquet"))
    bad = tmp_path / "bad.parquet"
    bad.write_bytes(part.read_bytes()[:40])
    got = {r.path: (r.state, r.n_rows) for r in readers.parquet_health(spark, [f"file://{part}", f"file://{bad}", f"file://{tmp_path}/none"]).collect()}
    assert got[f"file://{bad}"][0] == got[f"file://{tmp_path}/none"][0] == "CORRUPT_OR_TRUNCATED" and got[f"file://{part}"][0] == "READABLE"
    keys = spark.createDataFrame([("3",)], "k string")
    assert [r.id for r in readers.parquet_by_keys(spark, str(tmp_path / "q"), "id", keys).collect()] == [3]


def test_small_readers(spark, tmp_path):
    f = readers.allele_frequencies(spark, put(tmp_path / "f.afreq", "#CHROM ID REF ALT F\n 1  v1 A T 0.8,0.1 10\n1 v2 A T nan 10\n")).collect()
    assert [(r.id, round(r.maf, 6)) for r in f] == [("v1", 0.2)]
    log = readers.last_numbers(spark, put(tmp_path / "x.log", "kept 1 of 2\nkept 3 of 4\n"), "kept [0-9]+ of [0-9]+").collect()
    assert log[0].last == "kept 3 of 4"
    (tmp_path / "t").mkdir()
    put(tmp_path / "t/Brain.signif_pairs.txt", "x\n")
    n = readers.files_with_names(spark, str(tmp_path / "t"), [".signif_pairs.txt"]).first()
    assert n.tissue == "Brain"
    d = spark.createDataFrame([("m1", "ge", "p"), ("m2", "odd", "p"), ("m3", "leafcutter", "")], "id string, quant string, file string")
    kept = readers.manifest(d, {"dataset": ["id"], "method": ["quant"], "path": ["file"]}, {"ge": "eQTL", "leafcutter": "sQTL"}).collect()
    assert [(r.dataset, r.qtl_type) for r in kept] == [("m1", "eQTL")]
    page = spark.createDataFrame([([(1, "a"), (2, "b")],)], "rows array<struct<id:long,v:string>>")
    assert readers.pages_of(page, "rows").count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, 5, "v1", "A", "T", float("nan")), (1, 2, None, "C", "G", 0.5)], "chrom int, pos long, id string, ref string, alt string, x double")
    sinks.write_tsv(df, str(tmp_path / "t"))
    assert spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "t")).count() == 2
    sinks.write_json(df, str(tmp_path / "j"))
    assert {r.x for r in spark.read.schema(df.schema).json(str(tmp_path / "j")).collect()} == {None, 0.5}
    sinks.write_vcf(df, str(tmp_path / "v"), [("1", 1000)])
    assert [r.value.split("\t")[1] for r in spark.read.text(str(tmp_path / "v/body")).collect()] == ["2", "5"]
    sinks.write_by_key(df, str(tmp_path / "k"), ["chrom"])
    assert (tmp_path / "k/chrom=1").is_dir()
    ledger = sinks.selection_ledger(df, [(F.col("id").isNull(), "NO_ID")], [F.col("pos")]).collect()
    assert {(r.pos, r.reason, r["rank"]) for r in ledger} == {(5, "SELECTED", 1), (2, "NO_ID", None)}
    edges = spark.createDataFrame([(1, 2, 0.5)], "a long, b long, score double")
    assert 'source="1"' in sinks.graphml(spark.createDataFrame([(1,), (2,)], "node long"), edges)


def test_pages_with_errors_are_rows(spark, tmp_path):
    from strandspark.sources import paged

    spark.dataSource.register(paged.PagedJson)
    path = f"file://{tmp_path}/pages"
    sinks.write_pages(spark.range(45).select("id", F.lit("x").alias("t")), path, "id", 10)
    load = lambda p, **more: spark.read.format("paged_json").options(path=p, pages_per_task=2, **more).load()
    assert sorted(json.loads(r.row)["id"] for r in load(path).collect()) == list(range(45)) and load(path).rdd.getNumPartitions() == 3
    (tmp_path / "pages/page-1.json").unlink()
    (tmp_path / "pages/page-3.json").write_text("no page")
    (tmp_path / "pages/page-5.json").write_text('{"count": 45, "rows": [{"id": 99}]}')  # beyond the stated count
    found = load(path).collect()
    assert sorted(json.loads(r.row)["id"] for r in found if r.error is None) == [*range(10), *range(20, 30), *range(40, 45)]
    assert {(r.page, r.error) for r in found if r.error} == {(1, "FileNotFoundError"), (3, "JSONDecodeError")}
    assert [r.error for r in load(f"file://{tmp_path}/nowhere").collect()] == ["FileNotFoundError"]
    assert [r.error for r in load(path, rows="records").collect()] == ["KeyError"]


def test_reconciliation_reports_what_differs(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    assert tuple(sinks.write_reconciled(df, f"{tmp_path}/same").first()) == (100, 100, True)
    from pyspark.sql import DataFrameReader

    whole = DataFrameReader.parquet
    try:  # a reader that loses rows, and one that alters them
        DataFrameReader.parquet = lambda self, *p: whole(self, *p).where("k < 6")
        assert sinks.write_reconciled(df, f"{tmp_path}/fewer").first()[1:] == (86, False)
        DataFrameReader.parquet = lambda self, *p: whole(self, *p).withColumn("k", F.col("k") + 1)
        assert sinks.write_reconciled(df, f"{tmp_path}/other").first()[1:] == (100, False)
    finally:
        DataFrameReader.parquet = whole


def test_region_scans_skip_what_lies_outside(spark, tmp_path):
    rows = spark.range(200_000).select((F.col("id") % 4).cast("int").alias("chrom"), F.expr("id div 4").alias("pos"), F.col("id").alias("x"))
    path = f"{tmp_path}/laid"
    sinks.write_by_position(rows, path)
    wanted = spark.createDataFrame([(1, 100, 110, "a"), (1, 105, 400, "b"), (2, 0, 3, "c"), (9, 0, 10**6, "d")], "chrom int, start long, end long, name string")
    found = readers.regions(spark, path, wanted, 50)
    assert sorted((r.chrom, r.pos, r["name"]) for r in found.collect()) == sorted((c, p, n) for c, s, e, n in [(1, 100, 110, "a"), (1, 105, 400, "b"), (2, 0, 3, "c")] for p in range(s, e + 1))
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan parquet" in x)
    assert "chrom" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0] and "LessThanOrEqual(pos" in scan.split("PushedFilters:")[1]
    assert readers.regions(spark, path, wanted.limit(0)).count() == 0


def test_best_pairs(spark):
    h = ", ".join(f"`PP.H{k}.abf` string" for k in range(5))
    summaries = spark.createDataFrame([("a", "1", "1", *"0000", "0.7"), ("a", "2", "1", *"0000", "0.9"), ("a", "1", "2", *"0000", "0.9"), ("a", "3", "1", *"0000", "inf"), ("b", "1", "1", *"0000", "nan")], f"k string, hit1 string, hit2 string, {h}")
    under = spark.createDataFrame([("a", "1", "2", "0.8", "LOW_P12"), ("a", "1", "2", "0.9", "DEFAULT"), ("a", "2", "1", "0.1", "HIGH_P12")], "k string, hit1 string, hit2 string, `PP.H4.abf` string, PRIOR_SET string")
    got = {r.k: (r.n_signal_pairs, r.hit1, r.hit2, r.h4, r.h4_low, r.h4_default, r.h4_high) for r in readers.best_pairs(summaries, under, ["k"]).collect()}
    assert got == {"a": (4, "1", "2", 0.9, 0.8, 0.9, None), "b": (1, None, None, None, None, None, None)}
