"""Edge cases of operators on small hand-made tables."""

import math
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strandspark.functions import classify, clean
from strandspark.operators import graphs, greedy, grouped, grouping, intervals, joins, kernels, ld, scans
from strandspark.plans import parity


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(("text", "value"), [("chr7", 7), (" CHR22 ", 22), ("23", None), ("X", None), ("1.0", 1), (None, None)])
def test_chromosome(spark, text, value):
    assert one(spark, clean.chromosome(F.lit(text))) == value


@pytest.mark.parametrize(("text", "value"), [("1e-5", 1e-5), ("junk", None), ("NaN", None), ("inf", None), (None, None)])
def test_numeric(spark, text, value):
    assert one(spark, clean.numeric(F.lit(text))) == value


def test_scalars(spark):
    assert one(spark, clean.allele(F.lit(" a "))) == "A" and one(spark, clean.allele(F.lit("."))) is None
    assert one(spark, clean.variant_key(F.lit(1), F.lit(5), F.lit("A"), F.lit(None).cast("string"))) is None
    assert one(spark, clean.parse_variant_key(F.lit("chr1_55_A_T_b38"))).pos == 55
    assert one(spark, clean.gene_base(F.lit("ENSG00000000003.15"))) == "ENSG00000000003" and one(spark, clean.gene_base(F.lit("TP53"))) == "TP53"
    assert one(spark, clean.sample_size(F.lit("1,200 cases, 99 twins, 3,000 controls"))) == 4200
    assert one(spark, clean.sample_size(F.lit("12 twins and 30 more"))) == 12 and one(spark, clean.sample_size(F.lit("none"))) is None
    assert one(spark, clean.effective_n(F.lit(10), F.lit(10))) == 20
    assert one(spark, clean.effect_from_odds_ratio(F.lit(None).cast("double"), F.lit(0.0))) is None
    assert one(spark, clean.standard_error(F.lit(-1.0), F.lit(None).cast("double"), F.lit(None).cast("double"))) is None
    assert one(spark, clean.z_score(F.lit(None).cast("double"), F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, clean.oriented(F.lit(2.0), F.lit("T"), F.lit("A"), F.lit("T"))) == -2.0 and one(spark, clean.oriented(F.lit(2.0), F.lit("G"), F.lit("A"), F.lit("T"))) is None
    assert one(spark, clean.as_bool_or_null(F.lit("maybe"))) is None and one(spark, clean.as_bool(F.lit("maybe"))) is False
    assert one(spark, clean.term_score(F.lit("als"), F.lit(""), F.lit(""), "ALS")) == 100
    assert one(spark, clean.term_score(F.lit("falsity"), F.lit("x"), F.lit("late als study"), "als")) == 40
    assert one(spark, clean.has_full_summary(F.lit("NR"))) is False


@pytest.mark.parametrize(("score", "name"), [(0.8, "HIGH"), (0.5, "MODERATE"), (0.2, "LOW"), (0.1999, "NEGLIGIBLE"), (None, "NOT_SCORED")])
def test_score_edges(spark, score, name):
    assert one(spark, classify.score_class(F.lit(score).cast("double"))) == name


@pytest.mark.parametrize(("score", "name"), [(35, "P1"), (35.1, "P2"), (50, "P2"), (65, "P3"), (80, "P4"), (80.5, "P5")])
def test_priority_edges_are_right_closed(spark, score, name):
    assert one(spark, classify.priority_tier(F.lit(score))) == name


def test_two_rules_for_strong(spark):
    h = tuple(F.lit(x) for x in (0.0, 0.0, 0.0, 0.9, 0.85))
    assert one(spark, classify.colocalisation_class(h)) == "STRONG_SHARED_SIGNAL" and one(spark, classify.colocalisation_class(h, strict=True)) == "SUGGESTIVE_SHARED_SIGNAL"
    null = F.lit(None).cast("double")
    without = (*h[:3], null, h[4])
    assert one(spark, classify.colocalisation_class(without, strict=True)) == "STRONG_SHARED_SIGNAL"
    assert one(spark, classify.colocalisation_class((*h[:4], null), strict=True)) == "NO_PP_H4_RETURNED" and one(spark, classify.colocalisation_class((*h[:4], null))) == classify.FAVOURED[3]
    for values, simple, strict in (((0.4, 0.4, 0.1, 0.1, 0.0), classify.FAVOURED[0], classify.FAVOURED[3]), ((0.1, 0.2, 0.1, 0.3, 0.3), classify.FAVOURED[3], "NO_STRONG_SHARED_SIGNAL"), ((0.1, 0.1, 0.1, 0.3, 0.4), classify.FAVOURED[4], "NO_STRONG_SHARED_SIGNAL")):
        h = tuple(F.lit(x) for x in values)
        assert (one(spark, classify.colocalisation_class(h)), one(spark, classify.colocalisation_class(h, strict=True))) == (simple, strict)
    assert one(spark, classify.robust_prior(F.lit(0.9), F.lit(0.5), F.lit(0.9), strict=False)) and not one(spark, classify.robust_prior(F.lit(0.9), F.lit(0.5), F.lit(0.9)))


def test_every_consequence_term_has_its_category(spark):
    rows = [(t, None, "SPLICING", "SPLICING") for t in classify.SPLICING_TERMS] + [(t, "lncRNA", "CODING", "CODING") for t in classify.CODING_TERMS] + [(t, None, "UTR", "UTR") for t in classify.UTR_TERMS]
    rows += [("regulatory_region_ablation", None, "REGULATORY", "REGULATORY"), ("TF_binding_site_variant", None, "REGULATORY", "REGULATORY"), ("TFBS_amplification", None, "OTHER", "REGULATORY"), ("regulatory_x", None, "OTHER", "REGULATORY")]
    rows += [("non_coding_transcript_exon_variant", None, "NONCODING_RNA", "NONCODING_RNA"), *(("intron_variant", f"x_{b.upper()}", "NONCODING_RNA", "NONCODING_RNA") for b in classify.NONCODING_BIOTYPES)]
    rows += [(term, "protein_coding", name, name) for term, name in classify.PLACES] + [(None, None, "OTHER", "OTHER"), ("", "", "OTHER", "OTHER"), ("intron_variant&splice_region_variant", None, "SPLICING", "SPLICING"), ("my_missense_variant", None, "CODING", "OTHER")]
    df = spark.createDataFrame(rows, "c string, b string, wide string, narrow string")
    found = df.select("*", classify.functional_category(F.col("c"), F.col("b"), exact=False).alias("x"), classify.functional_category(F.col("c"), F.col("b")).alias("y")).collect()
    assert [(r.c, r.b, r.x, r.y) for r in found] == [(c, b, x, y) for c, b, x, y in rows]


def test_variant_and_genomic_context(spark):
    rows = [("stop_gained", None, None, "CODING_PTV_OR_CANONICAL_SPLICE"), ("Missense_variant", "", "", "CODING_MISSENSE_OR_PROTEIN_ALTERING"), ("stop_retained_variant", None, None, "CODING_SYNONYMOUS"), ("splice_region_variant", None, None, "SPLICE_REGION"), ("5_prime_UTR_variant", "lncRNA", None, "UTR"), ("intron_variant", "misc_RNA", None, "NONCODING_RNA"), ("upstream_gene_variant", None, None, "REGULATORY"), ("intron_variant", None, "regulatory", "REGULATORY"), ("intron_variant", None, None, "INTRONIC"), ("intergenic_variant", None, None, "INTERGENIC"), (None, None, "CODING", "CODING_OTHER"), (None, None, "splicing", "SPLICING_OTHER"), (None, None, None, "OTHER_OR_UNRESOLVED")]
    df = spark.createDataFrame(rows, "c string, b string, f string, want string")
    assert [r.got for r in df.select(classify.variant_context(classify.terms_of(F.col("c")), F.col("b"), F.col("f")).alias("got")).collect()] == [r[3] for r in rows]
    cases = [(["CDS", "exon"], ["protein_coding"], ["A"], ("CODING_CDS", "CODING", "PROTEIN_CODING")), (["CDS"], ["lncRNA"], ["A"], ("LNCRNA_GENE_BODY_INTRONIC_OR_OTHER", "NONCODING", "LNCRNA")), (["UTR", "exon"], ["protein_coding", "miRNA"], [], ("UTR_PROTEIN_CODING_GENE", "NONCODING", "PROTEIN_CODING;OTHER_NCRNA")), (["exon"], ["pseudogene"], ["A"], ("EXON_OTHER_GENE", "NONCODING", "OTHER_GENE_TYPE")), ([], [], ["A"], ("OTHER_GENE_BODY", "NONCODING", "NO_GENE")), ([], [], [], ("INTERGENIC", "NONCODING", "NO_GENE"))]
    df = spark.createDataFrame([c[:3] for c in cases], "f array<string>, t array<string>, n array<string>")
    assert [tuple(r.got) for r in df.select(classify.genomic_context(F.col("f"), F.col("t"), F.col("n")).alias("got")).collect()] == [c[3] for c in cases]


def test_alleles_against_mappings(spark):
    good = '[{"assembly_name": "GRCh37", "seq_region_name": "1", "start": 5, "allele_string": "T/C"}, {"assembly_name": "GRCh38.p14", "seq_region_name": "1", "start": 5, "allele_string": "A/G/T"}]'
    rows = [("rs1", good, "chr1", 5, "a", "g", "PASS", "A", "G;T"), ("rs1", good, "1", 5, "G", "A", "REF_ALT_SWAPPED", "A", "G;T"), ("rs1", good, "1", 5, "G", "T", "ALLELES_PRESENT_REFERENCE_MISMATCH", "A", "G;T"), ("rs1", good, "1", 5, "A", "C", "ALLELE_NOT_IN_RSID_MAPPING", "A", "G;T"), ("rs1", good, "1", 6, "A", "G", "NO_GRCH38_POSITION_MATCH", "", ""), (" ", good, "1", 5, "A", "G", "NO_RSID", "", ""), ("rs1", None, "1", 5, "A", "G", "NO_MAPPING", "", ""), ("rs1", "not json", "1", 5, "A", "G", "MAPPING_PARSE_ERROR", "", ""), ("rs1", '[{"assembly_name": "GRCh38", "seq_region_name": "1", "start": 5}]', "1", 5, "A", "G", "NO_ALLELE_STRING", "", "")]
    df = spark.createDataFrame(rows, "i string, m string, c string, p long, r string, a string, x string, y string, z string")
    got = df.select(classify.allele_check(*(F.col(c) for c in "imcpra")).alias("g")).collect()
    assert [tuple(r.g) for r in got] == [r[6:] for r in rows]


def test_json_paths(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": {"c": 1.5, "d": null}, "l": [1, "x"]}, "e": "t"}'), (2, "broken {"), (3, None), (4, "[1]")], "id long, j string")
    assert {(r.id, r.path): r.value for r in clean.flatten_json(df, "id", "j").collect()} == {(1, "a.b.c"): "1.5", (1, "a.b.d"): None, (1, "a.l"): "1;x", (1, "e"): "t"}


def test_best_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 1), ("a", 3.0, 3), ("a", 3.0, 2), ("b", None, 5), ("b", None, 4)], "k string, v double, o long")
    assert {(r.k, r.o) for r in grouping.arg_best(df, ["k"], "v", [F.col("o")]).collect()} == {("a", 2), ("b", 4)}
    assert {(r.k, r.o) for r in grouping.arg_best(df, ["k"], "v", [F.col("o")], all_null="none").collect()} == {("a", 2)}
    assert {(r.k, r.top_o) for r in grouping.several_best(df, ["k"], {"top": ("v", ["o"])}, "o").collect()} == {("a", 2), ("b", None)}


def test_percentile_rank(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (None,)], "v double")
    assert sorted((r.v, r.p) for r in df.select("v", grouping.percentile_rank(F.col("v")).alias("p")).where("v is not null").collect()) == [(1.0, 1 / 3), (2.0, 2.5 / 3), (2.0, 2.5 / 3)]
    assert [r.p for r in df.limit(1).select(grouping.percentile_rank(F.col("v")).alias("p")).collect()] == [0.0]


def test_fdr_ignores_null(spark):
    df = spark.createDataFrame([(1, 0.01), (2, 0.02), (3, 0.9), (4, None)], "id long, p double")
    got = {r.id: r.q for r in scans.bh_fdr(df, "p", "q").collect()}
    assert got[4] is None and [round(got[k], 6) for k in (1, 2, 3)] == [0.03, 0.03, 0.9]


def test_repeated_lookup_key_is_an_error(spark):
    left, right = spark.createDataFrame([(1,)], "k long"), spark.createDataFrame([(1, "a"), (1, "b")], "k long, v string")
    with pytest.raises(Exception, match="repeated key"):
        joins.lookup(left, right, ["k"]).collect()


def test_allele_matching(spark):
    rows = spark.createDataFrame([(1, 1, 10, "A", "T"), (2, 1, 20, "C", "G"), (3, 1, 30, "A", "T"), (4, 1, 40, "A", "T")], "row_id long, chrom int, pos long, a1 string, a2 string")
    ref = spark.createDataFrame([(11, 1, 10, "T", "A"), (12, 1, 10, "T", "C"), (21, 1, 20, "A", "T"), (31, 1, 30, "A", "T"), (32, 1, 30, "T", "A")], "ref_id long, chrom int, pos long, ref string, alt string")
    assert {(r.row_id, r.status, r.ref_id) for r in joins.match_by_position_and_alleles(rows, ref).collect()} == {(1, "MATCHED", 11), (2, "POSITION_ONLY", 21), (3, "AMBIGUOUS", None), (4, "ABSENT", None)}


def test_islands_touch_nest_and_clip(spark):
    df = spark.createDataFrame([("c", 1, 10), ("c", 10, 12), ("c", 13, 30), ("c", 14, 15), ("c", 29, 31), ("d", 5, 6)], "k string, s long, e long")
    got = sorted((r.k, r.island, r.s, r.e, r.n_members) for r in intervals.merged(df, ["k"], "s", "e").collect())
    assert got == [("c", 1, 1, 12, 2), ("c", 2, 13, 31, 3), ("d", 1, 5, 6, 1)]
    s, e = intervals.window_around(F.lit(3), 10)
    assert one(spark, s) == 1 and one(spark, e) == 13


@pytest.mark.parametrize("width", [3, 10, 1000])
@pytest.mark.parametrize("padding", [0, 7])
def test_interval_join_equals_brute_force(spark, width, padding):
    rng = np.random.default_rng(1)
    a = [(i % 3, i, int(s), int(s + n)) for i, (s, n) in enumerate(zip(rng.integers(0, 200, 60), rng.integers(0, 30, 60), strict=True))]
    b = [(i % 3, i, int(s), int(s + n)) for i, (s, n) in enumerate(zip(rng.integers(0, 200, 60), rng.integers(0, 30, 60), strict=True))]
    left, right = spark.createDataFrame(a, "k long, l_id long, l_start long, l_end long"), spark.createDataFrame(b, "k long, r_id long, r_start long, r_end long")
    got = sorted((r.l_id, r.r_id) for r in intervals.overlapping(left, right, ["k"], width, padding).collect())
    assert got == sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] - padding <= y[3] and y[2] <= x[3] + padding)
    points = left.select("k", "l_id", F.col("l_start").alias("p"))
    inside = sorted((r.l_id, r.r_id) for r in intervals.points_in(points, right, ["k"], "p", "r_start", "r_end", width).collect())
    assert inside == sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and y[2] <= x[2] <= y[3])


def test_nearest_prefers_the_lower_of_equals(spark):
    p, o = spark.createDataFrame([(1, 10), (2, 100), (3, 5)], "id long, p long"), spark.createDataFrame([(8,), (12,), (90,)], "o long")
    p, o = p.withColumn("k", (F.col("id") == 3).cast("int")), o.withColumn("k", F.lit(0))
    assert {(r.id, r.nearest, r.distance) for r in intervals.nearest(p, o, ["k"], "p", "o").collect()} == {(1, 8, 2), (2, 90, 10), (3, None, None)}


def test_colocalisation_sums_to_one(spark):
    rows = [(1, 0.0, 0.0), (1, 20.0, 18.0), (1, 1.0, 2.0), (2, 25.0, 0.0), (2, 0.0, 25.0), (3, 9.0, 8.0)]
    got = kernels.colocalise(spark.createDataFrame(rows, "k long, a double, b double"), ["k"], "a", "b").where("prior = 'DEFAULT'").collect()
    by = {r.k: r for r in got}
    assert all(abs(sum(r[f"h{k}"] for k in range(5)) - 1) < 1e-9 for r in got)
    assert by[1].h4 > 0.9 and by[2].h3 > 0.9 and by[3].h3 == 0.0
    a, b = np.array([0.0, 20, 1]), np.array([0.0, 18, 2])
    lse = lambda x: np.log(np.exp(x).sum())
    logs = [0, math.log(1e-4) + lse(a), math.log(1e-4) + lse(b), 2 * math.log(1e-4) + np.log(np.exp(lse(a) + lse(b)) - np.exp(lse(a + b))), math.log(5e-6) + lse(a + b)]
    assert abs(by[1].h4 - np.exp(logs[4] - lse(np.array(logs)))) < 1e-9


def test_hypergeometric_tail(spark):
    sizes = [(50, 10, 8), (1, 1, 1), (20, 20, 5), (20, 0, 5), (30_000, 400, 900), (30_000, 15_000, 15_000), (3_000_000, 2_000, 5_000)]
    rows = [(m, s, n, k) for m, s, n in sizes for k in {0, 1, 3, 5, 9, min(s, n) // 4, min(s, n) // 2, min(s, n), min(s, n) + 1}]
    got = {(r.m, r.s, r.n, r.k): r.p_value for r in kernels.hypergeometric_tail(spark.createDataFrame(rows, "m long, s long, n long, k long"), "m", "s", "n", "k").collect()}
    for (m, s, n, k), p in got.items():
        log = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
        exact = math.fsum(math.exp(log(s, i) + log(m - s, n - i) - log(m, n)) for i in range(max(k, n + s - m, 0), min(s, n) + 1))
        assert abs(p - exact) <= 1e-9 + 1e-6 * (m > 10_000) * exact, (m, s, n, k)


def test_clumps(spark):
    v = spark.createDataFrame([(1, 100, "a", 1e-9), (1, 200, "b", 1e-3), (1, 300, "c", 1e-10), (1, 5_000_000, "d", 1e-3), (2, 1, "e", 5e-8), (2, 2, "f", 0.5)], "chrom int, pos long, id string, p double")
    ld = spark.createDataFrame([(1, "a", "b", 0.5), (1, "c", "a", 0.05), (1, "c", "d", 0.9), (1, "b", "c", 0.2)], "chrom int, a string, b string, r2 double")
    assert {(r.lead, r.id) for r in greedy.clump(v, ld).collect()} == {("c", "c"), ("c", "b"), ("a", "a"), ("e", "e")}


def test_fine_mapping_finds_the_signal(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 30))
    x[:, 1] = x[:, 0] * 0.9 + x[:, 1] * 0.3
    r = np.corrcoef(x.T)
    y = 0.3 * x[:, 0] - 0.25 * x[:, 20] + rng.normal(size=2000)
    z = (x - x.mean(0)).T @ (y - y.mean()) / (x.std(0) * y.std() * math.sqrt(2000))
    stats = spark.createDataFrame([("l", i, float(z[i]), 2000) for i in range(30)], "locus string, variant long, z double, n long")
    ld = spark.createDataFrame([("l", i, j, float(r[i, j])) for i in range(30) for j in range(i + 1, 30)], "locus string, i long, j long, r double")
    got = {x.variant: x for x in grouped.fine_map(stats, ld).collect()}
    assert got[0].pip > 0.9 and got[20].pip > 0.9 and got[20].sets and sum(g.pip > 0.5 for g in got.values()) == 2


def test_greedy_and_redundancy(spark):
    p = spark.createDataFrame([("s", 1, 1, 0.9), ("s", 1, 2, 0.8), ("s", 2, 1, 0.85), ("s", 2, 2, 0.1), ("t", 1, 1, 0.5)], "k string, a long, b long, score double")
    assert {(r.k, r.a, r.b) for r in greedy.greedy_match(p, "k").collect()} == {("s", 1, 1), ("s", 2, 2), ("t", 1, 1)}
    t = spark.createDataFrame([("g", "x", 0.01, ["1", "2", "3"]), ("g", "y", 0.02, ["1", "2", "3"]), ("g", "z", 0.03, ["9"])], "g string, term string, fdr double, genes array<string>")
    assert {(r.term, r.representative) for r in greedy.redundancy_clusters(t, "g").collect()} == {("x", "x"), ("y", "x"), ("z", "z")}


def test_graphs(spark):
    e = kernels.undirected_edges(spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.9), (2, 3, 0.4), (3, 3, 1.0), (7, 8, 0.2)], "x long, y long, s double"), "x", "y", "s")
    assert {(r.a, r.b, r.score) for r in e.collect()} == {(1, 2, 0.9), (2, 3, 0.4), (7, 8, 0.2)}
    assert {(r.node, r.component) for r in graphs.connected(e).collect()} == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7)}
    rank = {r.node: r.rank for r in graphs.page_rank(e).collect()}
    assert abs(sum(rank.values()) - 1) < 1e-6 and rank[2] == max(rank.values())


@pytest.mark.parametrize("block", [2, 7, 512])
def test_ld_matrix(spark, block):
    rng = np.random.default_rng(0)
    g = rng.integers(0, 3, (40, 25)).astype(float)
    g[:, 3] = 1.0  # constant
    g[:, 4] = 0.0
    g[rng.random(g.shape) < 0.03] = np.nan
    g[:20, 5] = np.nan  # too many are missing
    rows = [(name, f"v{v:02}", s, None if np.isnan(g[s, v]) else float(g[s, v])) for name in ("l", "m") for v in range(25) for s in range(40)] + [("n", "v00", 1, 2.0), ("l", "v00", 0, -1.0), (None, "v00", 1, 1.0)]
    got = {(r.locus, r.i, r.j): r.r for r in ld.ld_matrix(spark.createDataFrame(rows, "locus string, variant string, sample long, dosage double"), most_missing=0.2, block=block, cells=400).collect()}
    mean = np.nanmean(g, axis=0)
    x = np.where(np.isnan(g), 0.0, g - mean)
    kept = [v for v in range(25) if v not in (3, 4, 5)]
    want = {(name, f"v{i:02}", f"v{j:02}"): float(x[:, i] @ x[:, j] / np.sqrt((x[:, i] ** 2).sum() * (x[:, j] ** 2).sum())) for name in ("l", "m") for i in kept for j in kept if i < j}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_testable_pairs_settle_repeated_rows_in_tasks_that_are_not_put_together(spark):
    loci = spark.createDataFrame([(1, "t")], "locus long, trait string")
    qtl = spark.createDataFrame([(1, "t", 7, 1.0, None), (1, "t", 7, 2.0, 500)], "locus long, trait string, variant long, z double, n int").coalesce(1)
    gwas = spark.createDataFrame([(1, 7, 1.0, None, None, None, None), (1, 7, 2.0, 900, True, 10, 20)], "locus long, variant long, z double, n int, case_control boolean, n_cases int, n_controls int").coalesce(1)
    ld = spark.createDataFrame([(1, 7, 8, 0.5), (1, 7, 8, 0.5)], "locus long, i long, j long, r double")
    found = kernels.testable_pairs(loci, gwas, qtl, ld, common=(1, 60))
    (row,) = found.collect()  # the first of repeated rows counted before, with or without its sample size
    assert (row.n_qtl, row.n_common, row.n_in_ld, row.status) == (1, 1, 1, "TESTED")
    assert found._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") >= 2


def test_colocalisation_of_fine_mapped_signals(spark):
    """Two traits at one locus: one shares the causal variant, one has its own; a third has too few variants."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=(3000, 40))
    g = base + 0.5 * np.roll(base, 1, axis=1)
    r = np.corrcoef(g.T)
    ld = spark.createDataFrame([(1, i, j, float(r[i, j])) for i in range(40) for j in range(i + 1, 40)], "locus int, i int, j int, r double")
    z = lambda causal: r[causal] * 12 + rng.normal(size=40) * 0.3
    gwas = spark.createDataFrame([(1, v, float(x), 5000, False) for v, x in enumerate(z(10))], "locus int, variant int, z double, n int, case_control boolean").withColumn("n_cases", F.lit(None).cast("int")).withColumn("n_controls", F.lit(None).cast("int"))
    rows = [(1, t, v, float(x), 800) for t, c in (("same", 10), ("other", 30)) for v, x in enumerate(z(c))] + [(1, "few", v, 1.0, 800) for v in range(5)]
    qtl = spark.createDataFrame(rows, "locus int, trait string, variant int, z double, n int")
    loci = spark.createDataFrame([(1, t) for t in ("same", "other", "few", "none")], "locus int, trait string")
    found = kernels.colocalise_signals(loci, gwas, qtl, ld, common=(20, 100)).collect()
    status = {x.trait: x.status for x in found}
    assert status == {"same": "TESTED", "other": "TESTED", "few": "NOT_TESTED_TOO_FEW_COMMON_SNPS", "none": "NOT_TESTED_NO_DENSE_QTL_ROWS"}
    top = {t: max((x for x in found if x.trait == t and x.prior == "DEFAULT"), key=lambda x: x.h3 + x.h4) for t in ("same", "other")}
    assert top["same"].h4 > 0.9 and top["other"].h3 > 0.9


def plain_fit(z, r, n, effects, ridge=1e-4):
    """Single effects one by one, variant by variant: inclusion probabilities and log Bayes factors."""
    p = len(z)
    r = [[1.0 if a == b else (1 - ridge) * r[a][b] for b in range(p)] for a in range(p)]
    z = [x * math.sqrt((n - 1) / (x * x + n - 2)) for x in z]
    alpha, mean, prior, lbf, s2 = [[1 / p] * p for _ in range(effects)], [[0.0] * p for _ in range(effects)], [0.2] * effects, [[0.0] * p for _ in range(effects)], 1 / (n - 1)
    for _ in range(100):
        last = [a[:] for a in alpha]
        for k in range(effects):
            others = [sum(mean[m][v] for m in range(effects) if m != k) for v in range(p)]
            beta = [(math.sqrt(n - 1) * z[v] - (n - 1) * sum(r[v][u] * others[u] for u in range(p))) * s2 for v in range(p)]
            lbf[k] = [0.5 * math.log(s2 / (s2 + prior[k])) + 0.5 * b * b / s2 * prior[k] / (s2 + prior[k]) for b in beta]
            top = max(lbf[k])
            w = [math.exp(x - top) for x in lbf[k]]
            alpha[k] = [x / sum(w) for x in w]
            variance = 1 / (1 / s2 + 1 / prior[k])
            mu = [variance / s2 * b for b in beta]
            mean[k] = [a * m for a, m in zip(alpha[k], mu, strict=True)]
            prior[k] = max(sum(a * (m * m + variance) for a, m in zip(alpha[k], mu, strict=True)), 1e-12)
        if max(abs(x - y) for a, b in zip(alpha, last, strict=True) for x, y in zip(a, b, strict=True)) < 1e-3:
            break
    return alpha, lbf


def test_fits_and_report_equal_the_plain_loops(spark):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(2000, 24))
    r = np.corrcoef((base + 0.6 * np.roll(base, 1, axis=1)).T)
    z1, z2 = r[6] * 11 + 0.3 * rng.normal(size=24), r[6] * 9 + 0.3 * rng.normal(size=24)
    apart = np.where(np.arange(24) % 2 == 0, 9.0, -9.0)  # what these correlations cannot give
    ld_rows = spark.createDataFrame([(1, i, j, float(r[i, j])) for i in range(24) for j in range(i + 1, 24)], "locus int, i int, j int, r double")
    gwas = spark.createDataFrame([(1, v, float(x), 5000, False, None, None) for v, x in enumerate(z1)], "locus int, variant int, z double, n int, case_control boolean, n_cases int, n_controls int")
    qtl = spark.createDataFrame([(1, t, v, float(x), 800, None if v % 2 else 0.7) for t, z in (("same", z2), ("odd", apart)) for v, x in enumerate(z)], "locus int, trait string, variant int, z double, n int, maf double")
    panel = spark.createDataFrame([(1, v, 0.2) for v in range(24) if v != 5], "locus int, variant int, maf double")
    loci = spark.createDataFrame([(1, "same"), (1, "odd"), (2, "same")], "locus int, trait string")
    report = {(x.locus, x.trait): x for x in kernels.colocalisation_report(loci, gwas, qtl, ld_rows, panel, common=(20, 100), effects=3).collect()}
    same, odd = report[1, "same"], report[1, "odd"]
    assert report[2, "same"].status == "NOT_TESTED_NO_DENSE_QTL_ROWS" and not report[2, "same"].ld_mismatch_warning and report[2, "same"].coloc_class is None
    assert same.status == "COMPLETE" and same.coloc_class == "STRONG_SHARED_SIGNAL" and same.prior_robust and not same.ld_mismatch_warning and odd.ld_mismatch_warning
    assert same.n_from_panel == 11 and same.maf_source == "QTL_FILE+PANEL"
    kept = [v for v in range(24) if v != 5]  # without a frequency on either side
    _, one = plain_fit(list(z1), r, 5000, 3)
    _, two = plain_fit([z2[v] for v in kept], r[np.ix_(kept, kept)], 800, 3)
    a, b = [one[same.hit1 - 1][v] for v in kept], two[same.hit2 - 1]
    for prior, h4 in ((5e-6, same.h4), (1e-6, same.h4_low), (1e-5, same.h4_high)):
        total = lambda x: math.fsum(math.exp(v - 60) for v in x)
        both = total([x + y - 60 for x, y in zip(a, b, strict=True)])
        parts = [math.exp(-120), 1e-4 * total(a) * math.exp(-60), 1e-4 * total(b) * math.exp(-60), 1e-8 * (total(a) * total(b) - both), prior * both]
        assert abs(parts[4] / sum(parts) - h4) < 1e-6
    values, vectors = np.linalg.eigh(r)
    z = z1 * np.sqrt(4999 / (z1**2 + 4998))
    loss = [0.5 * sum(math.log((1 - s) * v + s) + (vectors[:, k] @ z) ** 2 / ((1 - s) * v + s) for k, v in enumerate(values)) for s in np.linspace(0, 1, 2001)]
    assert abs(same.gwas_s - np.argmin(loss) / 2000) < 1e-3
    fits = grouped.signals(gwas.select("locus", F.lit("").alias("trait"), "variant", "z", "n"), ld_rows, effects=3)
    assert {x.status for x in kernels.colocalise_signals(loci.where("locus = 1"), gwas, qtl, ld_rows, (20, 100), fits.where("locus = 9"), effects=3).collect()} == {"NOT_TESTED_GWAS_FIT_MISSING"}
    given = {x.trait: x for x in kernels.colocalisation_report(loci, gwas, qtl, ld_rows, panel, common=(20, 100), fits=fits, effects=3).where("locus = 1").collect()}
    assert abs(given["same"].h4 - same.h4) < 1e-9


def test_distances_to_seeds(spark):
    edges = spark.createDataFrame([(1, 2, 0.5), (2, 3, 0.5), (1, 3, 2.0), (3, 4, 1.0), (7, 8, 1.0)], "a int, b int, distance double")
    seeds = spark.createDataFrame([(1,), (9,), (1,), (None,)], "node int")
    found = {(x.seed, x.node): (x.hops, x.distance) for x in graphs.distances(edges, seeds).collect()}
    assert found == {(1, 1): (0, 0.0), (1, 2): (1, 0.5), (1, 3): (1, 1.0), (1, 4): (2, 2.0), (9, 9): (0, 0.0)}
    assert graphs.distances(edges.limit(0), seeds.limit(0)).count() == 0


@pytest.mark.parametrize(("num", "den"), [(50, 100), (80, 100), (1, 1)])
def test_similar_sets_equal_all_pairs(spark, num, den):
    rng = np.random.default_rng(2)
    sets = {o: set(rng.choice(30, rng.integers(1, 9), replace=False).tolist()) | {99} for o in range(80)}  # one member that all have
    sets |= {100 + k: {1, 2, 3, 4, 5 + k % 3} for k in range(12)} | {200: {7}, 201: {7}, 202: {8}}
    rows = [(o, m) for o, s in sets.items() for m in s] + [(0, next(iter(sets[0]))), (None, 1), (5, None)]
    got = {(r.left_id, r.right_id): (r.shared, r.n_left, r.n_right) for r in joins.similar_sets(spark.createDataFrame(rows, "o long, m long"), "o", "m", num, den).collect()}
    want = {(a, b): (len(x & y), len(x), len(y)) for a, x in sets.items() for b, y in sets.items() if a < b and den * len(x & y) >= num * len(x | y)}
    assert got == want and want


def test_long_numbers_and_deep_objects(spark):
    assert one(spark, clean.sample_size(F.lit("id 12345678901234567890 of 150"))) == 12345678901234567890 + 150
    assert one(spark, clean.sample_size(F.lit("9" * 39 + " and 150"))) is None and one(spark, clean.sample_size(F.lit("9" * 38 + " and " + "9" * 38))) is None
    text = '{"a": ' * 20 + '{"x": [1, {"y": 2}], "z": 3}' + "}" * 20
    df = spark.createDataFrame([(1, text), (2, "[1]"), (3, None), (4, "{}")], "id long, j string")
    path = "a." * 20
    assert {(r.id, r.path): r.value for r in clean.flatten_json(df, "id", "j").collect()} == {(1, path + "x"): '1;{"y":2}', (1, path + "z"): "3"}
    assert one(spark, clean.json_first(F.lit('{"a": null, "b": {"c": 5}}'), "$.a", "$.q", "$.b.c")) == "5"


def test_shares_do_not_hang_on_the_order_of_rows(spark, tmp_path):
    """13 of 25 equal weights are 0.52; as doubles their sums give 0.5199999999999999."""
    rows = [(int(100 * w), 30.0 if k < up else 10.0, w) for w, up in ((0.07, 13), (0.01, 13), (0.06, 12)) for k in range(25)] + [(0, 10.0, 0.0)]
    spark.createDataFrame(rows, "l_suppkey long, l_quantity double, l_discount double").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.l_suppkey: (r.up_share, r.consensus) for r in parity.QUERIES["weighted_consensus"](spark, str(tmp_path)).collect()}
    assert got == {7: (0.52, "UP"), 1: (0.52, "UP"), 6: (0.48, "DOWN"), 0: (None, "CONFLICT")}


@pytest.mark.parametrize("rows", [1 << 20, 7])
def test_sums_in_the_order_of_files(spark, tmp_path, monkeypatch, rows):
    """Doubles added one after the other, a stretch of rows at a time, however Spark deals them."""
    monkeypatch.setattr(grouping, "IN_TURN", rows)
    x = [None if k % 11 == 5 else (k * 37 % 101) / 100 for k in range(400)]
    pd.DataFrame({"k": [k % 3 for k in range(400)], "x": x}).to_parquet(tmp_path / "t.parquet", row_group_size=50)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    df = spark.read.parquet(f"{tmp_path}/t.parquet")
    assert df.rdd.getNumPartitions() > 1
    got = {r.k: (r.s, r.n) for r in grouping.sums_in_order(df, ["k"], s=F.col("x"), n=grouping.billionths(F.col("x"))).collect()}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for key in range(3):
        stretches = [[v for k, v in enumerate(x) if k % 3 == key and k // rows == i and v is not None] for i in range(-(-400 // rows))]
        total = None
        for part in (p for p in stretches if p):
            one_by_one = 0.0
            for v in part:
                one_by_one += v
            total = one_by_one if total is None else total + one_by_one
        assert got[key] == (total, sum(round(v * 1e9) for p in stretches for v in p))


def test_share_is_rounded_as_in_sql(spark, tmp_path):
    """1407 of 3200 is 0.4396875, a tie of the sixth decimal; as doubles in order it is less."""
    table = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").where("l_suppkey = 645")
    table.coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [tuple(r) for r in parity.QUERIES["weighted_consensus"](spark, str(tmp_path)).collect()] == [(645, 0.439687, "DOWN")]


def test_small_loci_share_calls(spark):
    """300 loci of three variants and two traits are fitted in one call, each trait on its own variants and correlations."""
    ld_rows = spark.createDataFrame([(k, 3 * k + i, 3 * k + j, 0.1 * (i + j)) for k in range(300) for i, j in ((0, 1), (0, 2), (1, 2))], "locus long, i long, j long, r double")
    stats = spark.createDataFrame([(k // 3, t, k, float(k % 7) if k % 5 else None, 500) for t in "xy" for k in range(900) if t == "x" or k % 3], "locus long, trait string, variant long, z double, n int")

    calls = [0]

    def fit(key, s, r):
        if not calls[0]:
            calls[0] = uuid.uuid4().int % 2**62
        return [pd.DataFrame({"locus": key[0], "trait": key[1], "variants": [s.variant.tolist()], "r": [np.round(r, 6).ravel().tolist()], "call": calls[0]})]

    got = grouped._by_locus(stats, ld_rows, fit, "locus long, trait string, variants array<long>, r array<double>, call long").collect()
    assert len({r.call for r in got}) == 1 and len(got) == 600 - sum(all(v % 5 == 0 for v in vs) for vs in ([v for v in range(3 * k, 3 * k + 3) if t == "x" or v % 3] for k in range(300) for t in "xy"))
    for r in got:
        mine = [v for v in range(3 * r.locus, 3 * r.locus + 3) if v % 5 and (r.trait == "x" or v % 3)]
        assert r.variants == mine and r.r == [1.0 if a == b else round(0.1 * (a % 3 + b % 3), 6) for a in mine for b in mine]


@pytest.mark.parametrize("most", [1, 16])
def test_many_traits_of_a_locus_are_dealt_apart(spark, monkeypatch, most):
    monkeypatch.setattr(grouped, "TRAITS", most)
    ld_rows = spark.createDataFrame([(1, 0, 1, 0.9), (2, 0, 1, -0.9)], "locus long, i long, j long, r double")
    stats = spark.createDataFrame([(k, f"t{t}", v, 3.0, 500) for k in (1, 2) for t in range(20 if k == 1 else 1) for v in (0, 1)], "locus long, trait string, variant long, z double, n int")
    got = {(r.locus, r.trait): r.s for r in grouped.ld_mismatch(stats, ld_rows).collect()}
    want = {k: grouped.mismatch(np.array([3.0, 3.0]), np.array([[1, r], [r, 1]]), 500) for k, r in ((1, 0.9), (2, -0.9))}
    assert len(got) == 21 and all(s == pytest.approx(want[k]) for (k, _), s in got.items())


def test_pairs_of_blocks_in_one_call(spark):
    """Blocks of different samples, and loci of several blocks beside loci of one, in one call."""
    rng = np.random.default_rng(5)
    rows = [(f"l{k}", f"v{v}", s, float(rng.integers(0, 3))) for k in range(6) for v in range(1 + 2 * k) for s in range(30) if rng.random() < 0.9]
    got = {(r.locus, r.i, r.j): r.r for r in ld.ld_matrix(spark.createDataFrame(rows, "locus string, variant string, sample int, dosage double"), most_missing=0.9, block=3).collect()}
    assert len(got) == sum(n * (n - 1) // 2 for n in (1, 3, 5, 7, 9, 11))
    of = {}
    for k, v, s, x in rows:
        of.setdefault((k, v), {})[s] = x
    for (k, i, j), r in got.items():
        x, y = ({s: (v - np.mean(list(d.values()))) / np.sqrt(np.var(list(d.values())) * len(d)) for s, v in d.items()} for d in (of[k, i], of[k, j]))
        assert i < j and r == pytest.approx(sum(x[s] * y[s] for s in x if s in y))
