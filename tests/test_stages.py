import pytest

from strandspark.operators import reports
from strandspark.sources import stages

VARIANT = "VEP_ID string, LOCUS_ID string, chr string, REFERENCE_POS string, REFERENCE_REF string, REFERENCE_ALT string, PIP string, extra string"


def variants(spark, *rows):
    return spark.createDataFrame(list(rows), VARIANT)


def test_rows_that_do_not_count_go(spark):
    rows = [("a", "L", "chr1", "7.0", " a", "t", "0.5", "x"), ("b", "L", "X", "7", "A", "T", "0.5", "x"), ("c", "nan", "1", "7", "A", "T", "0.5", "x"), ("d", "L", "2", "junk", "A", "T", "0.5", "x"), ("e", "L", "3", "9", "", "T", "0.5", None), ("f", "L", "22", "9", "A", "<NA>", "0.5", None), ("g", "L", "22", "9", "A", "G", "NA", None)]
    found = stages.load(variants(spark, *rows), stages.ANNOTATED)
    assert found.columns == ["VEP_ID", "LOCUS_ID", "CHR", "REFERENCE_POS", "REFERENCE_REF", "REFERENCE_ALT", "PIP", "extra"]
    assert sorted(map(tuple, found.collect())) == [("a", "L", 1, 7, "A", "T", 0.5, "x"), ("g", "L", 22, 9, "A", "G", None, None)]
    assert [r.VEP_ID for r in stages.load(variants(spark, *rows), stages.WITH_EXPRESSION).collect()] == ["a"]


def test_one_row_a_key_with_missing_scores_last(spark):
    rows = [("a", "M", "1", "1", "A", "T", "0.9", "x"), ("a", "L", "1", "2", "A", "T", None, "x"), ("a", "L", "1", "3", "A", "T", "0.1", "y"), ("a", "L", "1", "3", "A", "T", "0.1", "x")]
    (r,) = stages.load(variants(spark, *rows), stages.ANNOTATED).collect()
    assert (r.LOCUS_ID, r.REFERENCE_POS, r.PIP, r.extra) == ("L", 3, 0.1, "x")


def test_missing_columns_and_empty_tables(spark):
    with pytest.raises(ValueError, match="PIP"):
        stages.load(variants(spark).drop("PIP"), stages.FINE_MAPPED)
    for stage in (stages.FINE_MAPPED, stages.ANNOTATED, stages.INTERPRETED):
        assert stages.load(variants(spark), stage).count() == 0
    assert stages.prioritised(stages.load(variants(spark), stages.FINE_MAPPED), 0.1).count() == 0


def test_flags_and_absent_columns(spark):
    rows = [("a", "L", "1", "1", "A", "T", "0.2", "x"), ("b", "L", "1", "2", "AC", "GT", "0.2", "x"), ("c", "M", "1", "1", "A", "T", "0.05", "x"), ("d", "M", "1", "3", "N", "T", "0.04", "x")]
    loaded = stages.load(variants(spark, *rows), stages.FINE_MAPPED)
    found = {(r.CHR, r.REFERENCE_POS): r for r in stages.prioritised(loaded, 0.1).collect()}
    assert {k: (r.LOCUS_ID, r.SELECTED_TOP_LOCUS, r.PRIORITIZED) for k, r in found.items()} == {(1, 1): ("L", True, True), (1, 2): ("L", False, True), (1, 3): ("M", False, False)}
    eligible = {r.REFERENCE_POS: (r.VALID_DNA_ALLELES, r.SPLICEAI_ALLELE_ELIGIBLE) for r in stages.splice_eligible(loaded).collect()}
    assert eligible == {1: (True, True), 2: (True, False), 3: (False, False)}
    assert [r.IN_95_CREDIBLE_SET for r in stages.load(variants(spark, rows[0]), stages.INTERPRETED).collect()] == [False]
    named = loaded.withColumnRenamed("extra", "CREDIBLE_SET")
    assert all(r.SELECTED_CREDIBLE_SET for r in stages.prioritised(named, 0.9).collect())


def test_reports_count_words_for_nothing_as_nothing(spark):
    t = spark.createDataFrame([("L", "0.5"), ("L", "NA"), ("L", "x"), ("None", "0.1"), ("", None)], "LOCUS_ID string, PIP string")
    assert sorted(map(tuple, reports.credible_sets(t).collect()), key=str) == sorted([("L", 3, 0.5, 1, 1), (None, 2, 0.1, 1, 0)], key=str)
    c = spark.createDataFrame([("L", "coding"), ("L", None), ("L", "NaN")], "LOCUS_ID string, FUNCTIONAL_CATEGORY string")
    (r,) = reports.consequences(c).collect()
    assert (r.vep_n, r.noncoding_n, r.coding_n, r.lncrna_n) == (3, 2, 1, None)
    assert reports.consequences(c.drop("FUNCTIONAL_CATEGORY")).first().noncoding_n == 3
    assert reports.consequences(c.where("false")).count() == 0


def test_best_signal_takes_missing_scores_last(spark):
    t = spark.createDataFrame([("L", "g", "eQTL", None), ("L", "h", "EQTL", 0.1), ("L", "i", "sQTL", 0.9), ("M", "j", "eqtl", None), ("L", "a", "eqtl", 0.1)], "LOCUS_ID string, gene string, QTL_TYPE string, LCLPP_MULTICAUSAL double")
    assert {(r.LOCUS_ID, r.gene) for r in reports.best_signal(t, "eqtl").collect()} == {("L", "a"), ("M", "j")}
