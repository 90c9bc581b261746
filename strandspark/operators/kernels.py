"""Statistical kernels in DataFrame operations: posteriors, enrichment, credible sets."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify
from . import grouped
from .graphs import _saved

#: Prior probabilities: one trait, other trait, both; with the two settings that test sensitivity.
P1, P2 = 1e-4, 1e-4
PRIORS = (("LOW", 1e-6), ("DEFAULT", 5e-6), ("HIGH", 1e-5))


def log_sum_exp(x: Column, top: Column) -> Column:
    """Aggregate ln(sum(exp(x))), with top the greatest x of the group."""
    return top + F.ln(F.sum(F.exp(x - top)))


def log_minus(a: Column, b: Column) -> Column:
    """ln(exp(a) - exp(b)) for a >= b, minus infinity where they are equal."""
    d = b - a
    return F.when(d < 0, a + F.ln(1 - F.exp(F.least(d, F.lit(-1e-300))))).otherwise(F.lit(float("-inf")))


def colocalise(pairs: DataFrame, keys: Sequence[str], a: str, b: str, priors=PRIORS) -> DataFrame:
    """Posterior of five hypotheses per key and prior from log Bayes factors a and b of common variants
    (one row per variant): two grouped passes and closed forms, nothing leaves the JVM."""
    top = pairs.groupBy(*keys).agg(F.max(a).alias("_ta"), F.max(b).alias("_tb"), F.max(F.col(a) + F.col(b)).alias("_tc"))
    rows = pairs.join(top, list(keys))
    tops = ("_ta", "_tb", "_tc")
    sums = rows.groupBy(*keys, *tops).agg(F.count("*").alias("n_common"), log_sum_exp(F.col(a), F.col("_ta")).alias("_a"), log_sum_exp(F.col(b), F.col("_tb")).alias("_b"), log_sum_exp(F.col(a) + F.col(b), F.col("_tc")).alias("_c"))
    setting = F.explode(F.array(*(F.struct(F.lit(n).alias("prior"), F.lit(p).alias("p12")) for n, p in priors))).alias("s")
    grid = sums.select("*", setting).select(*keys, "n_common", "_a", "_b", "_c", "s.prior", "s.p12")
    logs = [F.lit(0.0), F.ln(F.lit(P1)) + F.col("_a"), F.ln(F.lit(P2)) + F.col("_b"), F.ln(F.lit(P1)) + F.ln(F.lit(P2)) + log_minus(F.col("_a") + F.col("_b"), F.col("_c")), F.ln(F.col("p12")) + F.col("_c")]
    for k, x in enumerate(logs):
        grid = grid.withColumn(f"_l{k}", x)
    most = F.greatest(*(F.col(f"_l{k}") for k in range(5)))
    grid = grid.withColumn("_m", most)
    total = sum((F.exp(F.col(f"_l{k}") - F.col("_m")) for k in range(1, 5)), F.exp(F.col("_l0") - F.col("_m")))
    return grid.withColumn("_t", total).select(*keys, "prior", "n_common", *((F.exp(F.col(f"_l{k}") - F.col("_m")) / F.col("_t")).alias(f"h{k}") for k in range(5)))


#: Variants that both sides must share at least, and at most: beyond that a pair is not tested, never thinned.
COMMON_VARIANTS = (100, 12_000)


def testable_pairs(loci: DataFrame, gwas: DataFrame, qtl: DataFrame, ld: DataFrame, common: tuple[int, int] = COMMON_VARIANTS) -> DataFrame:
    """Per row of loci (locus, trait): n_qtl, n_common, n_in_ld and a status, TESTED or the first reason why not.

    gwas has locus, variant, z, n, case_control, n_cases, n_controls; qtl has locus, trait, variant, z, n; ld has locus,
    i, j, r. A variant counts once, where its z is known; n_in_ld counts those with a correlation to any other."""
    # All by locus and variant in as many tasks as a shuffle has, which Spark would else put together by their packed size: repeated
    # rows, joins and counts are then settled where rows arrive first, with few of them in memory.
    dealt = lambda df: df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "locus", "variant")
    known = dealt(qtl.where("z IS NOT NULL").select("locus", "trait", "variant", F.col("n").alias("qn"))).groupBy("locus", "trait", "variant").agg(F.max("qn").alias("qn"))
    mine = dealt(gwas.where("z IS NOT NULL").select("locus", "variant", "n", "case_control", "n_cases", "n_controls")).groupBy("locus", "variant")
    mine = mine.agg(F.max("n").alias("gn"), F.bool_or("case_control").alias("case_control"), F.min("n_cases").alias("n_cases"), F.min("n_controls").alias("n_controls"))
    linked = ld.select("locus", F.explode(F.array("i", "j")).alias("variant")).distinct().withColumn("in_ld", F.lit(True))
    both = known.join(mine.withColumn("shared", F.lit(True)), ["locus", "variant"], "left").join(linked, ["locus", "variant"], "left")
    counts = both.groupBy("locus", "trait").agg(
        F.count("*").alias("n_qtl"), F.max("qn").alias("qn"), F.count("shared").alias("n_common"), F.count_if(F.col("shared") & F.col("in_ld")).alias("n_in_ld"),
        F.max("gn").alias("gn"), F.bool_or("case_control").alias("cc"), F.min("n_cases").alias("cases"), F.min("n_controls").alias("controls"),
    )
    every = loci.select("locus", "trait").distinct().join(counts, ["locus", "trait"], "left").fillna(0, ["n_qtl", "n_common", "n_in_ld"])
    least, most = common
    status = classify.first_failure(
        (
            (F.col("n_qtl") == 0, "NOT_TESTED_NO_DENSE_QTL_ROWS"),
            (F.col("qn").isNull(), "NOT_TESTED_QTL_SAMPLE_SIZE_MISSING"),
            (F.col("n_common") < least, "NOT_TESTED_TOO_FEW_COMMON_SNPS"),
            (F.col("n_common") > most, "NOT_TESTED_TOO_MANY_COMMON_SNPS_NO_SUBSAMPLING"),
            (F.col("gn").isNull(), "NOT_TESTED_GWAS_SAMPLE_SIZE_MISSING"),
            (F.col("cc") & (F.col("cases").isNull() | F.col("controls").isNull()), "NOT_TESTED_CASE_CONTROL_COUNTS_MISSING"),
            (F.col("n_in_ld") < least, "NOT_TESTED_TOO_FEW_SNPS_AFTER_LD_OR_MAF"),
        ),
        "TESTED",
    )
    return every.select("locus", "trait", "n_qtl", "n_common", "n_in_ld", status.alias("status"))


def filled_frequencies(qtl: DataFrame, panel: DataFrame) -> DataFrame:
    """qtl (locus, variant, maf, ...) with minor allele frequencies: its own, folded, where above 0 and below 0.5, else that
    of panel (locus, variant, maf), marked by from_panel. Rows without either go."""
    folded = F.least("maf", 1 - F.col("maf"))
    own = qtl.withColumn("maf", F.when((folded > 0) & (folded < 0.5), folded))
    known = panel.where("maf IS NOT NULL").groupBy("locus", "variant").agg(F.min(F.least("maf", 1 - F.col("maf"))).alias("_panel"))
    both = own.join(known, ["locus", "variant"], "left").withColumn("from_panel", F.col("maf").isNull())
    return both.withColumn("maf", F.coalesce("maf", "_panel")).where("maf IS NOT NULL").drop("_panel")


def _sides(loci: DataFrame, gwas: DataFrame, qtl: DataFrame, ld: DataFrame, common: tuple[int, int]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs with their status, and the statistics of both sides of those that are tested, on variants with correlations."""
    pairs = _saved(testable_pairs(loci, gwas, qtl, ld, common))
    tested = pairs.where("status = 'TESTED'").select("locus", "trait")
    linked = ld.select("locus", F.explode(F.array("i", "j")).alias("variant")).distinct()
    left = gwas.join(tested.select("locus").distinct(), "locus", "left_semi").join(linked, ["locus", "variant"], "left_semi").select("locus", F.lit("").alias("trait"), "variant", "z", "n").dropDuplicates(["locus", "variant"])
    right = qtl.join(tested, ["locus", "trait"], "left_semi").join(linked, ["locus", "variant"], "left_semi").select("locus", "trait", "variant", "z", "n").dropDuplicates(["locus", "trait", "variant"])
    return pairs, left, right


def colocalise_signals(loci: DataFrame, gwas: DataFrame, qtl: DataFrame, ld: DataFrame, common: tuple[int, int] = COMMON_VARIANTS, fits: DataFrame | None = None, **fit) -> DataFrame:
    """Colocalisation of every pair of credible sets of two sides, each fine mapped over its variants with correlations:
    locus, trait, status, hit1, hit2, prior, n_common, h0 to h4. A pair that is not tested has one row with its reason, one
    that was tested but has no set on a side one row with NOT_TESTED_NO_CREDIBLE_SET. Tables as in testable_pairs. fits (locus,
    component, variant, lbf) are fits of the first side at hand; a locus that is not among them is NOT_TESTED_GWAS_FIT_MISSING."""
    pairs, left, right = _sides(loci, gwas, qtl, ld, common)
    pairs = pairs.select("locus", "trait", "status")
    if fits is not None:
        pairs = pairs.join(fits.select("locus").distinct().withColumn("fitted", F.lit(True)), "locus", "left")
        pairs = pairs.select("locus", "trait", F.when((F.col("status") == "TESTED") & F.col("fitted").isNull(), "NOT_TESTED_GWAS_FIT_MISSING").otherwise(F.col("status")).alias("status"))
    a = (fits if fits is not None else grouped.signals(left, ld, **fit)).select("locus", "variant", F.col("component").alias("hit1"), F.col("lbf").alias("a"))
    b = grouped.signals(right, ld, **fit).select("locus", "trait", "variant", F.col("component").alias("hit2"), F.col("lbf").alias("b"))
    found = colocalise(b.join(a, ["locus", "variant"]), ["locus", "trait", "hit1", "hit2"], "a", "b")
    joined = pairs.join(found, ["locus", "trait"], "left")
    return joined.withColumn("status", F.when((F.col("status") == "TESTED") & F.col("hit1").isNull(), "NOT_TESTED_NO_CREDIBLE_SET").otherwise(F.col("status")))


#: Mismatch of z scores and correlations from which a result carries a warning.
MOST_MISMATCH = 0.1


def colocalisation_report(loci: DataFrame, gwas: DataFrame, qtl: DataFrame, ld: DataFrame, panel: DataFrame | None = None, common: tuple[int, int] = COMMON_VARIANTS, most_mismatch: float = MOST_MISMATCH, strong: float = 0.8, suggestive: float = 0.5, fits: DataFrame | None = None, **fit) -> DataFrame:
    """One row per pair (locus, trait): status; hit1, hit2 and h0 to h4 of the pair of signals with the greatest H4 under the
    default prior, H4 of that same pair under the others, its class and whether the low prior reaches strong; s of either
    side and ld_mismatch_warning if one is above most_mismatch; and, with a panel (locus, variant, maf; qtl then has maf
    too), how many frequencies came from it. Pairs that end without signals are COMPLETE_NO_SIGNAL_PAIR."""
    if panel is not None:
        filled = filled_frequencies(qtl, panel)
        used, qtl = filled.groupBy("locus", "trait").agg(F.count_if("from_panel").alias("n_from_panel"), F.count("*").alias("_n")), filled.drop("from_panel")
    # Each is read several times: by both fits, by both checks and by the counts of variants.
    gwas, qtl, ld = _saved(gwas), _saved(qtl), _saved(ld)
    _, left, right = _sides(loci, gwas, qtl, ld, common)
    found = _saved(colocalise_signals(loci, gwas, qtl, ld, common, fits, **fit))
    keys = ["locus", "trait"]
    best = F.max_by(F.struct("hit1", "hit2"), F.struct("h4", -F.col("hit1"), -F.col("hit2")))
    chosen = found.where("prior = 'DEFAULT'").groupBy(*keys).agg(best.alias("hit")).select(*keys, "hit.hit1", "hit.hit2")
    of_pair = found.join(chosen, [*keys, "hit1", "hit2"]).groupBy(*keys, "hit1", "hit2", "n_common")
    values = of_pair.agg(*(F.max(F.when(F.col("prior") == "DEFAULT", F.col(f"h{k}"))).alias(f"h{k}") for k in range(5)), *(F.max(F.when(F.col("prior") == p, F.col("h4"))).alias(f"h4_{p.lower()}") for p in ("LOW", "HIGH")))
    status = found.groupBy(*keys).agg(F.first("status").alias("status"))
    status = status.withColumn("status", F.when(F.col("status") == "TESTED", "COMPLETE").when(F.col("status") == "NOT_TESTED_NO_CREDIBLE_SET", "COMPLETE_NO_SIGNAL_PAIR").otherwise(F.col("status")))
    s1 = grouped.ld_mismatch(left, ld).select("locus", F.col("s").alias("gwas_s"))
    s2 = grouped.ld_mismatch(right, ld).select(*keys, F.col("s").alias("qtl_s"))
    tested = F.col("status").startswith("COMPLETE")
    out = status.join(values, keys, "left").join(s1, "locus", "left").join(s2, keys, "left").withColumn("gwas_s", F.when(tested, F.col("gwas_s")))
    out = out.withColumn("coloc_class", F.when(tested, classify.colocalisation_class(tuple(F.col(f"h{k}") for k in range(5)), strong, suggestive, strict=True)))
    out = out.withColumn("prior_robust", F.when(tested, F.coalesce(F.col("h4_low") >= strong, F.lit(False)))).withColumn("ld_mismatch_warning", F.coalesce(F.greatest("gwas_s", "qtl_s") > most_mismatch, F.lit(False)))
    if panel is None:
        return out
    source = F.when(F.col("n_from_panel") == 0, "QTL_FILE").when(F.col("n_from_panel") == F.col("_n"), "PANEL").when(F.col("_n") > 0, "QTL_FILE+PANEL")
    return out.join(used, keys, "left").withColumn("maf_source", source).drop("_n")


def prior_sensitivity(posteriors: DataFrame, keys: Sequence[str], strong: float = 0.8) -> DataFrame:
    """H4 under each prior side by side; simple: the low prior reaches strong; strict: all do."""
    wide = posteriors.groupBy(*keys).agg(*(F.max(F.when(F.col("prior") == n, F.col("h4"))).alias(f"h4_{n.lower()}") for n, _ in PRIORS))
    low = F.least(*(F.col(f"h4_{n.lower()}") for n, _ in PRIORS))
    return wide.withColumn("robust_simple", F.col("h4_low") >= strong).withColumn("robust_strict", low >= strong)


def credible_set(df: DataFrame, keys: Sequence[str], probability: str, tie: str, coverage: float = 0.95) -> DataFrame:
    """df with rank, cumulative probability and in_set: by falling probability until coverage is reached."""
    w = Window.partitionBy(*keys).orderBy(F.col(probability).desc_nulls_last(), F.col(tie))
    before = F.coalesce(F.sum(probability).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return df.withColumn("rank", F.row_number().over(w)).withColumn("cumulative", before + F.col(probability)).withColumn("in_set", before < coverage)


def inclusion_probability(alpha: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """1 - prod(1 - alpha) over the components of each key; a component at 1 gives 1."""
    a = F.col(column)
    return alpha.groupBy(*keys).agg(F.when(F.max(a) >= 1, 1.0).otherwise(1 - F.exp(F.sum(F.ln(F.when(a < 1, 1 - a))))).alias("pip"))


#: ln(n!) comes from a table below this, and from the series of ln gamma (next term below 1e-13) from here on.
SERIES_FROM = 12


def log_factorial(n: Column) -> Column:
    """ln(n!) of any whole number, in columns alone."""
    table = F.array(*(F.lit(math.lgamma(k + 1)) for k in range(SERIES_FROM)))
    x = (n + 1).cast("double")
    square = x * x
    series = (x - 0.5) * F.ln(x) - x + 0.5 * math.log(2 * math.pi) + (1 / 12.0 - (1 / 360.0 - (1 / 1260.0 - 1 / 1680.0 / square) / square) / square) / x
    return F.when(n < SERIES_FROM, F.get(table, n.cast("int"))).otherwise(series)


def hypergeometric_tail(df: DataFrame, population: str, successes: str, draws: str, hits: str, into: str = "p_value") -> DataFrame:
    """P(X >= hits) per row, for populations of any size: the greatest term from log factorials, each further one by its
    ratio to the one beside it. Terms lie within 40 standard deviations of hits or of the mode, whichever is greater; what
    lies beyond is less than a double can add."""
    m, k, n, x = (F.col(c).cast("long") for c in (population, successes, draws, hits))
    low, high = F.greatest(x, n + k - m, F.lit(0).cast("long")), F.least(k, n)
    mode = F.floor((n + 1) * (k + 1) / (m + 2)).cast("long")
    wide = (40 * F.sqrt(F.least(k, n).cast("double")) + 40).cast("long")
    start, end = F.greatest(low, mode - wide), F.least(high, F.greatest(low, mode) + wide)
    choose = lambda a, b: log_factorial(a) - log_factorial(b) - log_factorial(a - b)
    ratio = lambda i: ((k - i).cast("double") * (n - i)) / ((i + 1).cast("double") * (m - k - n + i + 1))
    # Sums begin at the greatest term and go both ways, so that none is lost to an exponent too small for a double.
    top = F.least(F.greatest(mode, start), end)
    peak = F.exp(choose(k, top) + choose(m - k, n - top) - choose(m, n))
    pair = lambda term, total: F.struct(term.alias("t"), total.alias("s"))
    up = F.when(top < end, F.sequence(top, end - 1)).otherwise(F.array().cast("array<bigint>"))
    down = F.when(start < top, F.sequence(top - 1, start)).otherwise(F.array().cast("array<bigint>"))
    above = F.aggregate(up, pair(peak, peak), lambda acc, i: pair(acc["t"] * ratio(i), acc["s"] + acc["t"] * ratio(i)), lambda acc: acc["s"])
    below = F.aggregate(down, pair(peak, F.lit(0.0)), lambda acc, i: pair(acc["t"] / ratio(i), acc["s"] + acc["t"] / ratio(i)), lambda acc: acc["s"])
    return df.withColumn(into, F.when(low > high, F.lit(0.0)).otherwise(F.least(F.lit(1.0), above + below)))


def pathway_filter(fdr: Column, overlap: Column, size: Column, most_fdr: float = 0.05, least_overlap: int = 2, least: int = 5, most: int = 500) -> Column:
    return F.coalesce((fdr <= most_fdr) & (overlap >= least_overlap), F.lit(False)) & F.coalesce(size.between(least, most), F.lit(True))


def undirected_edges(edges: DataFrame, a: str, b: str, score: str) -> DataFrame:
    """a < b, self-loops gone, the greatest score of repeated edges, distance max(1e-6, 1 - score)."""
    return edges.where(F.col(a) != F.col(b)).groupBy(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).agg(F.max(score).alias("score")).withColumn("distance", F.greatest(F.lit(1e-6), 1 - F.col("score")))


def degrees(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("node"), "score").unionByName(edges.select(F.col("b").alias("node"), "score"))
    return both.groupBy("node").agg(F.count("*").alias("degree"), F.sum("score").alias("weighted_degree"))


def connectors(edges: DataFrame, classes: DataFrame) -> DataFrame:
    """Nodes outside classes (node, class) that touch members of them: distinct neighbours of each
    class and in all; is_bridge if of two classes or more."""
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    touched = both.join(classes.select(F.col("node").alias("other"), "class"), "other").join(classes.select("node"), "node", "left_anti")
    return touched.groupBy("node").agg(F.count_distinct("other").alias("n_seeds"), F.count_distinct("class").alias("n_classes")).withColumn("is_bridge", F.col("n_classes") >= 2)
