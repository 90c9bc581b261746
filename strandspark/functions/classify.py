"""Classes, tiers and scores as CASE chains. Thresholds are inclusive unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Consequence terms by functional category, first match wins.
SPLICING_TERMS = (
    "splice_acceptor_variant", "splice_donor_variant", "splice_region_variant", "splice_donor_5th_base_variant", "splice_donor_region_variant",
    "splice_polypyrimidine_tract_variant",
)
CODING_TERMS = (
    "transcript_ablation", "stop_gained", "frameshift_variant", "stop_lost", "start_lost", "transcript_amplification", "inframe_insertion", "inframe_deletion",
    "missense_variant", "protein_altering_variant", "coding_sequence_variant", "synonymous_variant", "start_retained_variant", "stop_retained_variant",
    "incomplete_terminal_codon_variant",
)
UTR_TERMS = ("5_prime_utr_variant", "3_prime_utr_variant")
NONCODING_BIOTYPES = ("lncrna", "lincrna", "mirna", "snrna", "snorna", "rrna", "ncrna", "antisense", "processed_transcript")
# Parts of terms that stand for regulation: of the whole text, and of single terms.
REGULATORY_IN_TEXT = ("regulatory_region", "tf_binding_site")
REGULATORY_IN_TERM = ("regulatory", "tf_binding", "tfbs")
PLACES = (("intron_variant", "INTRONIC"), ("upstream_gene_variant", "UPSTREAM"), ("downstream_gene_variant", "DOWNSTREAM"), ("intergenic_variant", "INTERGENIC"))
# Terms and biotypes by variant context.
TRUNCATING_TERMS = ("transcript_ablation", "splice_acceptor_variant", "splice_donor_variant", "stop_gained", "frameshift_variant", "start_lost")
MISSENSE_TERMS = ("missense_variant", "protein_altering_variant", "inframe_insertion", "inframe_deletion")
SYNONYMOUS_TERMS = ("synonymous_variant", "start_retained_variant", "stop_retained_variant")
CONTEXT_REGULATORY_TERMS = ("regulatory_region_variant", "tf_binding_site_variant", "upstream_gene_variant", "downstream_gene_variant")
CONTEXT_NONCODING_BIOTYPES = ("lncrna", "lincrna", "antisense", "processed_transcript", "mirna", "snrna", "snorna", "rrna", "misc_rna", "non_coding")
# Gene types by class.
LNC_TYPES = ("lncrna", "lincrna", "antisense", "processed_transcript", "sense_intronic", "sense_overlapping", "macro_lncrna", "bidirectional_promoter_lncrna", "3prime_overlapping_ncrna")
OTHER_NC_TYPES = ("mirna", "snrna", "snorna", "rrna", "scrna", "vault_rna", "misc_rna", "ribozyme", "srna", "trna", "mt_trna", "mt_rrna")
GENE_CLASSES = ("PROTEIN_CODING", "LNCRNA", "OTHER_NCRNA", "OTHER_GENE_TYPE")
HYPOTHESES = ("H0", "H1", "H2", "H3", "H4")
# Names of the favoured hypothesis below both thresholds.
FAVOURED = ("NEITHER_ASSOCIATED_FAVORED", "GWAS_ONLY_FAVORED", "QTL_ONLY_FAVORED", "BOTH_ASSOCIATED_DIFFERENT_SIGNALS_FAVORED", "SHARED_SIGNAL_FAVORED_BELOW_THRESHOLD")


def terms_of(*texts: Column) -> Column:
    """Lower-cased terms of lists separated by , ; or &, of all texts; NULL texts have none."""
    every = F.concat_ws(",", *texts)
    return F.filter(F.transform(F.split(F.lower(every), "[,;&]"), lambda t: F.trim(t)), lambda t: t != "")


def _holds(text: Column, parts: tuple[str, ...]) -> Column:
    """Whether the text contains one of these; false for NULL."""
    out = F.lit(False)
    for part in parts:
        out = out | F.contains(F.coalesce(text, F.lit("")), F.lit(part))
    return out


def _any(terms: Column, of: tuple[str, ...]) -> Column:
    return F.arrays_overlap(terms, F.array(*map(F.lit, of)))


def functional_category(consequence: Column, biotype: Column | None = None, exact: bool = True) -> Column:
    """SPLICING, CODING, UTR, REGULATORY, NONCODING_RNA, INTRONIC, UPSTREAM, DOWNSTREAM, INTERGENIC or OTHER, the
    first that fits. exact compares whole terms, else the text is searched for them; both rules are in use. A biotype
    of non-coding RNA counts after the regulatory terms."""
    text = F.lower(F.coalesce(consequence, F.lit("")))
    terms = terms_of(consequence)
    noncoding = F.lit(False) if biotype is None else _holds(F.lower(biotype), NONCODING_BIOTYPES)
    if exact:
        fits = lambda of: _any(terms, of)
        regulatory = F.exists(terms, lambda t: _holds(t, REGULATORY_IN_TERM))
        transcript = F.exists(terms, lambda t: F.contains(t, F.lit("non_coding_transcript")))
    else:
        fits = lambda of: _holds(text, of)
        regulatory, transcript = _holds(text, REGULATORY_IN_TEXT), _holds(text, ("non_coding_transcript",))
    out = F.when(fits(SPLICING_TERMS), "SPLICING").when(fits(CODING_TERMS), "CODING").when(fits(UTR_TERMS), "UTR").when(regulatory, "REGULATORY").when(transcript | noncoding, "NONCODING_RNA")
    for term, name in PLACES:
        out = out.when(fits((term,)), name)
    return out.otherwise("OTHER")


def variant_context(terms: Column, biotype: Column, category: Column) -> Column:
    """What a variant does, by its terms (terms_of), then by biotype and functional category."""
    category = F.upper(F.coalesce(category, F.lit("")))
    return (
        F.when(_any(terms, TRUNCATING_TERMS), "CODING_PTV_OR_CANONICAL_SPLICE")
        .when(_any(terms, MISSENSE_TERMS), "CODING_MISSENSE_OR_PROTEIN_ALTERING")
        .when(_any(terms, SYNONYMOUS_TERMS), "CODING_SYNONYMOUS")
        .when(_any(terms, SPLICING_TERMS), "SPLICE_REGION")
        .when(_any(terms, UTR_TERMS), "UTR")
        .when((category == "NONCODING_RNA") | _holds(F.lower(biotype), CONTEXT_NONCODING_BIOTYPES), "NONCODING_RNA")
        .when((category == "REGULATORY") | _any(terms, CONTEXT_REGULATORY_TERMS), "REGULATORY")
        .when(F.array_contains(terms, "intron_variant"), "INTRONIC")
        .when(F.array_contains(terms, "intergenic_variant"), "INTERGENIC")
        .when(category == "CODING", "CODING_OTHER")
        .when(category == "SPLICING", "SPLICING_OTHER")
        .otherwise("OTHER_OR_UNRESOLVED")
    )


def gene_class(gene_type: Column) -> Column:
    """Class of one gene type; NULL for a NULL or empty one."""
    low = F.lower(F.trim(gene_type))
    return F.when(low == "protein_coding", GENE_CLASSES[0]).when(_holds(low, LNC_TYPES), GENE_CLASSES[1]).when(_holds(low, OTHER_NC_TYPES), GENE_CLASSES[2]).when(low != "", GENE_CLASSES[3])


def genomic_context(features: Column, gene_types: Column, gene_names: Column) -> Column:
    """struct(context, coding, classes) of what overlaps a place (arrays, as collect_set gives them): coding sequence before
    untranslated region, exon, gene body and nothing, crossed with the classes of the genes."""
    found = F.transform(gene_types, gene_class)
    classes = F.filter(F.array(*map(F.lit, GENE_CLASSES)), lambda c: F.array_contains(F.array_compact(found), c))
    protein, lnc, other = (F.array_contains(classes, c) for c in GENE_CLASSES[:3])
    has = lambda f: F.array_contains(features, f)
    coding = has("CDS") & protein
    exon = F.when(lnc, "LNCRNA_EXON").when(other, "OTHER_NCRNA_EXON").when(protein, "NON_CDS_EXON_PROTEIN_CODING_GENE").otherwise("EXON_OTHER_GENE")
    body = F.when(lnc, "LNCRNA_GENE_BODY_INTRONIC_OR_OTHER").when(other, "OTHER_NCRNA_GENE_BODY").when(protein, "INTRONIC_PROTEIN_CODING_GENE").otherwise("OTHER_GENE_BODY")
    context = F.when(coding, "CODING_CDS").when(has("UTR") & protein, "UTR_PROTEIN_CODING_GENE").when(has("exon"), exon).when((F.size(gene_names) > 0) | (F.size(gene_types) > 0), body).otherwise("INTERGENIC")
    joined = F.when(F.size(classes) > 0, F.array_join(classes, ";")).otherwise("NO_GENE")
    return F.struct(context.alias("context"), F.when(coding, "CODING").otherwise("NONCODING").alias("coding"), joined.alias("classes"))


def allele_check(rsid: Column, mappings: Column, chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """struct(status, reference, alternatives): alleles against the first mapping of a JSON list (assembly_name,
    seq_region_name, start, allele_string) on the same place of the current assembly."""
    empty = F.lit("")
    kind = "array<struct<assembly_name:string,seq_region_name:string,start:string,allele_string:string>>"
    parsed = F.from_json(mappings, kind)
    here = F.filter(parsed, lambda m: m.isNotNull() & F.upper(m["assembly_name"]).startswith("GRCH38") & (F.replace(m["seq_region_name"], F.lit("chr"), empty) == F.trim(F.replace(chrom, F.lit("chr"), empty))) & (m["start"].try_cast("long") == pos))
    alleles = F.filter(F.transform(F.split(F.coalesce(F.try_element_at(here, F.lit(1))["allele_string"], empty), "/"), lambda x: F.trim(F.upper(x))), lambda x: x != "")
    first, others = F.try_element_at(alleles, F.lit(1)), F.slice(alleles, 2, F.greatest(F.size(alleles), F.lit(1)))
    r, a = (F.trim(F.upper(F.coalesce(x, empty))) for x in (ref, alt))
    text = F.trim(F.coalesce(mappings, empty))
    status = (
        F.when(F.trim(F.coalesce(rsid, empty)) == "", "NO_RSID")
        .when((text == "") | text.startswith("{"), "NO_MAPPING")
        .when(parsed.isNull(), "MAPPING_PARSE_ERROR")
        .when(F.coalesce(F.size(here), F.lit(0)) < 1, "NO_GRCH38_POSITION_MATCH")
        .when(F.size(alleles) == 0, "NO_ALLELE_STRING")
        .when((r == first) & F.array_contains(others, a), "PASS")
        .when((a == first) & F.array_contains(others, r), "REF_ALT_SWAPPED")
        .when(F.array_contains(alleles, r) & F.array_contains(alleles, a), "ALLELES_PRESENT_REFERENCE_MISMATCH")
        .otherwise("ALLELE_NOT_IN_RSID_MAPPING")
    )
    known = status.isin("PASS", "REF_ALT_SWAPPED", "ALLELES_PRESENT_REFERENCE_MISMATCH", "ALLELE_NOT_IN_RSID_MAPPING")
    return F.struct(status.alias("status"), F.when(known, first).otherwise(empty).alias("reference"), F.when(known, F.array_join(others, ";")).otherwise(empty).alias("alternatives"))


def first_containing(text: Column, rules: tuple[tuple[str, str], ...], default: str) -> Column:
    """By substrings of the whole text, the first rule that fits."""
    out = F.lit(default)
    for part, name in reversed(rules):
        out = F.when(F.contains(F.lower(text), F.lit(part)), name).otherwise(out)
    return out


def score_class(score: Column, high: float = 0.8, medium: float = 0.5, low: float = 0.2) -> Column:
    return F.when(score.isNull(), "NOT_SCORED").when(score >= high, "HIGH").when(score >= medium, "MODERATE").when(score >= low, "LOW").otherwise("NEGLIGIBLE")


def dominant(*values: Column) -> Column:
    """The name of the greatest posterior, the first of equal ones; H0 if all are NULL."""
    known = [F.coalesce(v, F.lit(-1.0)) for v in values]
    out, best = F.lit(None).cast("string"), F.greatest(*known)
    for name, v in reversed(list(zip(HYPOTHESES, known, strict=True))):
        out = F.when(v == best, name).otherwise(out)
    return out


def colocalisation_class(h: tuple[Column, ...], strong: float = 0.8, suggestive: float = 0.5, strict: bool = False) -> Column:
    """One of the two rules in use. strict: strong also needs H4 above H3 (or no H3), and below both thresholds only
    H3 above H4 is named; else the favoured hypothesis is."""
    h3, h4 = h[3], h[4]
    if strict:
        out = F.when(h4.isNull(), "NO_PP_H4_RETURNED").when((h4 >= strong) & (h3.isNull() | (h4 > h3)), "STRONG_SHARED_SIGNAL").when(h4 >= suggestive, "SUGGESTIVE_SHARED_SIGNAL")
        return out.when(h3 > h4, FAVOURED[3]).otherwise("NO_STRONG_SHARED_SIGNAL")
    out, favoured = F.when(h4 >= strong, "STRONG_SHARED_SIGNAL").when(h4 >= suggestive, "SUGGESTIVE_SHARED_SIGNAL"), dominant(*h)
    for name, label in zip(HYPOTHESES, FAVOURED, strict=True):
        out = out.when(favoured == name, label)
    return out


def robust_prior(low: Column, default: Column, high: Column, strong: float = 0.8, strict: bool = True) -> Column:
    """strict: all three priors reach strong; simple: the lowest prior alone decides."""
    return F.coalesce((F.least(low, default, high) if strict else low) >= strong, F.lit(False))


def evidence_tier(best: Column, robust: Column, shared: Column, strong_types: Column, strong: float = 0.8, suggestive: float = 0.5) -> Column:
    return (
        F.when((best >= strong) & robust & (strong_types >= 2), "TIER_1")
        .when((best >= strong) & (robust | (shared >= 2)), "TIER_2")
        .when(best >= strong, "TIER_3")
        .when(best >= suggestive, "TIER_4")
        .otherwise("TIER_5")
    )


def priority_tier(score: Column, edges: tuple[float, ...] = (35, 50, 65, 80)) -> Column:
    """Right-closed bins: a score on an edge belongs below it."""
    out = F.lit(f"P{len(edges) + 1}")
    for k, edge in reversed(list(enumerate(edges, 1))):
        out = F.when(score <= edge, f"P{k}").otherwise(out)
    return out


def clipped(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), x))


def gene_score(h4: Column, robust: Column, n_types: Column, n_loci: Column, n_studies: Column) -> Column:
    return (
        h4
        + 0.15 * robust.cast("int")
        + 0.08 * F.greatest(F.lit(0), F.least(n_types - 1, F.lit(4)))
        + 0.06 * F.log1p(F.greatest(F.lit(0), n_loci - 1).cast("double"))
        + 0.04 * F.log1p(F.greatest(F.lit(0), n_studies - 1).cast("double"))
    )


def therapeutic_priority(h4: Column, robust: Column, multi: Column, external: Column, replicated: Column, n_tractable: Column, approved: Column, phase: Column, network: Column, hub: Column, direction: Column, consistent: Column) -> Column:
    """genetic 35 H4 + 5 + 5, external 7 + 3, tractability 3.5 min(n, 2) + 3 + 10 phase / 4,
    network 7 pct + 3, direction 5 + 10; 0 to 100."""
    on = lambda c, points: F.when(c, points).otherwise(0)
    total = 35 * clipped(h4, 0, 1) + on(robust, 5) + on(multi, 5) + on(external, 7) + on(replicated, 3) + 3.5 * F.least(n_tractable, F.lit(2)) + on(approved, 3) + 10 * clipped(phase, 0, 4) / 4 + 7 * clipped(network, 0, 1) + on(hub, 3) + on(direction, 5) + on(consistent, 10)
    return clipped(total, 0, 100)


def final_score(h4: Column, robust: Column, multi: Column, fine: Column, external: Column, replicated: Column, n_pathways: Column, top_pathway: Column, in_network: Column, network: Column, connector: Column, target: Column, tractable: Column, drug: Column, direction: Column, consistent: Column) -> Column:
    """genetic 30 H4 + 5 + 5 + 5, external 10 + 5, pathway 10 min(n, 5) / 5 + 5, network 4 + 4 pct + 2,
    therapeutic 3 + 3 + 4, direction 2 + 3; 0 to 100."""
    on = lambda c, points: F.when(c, points).otherwise(0)
    total = 30 * clipped(h4, 0, 1) + on(robust, 5) + on(multi, 5) + on(fine, 5) + on(external, 10) + on(replicated, 5) + 10 * F.least(n_pathways, F.lit(5)) / 5 + on(top_pathway, 5) + on(in_network, 4) + 4 * clipped(network, 0, 1) + on(connector, 2) + on(target, 3) + on(tractable, 3) + on(drug, 4) + on(direction, 2) + on(consistent, 3)
    return clipped(total, 0, 100)


def mechanism(axes: tuple[tuple[Column, str], ...]) -> Column:
    """struct(axes, class): names of the flags that hold, and the single one, MULTI_MECHANISM or UNRESOLVED."""
    held = F.array_compact(F.array(*(F.when(flag, F.lit(name)) for flag, name in axes)))
    return F.struct(F.array_join(held, ";").alias("axes"), F.when(F.size(held) >= 2, "MULTI_MECHANISM").when(F.size(held) == 1, F.try_element_at(held, F.lit(1))).otherwise("UNRESOLVED").alias("class"))


def first_failure(rules: tuple[tuple[Column, str], ...], passed: str = "PASS") -> Column:
    """The code of the first rule that is true; unknown (NULL) conditions don't count."""
    out = F.lit(passed)
    for bad, code in reversed(rules):
        out = F.when(bad.eqNullSafe(True), code).otherwise(out)
    return out


def joined_reasons(*parts: tuple[Column, Column], separator: str = "; ") -> Column:
    """Texts whose condition holds, in order, joined."""
    return F.array_join(F.array_compact(F.array(*(F.when(flag, text) for flag, text in parts))), separator)


def direction(gwas: Column, qtl: Column) -> Column:
    s = F.signum(gwas * qtl)
    return F.when(s > 0, "INHIBIT").when(s < 0, "ACTIVATE")


# What a context or class of variants still asks for, in the order of the report. A need is left out
# where its resource is at hand; two of them are asked for whatever is at hand.
CODING_RESOURCES = (("CLINVAR", "CLINVAR"), ("CADD", "CADD"))
GENERAL_RESOURCES = (("MENDELIAN", "MENDELIAN_GENE_DISEASE_RESOURCE"), ("GENE_CONSTRAINT", "GNOMAD_GENE_CONSTRAINT"))
COLOCALISED_CLASSES = ("EXPRESSION_MEDIATED", "EXPRESSION_MEDIATED_NONCODING", "SPLICING_MEDIATED", "MULTI_MECHANISM")


def followups(context: Column, mechanism_class: Column, at_hand: Column) -> Column:
    """What a variant still needs, joined by ";", given the names of the resources at hand (an array)."""
    context, mechanism_class = (F.coalesce(c, F.lit("")) for c in (context, mechanism_class))
    lacks = lambda name: ~F.coalesce(F.array_contains(at_hand, name), F.lit(False))
    return joined_reasons(
        (context == "CODING_PTV_OR_CANONICAL_SPLICE", F.lit("LOFTEE_HIGH_CONFIDENCE_LOF")),
        ((context == "CODING_MISSENSE_OR_PROTEIN_ALTERING") & lacks("ALPHAMISSENSE"), F.lit("ALPHAMISSENSE")),
        *((context.startswith("CODING") & lacks(name), F.lit(need)) for name, need in CODING_RESOURCES),
        (mechanism_class.isin(*COLOCALISED_CLASSES), F.lit("FORMAL_COLOCALISATION_VALIDATION")),
        *((lacks(name), F.lit(need)) for name, need in GENERAL_RESOURCES),
        separator=";",
    )


def target_score(organism: Column, kind: Column, synonyms: Column, preferred: Column, symbol: Column) -> Column:
    """Points of one record of a target for a gene symbol: 100 human, 50 a single protein or 20 another one,
    100 for the symbol among the synonyms (an array), 20 for it as a word of the preferred name."""
    kind, wanted = F.upper(F.coalesce(kind, F.lit(""))), F.upper(F.trim(F.coalesce(symbol, F.lit(""))))
    among = F.exists(F.coalesce(synonyms, F.array().cast("array<string>")), lambda x: F.upper(F.trim(x)).eqNullSafe(wanted)) & (wanted != "")
    word = F.array_contains(F.split(F.upper(F.trim(F.coalesce(preferred, F.lit("")))), r"\s+"), wanted) & (wanted != "")
    on = lambda c, points: F.when(c, points).otherwise(0)
    protein = F.when(kind == "SINGLE PROTEIN", 50).when(F.contains(kind, F.lit("PROTEIN")), 20).otherwise(0)
    return on(F.lower(F.coalesce(organism, F.lit(""))) == "homo sapiens", 100) + protein + on(among, 100) + on(word, 20)


# Fixed format of a signal: experiment, file, assay, value, biosample, tissue, sample type, life stage, score.
SIGNAL_FIELDS = {"experiments": 1, "files": 2, "assays": 3, "biosamples": 5, "tissues": 6, "life_stages": 8}
SIGNAL_SCORE = 9


def active_signals(signals: Column, least: float) -> Column:
    """Of signals (arrays of text) those whose score reaches least: a struct of their distinct non-empty fields, in
    order of appearance, and their number. Signals that are NULL, too short or without a finite score don't count."""
    score = lambda x: F.try_element_at(x, F.lit(SIGNAL_SCORE)).try_cast("double")
    active = F.filter(F.coalesce(signals, F.array().cast("array<array<string>>")), lambda x: F.coalesce((score(x) >= least) & ~F.isnan(score(x)) & (score(x) < float("inf")), F.lit(False)))

    def field(place: int) -> Column:
        return F.array_distinct(F.filter(F.transform(active, lambda x: F.trim(F.try_element_at(x, F.lit(place)))), lambda x: x != ""))

    return F.struct(F.size(active).alias("n_active"), *(field(place).alias(name) for name, place in SIGNAL_FIELDS.items()))
