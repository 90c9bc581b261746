"""Greedy choices in rounds: what no stronger undecided row stands against is chosen at once, with all others
like it, and what it rules out goes. The outcome is that of going through all rows one by one, strongest first; no group, of
whatever size, has to be in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import joins, scans
from .graphs import _forget, _saved


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for x in frames[1:]:
        out = out.unionByName(x)
    return out


def _apart(df: DataFrame) -> DataFrame:
    """df, never sent to all tasks through the driver: Spark takes saved tables for as small as their packed files."""
    return df.hint("merge")


#: Pairs of a task that goes through a stretch of the order by itself.
PAIRS = 4_000_000
_OPEN, _GONE, _CHOSEN = 0, 1, 2


def in_order(df: DataFrame, *order: Column) -> DataFrame:
    """df, saved, with node: a number that rises along the order."""
    return _saved(df.orderBy(*order).withColumn("node", F.monotonically_increasing_id()))


def _settle(pairs: pa.Table) -> pa.Table:
    """What one stretch settles by itself: its weak nodes in order, each as soon as all that are stronger are settled. A strong
    node that is weak nowhere in the stretch is settled if state says so, else open in another stretch."""
    strong, weak, state = (pairs[c].to_numpy() for c in ("strong", "weak", "state"))
    order = np.argsort(weak, kind="stable")
    strong, weak, state = strong[order], weak[order], state[order]
    nodes, first = np.unique(weak, return_index=True)
    ends = np.append(first[1:], len(weak))
    at = np.minimum(np.searchsorted(nodes, strong), len(nodes) - 1)
    outside = nodes[at] != strong
    at[outside] = len(nodes) + np.arange(np.count_nonzero(outside))
    known = np.concatenate([np.zeros(len(nodes), np.int8), state[outside]])
    for k, (i, j) in enumerate(zip(first.tolist(), ends.tolist(), strict=True)):
        above = known[at[i:j]]
        known[k] = _GONE if (above == _CHOSEN).any() else _CHOSEN if (above == _GONE).all() else _OPEN
    known = known[: len(nodes)]
    settled = known != _OPEN
    return pa.table({"node": nodes[settled], "state": known[settled]})


def independent(nodes: DataFrame, against: DataFrame, *place: str) -> DataFrame:
    """The nodes (node) that greedy choice takes by rising node, where against (strong, weak, place) says which rules out
    which and strong < weak; place is of the weak one, and nodes that rule each other out should lie near each other in it.

    Pairs are dealt by range of place to stretches, of about so many pairs each, and a stretch is gone through in order as far as
    it doesn't hang on others. So rounds grow with the stretches that a chain of nodes runs through, not with its length."""
    kept = _saved(against.select(*dict.fromkeys(("strong", "weak", *place))))
    parts = -(-kept.count() // PAIRS)
    if parts <= 1:  # what is weak nowhere is chosen
        only = kept.select(F.lit(0).alias("part"), "strong", "weak", F.lit(_CHOSEN).cast("byte").alias("state"))
        gone = only.groupBy("part").applyInArrow(_settle, "node long, state byte").where(F.col("state") == _GONE)
        return _saved(nodes.select("node").distinct().join(_apart(gone), "node", "left_anti"))
    dealt = kept.repartitionByRange(parts, *place).withColumn("part", F.spark_partition_id())
    left = _saved(dealt.select("part", "strong", "weak"))
    weak = _saved(left.select(F.col("weak").alias("node")).distinct())
    free = _saved(nodes.select("node").distinct().join(_apart(weak), "node", "left_anti"))
    _forget(kept, weak)
    known, chosen = free.select("node", F.lit(_CHOSEN).cast("byte").alias("state")), [free]
    while not left.isEmpty():
        told = _saved(left.join(_apart(known.withColumnRenamed("node", "strong")), "strong", "left").select("part", "strong", "weak", F.coalesce("state", F.lit(_OPEN).cast("byte")).alias("state")))
        known = _saved(told.groupBy("part").applyInArrow(_settle, "node long, state byte"))
        chosen.append(known.where(F.col("state") == _CHOSEN).select("node"))
        rest = _saved(told.where(F.col("state") == _OPEN).select("part", "strong", "weak").join(_apart(known.select(F.col("node").alias("weak"))), "weak", "left_anti").select("part", "strong", "weak"))
        _forget(left, told)
        left = rest
    return _union(chosen)


def _leaders(nodes: DataFrame, keys: Sequence[str], pairs: Callable[[DataFrame, DataFrame], DataFrame], *place: str, first: int) -> DataFrame:
    """The nodes (node, keys) that greedy choice takes by rising node within their keys; pairs gives strong, weak and place (see
    independent) of what of one part of nodes rules out what of another, strong < weak. The first nodes of each key are held against
    each other, then eight times as many, and so on: each time only those that no node taken so far rules out."""
    found, limit = [], first
    left = _saved(scans.row_numbers(nodes, keys, [F.col("node")], "at"))
    while not left.isEmpty():
        front, later = _saved(left.where(F.col("at") <= limit)), left.where(F.col("at") > limit)
        taken = _saved(independent(front, pairs(front, front), *place))
        found.append(taken)
        strong = _saved(front.join(_apart(taken), "node"))
        fresh = _saved(later.join(_apart(pairs(strong, later).select(F.col("weak").alias("node")).distinct()), "node", "left_anti"))
        _forget(front, left, strong)
        left, limit = fresh, limit * 8
    return _union(found) if found else left.select("node")


def clump(variants: DataFrame, ld: DataFrame | Callable[[DataFrame, DataFrame], DataFrame], index_p: float = 5e-8, member_p: float = 0.01, window: int = 1_000_000, least_r2: float = 0.1) -> DataFrame:
    """variants (chrom, pos, id, p) and ld (chrom, a, b, r2): chrom, lead, id, p of every clump member. The
    variant with the least p <= index_p (then pos, id) leads and takes all free ones with p <= member_p within the
    window that it is linked to; and so on. A variant leads if no stronger lead is linked to it, and each other one
    belongs to the strongest lead linked to it. An id is one variant of its chromosome.

    Where r2 hangs on places alone, ld may be a function instead, that gives r2 beside left (chrom, l_id, l_pos, l_node) and right
    (r_id, ...), two parts of the variants, for pairs near each other; variants of one place must be linked. Then pairs are made
    only of leads and what may lead, not of all variants with all."""
    known = variants.where((F.col("p") <= member_p) & F.col("id").isNotNull() & F.col("chrom").isNotNull()).select("chrom", "id", "pos", "p")
    mine = in_order(known, F.col("p"), F.col("pos"), F.col("id"))
    if callable(ld):
        return _clump_by_place(mine, ld, index_p, window, least_r2)
    pairs = ld.where((F.col("r2") >= least_r2) & (F.col("a") != F.col("b"))).select("chrom", "a", "b")
    ends = lambda c, r: mine.select("chrom", F.col("id").alias(c), F.struct("node", "pos", (F.col("p") <= index_p).alias("may_lead")).alias(r))
    linked = pairs.join(ends("a", "l"), ["chrom", "a"]).join(ends("b", "r"), ["chrom", "b"]).where(F.abs(F.col("l.pos") - F.col("r.pos")) <= window)
    first = F.col("l.node") < F.col("r.node")
    both = linked.select("chrom", F.when(first, F.col("l")).otherwise(F.col("r")).alias("s"), F.when(first, F.col("r")).otherwise(F.col("l")).alias("w")).where("s.may_lead")
    against = _saved(both.select("chrom", F.col("s.node").alias("strong"), F.col("w.node").alias("weak"), F.col("w.pos").alias("pos"), F.col("w.may_lead").alias("may_lead")))
    leads = _saved(independent(mine.where(F.col("p") <= index_p), against.where("may_lead"), "chrom", "pos"))
    taken = against.join(leads.select(F.col("node").alias("strong")), "strong", "left_semi").groupBy(F.col("weak").alias("node")).agg(F.min("strong").alias("lead"))
    members = taken.join(leads, "node", "left_anti").unionByName(leads.select("node", F.col("node").alias("lead")))
    named = members.join(mine, "node").join(mine.select(F.col("node").alias("lead"), F.col("id").alias("lead_id")), "lead")
    return named.select("chrom", F.col("lead_id").alias("lead"), "id", F.col("p").cast("double").alias("p"))


def _clump_by_place(mine: DataFrame, ld: Callable[[DataFrame, DataFrame], DataFrame], index_p: float, window: int, least_r2: float) -> DataFrame:
    side = lambda df, way, *more: df.select("chrom", *(F.col(c).alias(f"{way}_{c}") for c in ("id", "pos", "node")), *more)

    def linked(left: DataFrame, right: DataFrame, *more: str) -> DataFrame:
        pairs = ld(side(left, "l"), side(right, "r", *more))
        return pairs.where((F.col("r2") >= least_r2) & (F.col("l_node") < F.col("r_node")) & (F.abs(F.col("l_pos") - F.col("r_pos")) <= window))

    # Only the strongest of a place can lead; what has no place is linked to nothing.
    apart = F.when(F.col("pos").isNull(), F.col("id"))
    heads = mine.where(F.col("p") <= index_p).groupBy("chrom", "pos", apart).agg(F.min("node").alias("node"), F.min_by("id", "node").alias("id")).select("chrom", "pos", "id", "node")
    against = lambda strong, weak: linked(strong, weak).select(F.col("l_node").alias("strong"), F.col("r_node").alias("weak"), "chrom", F.col("r_pos").alias("pos"))
    leads = _saved(mine.join(_apart(_leaders(heads, ["chrom"], against, "chrom", "pos", first=512)), "node"))
    taken = linked(leads, mine, "p").groupBy("chrom", F.col("r_id").alias("id"), "p").agg(F.min_by("l_id", "l_node").alias("lead"))
    return taken.unionByName(leads.select("chrom", "id", "p", F.col("id").alias("lead"))).select("chrom", "lead", "id", F.col("p").cast("double").alias("p"))


def greedy_match(pairs: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """pairs (keys, a, b, score): by falling score (then a, b) those whose two ends are both free. A pair that is the first
    of both its ends is kept, and all others of these ends go. A pair without a score, or repeated, is none of its own."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = F.struct((-F.col("score")).alias("falling"), "a", "b")
    left = _saved(pairs.where("score IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL").select(*keys, "a", "b", "score").distinct())
    kept = []
    while not left.isEmpty():
        best = [left.groupBy(*keys, end).agg(F.min(order).alias("o")).select(*keys, end, F.col(f"o.{'b' if end == 'a' else 'a'}").alias("b" if end == "a" else "a"), (-F.col("o.falling")).alias("score")) for end in ("a", "b")]
        both = _saved(best[0].select(*keys, "a", "b", "score").join(best[1], [*keys, "a", "b", "score"]))
        kept.append(both)
        rest = left
        for end in ("a", "b"):
            rest = rest.join(both.select(*keys, end), [*keys, end], "left_anti")
        rest = _saved(rest)
        _forget(left)
        left = rest
    return (_union(kept) if kept else left).select(*keys, "a", "b", "score")


#: Terms of each collection that the first round chooses among (see _leaders); sets up to which a row carries all members.
FIRST, FEW = 64, 64


def _sets(heads: DataFrame) -> DataFrame:
    """heads (node, collection, genes) with members in place of genes: numbers, those of fewest sets first, and what
    joins.may_be_near needs. A gene is a member within its collection; sets without genes are left out."""
    each = heads.select("node", "collection", F.explode("genes").alias("gene")).select("node", F.struct("collection", "gene").alias("name"))
    numbered = in_order(each.groupBy("name").agg(F.count("*").alias("f")), F.col("f"), F.col("name")).select("name", F.col("node").alias("member"))
    grouped = each.join(_apart(numbered), "name").groupBy("node").agg(F.array_sort(F.collect_list("member")).alias("members"), F.count("*").alias("n"), *joins.parities("member"))
    return grouped.join(_apart(heads.select("node", "collection")), "node")


def _nearness(sets: DataFrame, num: int, den: int):
    """A function of two parts of sets (see _sets) that gives node, other and jaccard of their pairs, of num / den or more."""
    most = sets.agg(F.max("n")).first()[0] or 0
    small, share = (F.col("n") <= FEW) & (F.col("r_n") <= FEW), F.col("common") / (F.col("n") + F.col("r_n") - F.col("common"))
    enough = F.col("common") * (den + num) >= (F.col("n") + F.col("r_n")) * num

    def rarest(side: DataFrame) -> DataFrame:
        few = F.expr(f"slice(members, 1, cast(n - (n * {num} + {den - 1}) div {den} + 1 as int))")
        return side.select("node", "n", "low", "high", F.when(F.col("n") <= FEW, F.col("members")).alias("few"), F.posexplode(few).alias("place", "member")).withColumn("place", F.col("place") + 1)

    def near(left: DataFrame, right: DataFrame, only: str = "node <> r_node") -> DataFrame:
        other = rarest(right)
        met = rarest(left).join(_apart(other.select(*(F.col(c).alias(f"r_{c}") for c in other.columns))), F.col("member") == F.col("r_member"))
        met = met.where(F.expr(only) & joins.may_be_near(num, den))
        # Members are in order, so the first common one is among the rarest of both: there a pair is kept.
        listed = met.where(small).select("node", F.col("r_node").alias("other"), "n", "r_n", "member", F.array_intersect("few", "r_few").alias("both"))
        found = listed.where(F.col("both")[0] == F.col("member")).withColumn("common", F.size("both")).where(enough).select("node", "other", share.alias("jaccard"))
        if most <= FEW:
            return found
        pairs = met.where(~small).select("node", F.col("r_node").alias("other")).distinct()
        full = pairs.join(_apart(sets.select("node", "n", "members")), "node").join(_apart(sets.select(F.col("node").alias("other"), F.col("n").alias("r_n"), F.col("members").alias("r_members"))), "other")
        return found.unionByName(full.withColumn("common", F.size(F.array_intersect("members", "r_members"))).where(enough).select("node", "other", share.alias("jaccard")))

    return near


def redundancy_clusters(terms: DataFrame, collection: str, threshold: float = 0.7) -> DataFrame:
    """terms (collection, term, fdr, genes): collection, term, cluster and representative. By rising fdr (NULL last, then
    term) a term joins the representative with the greatest Jaccard of at least threshold, the earliest of equals, or opens a
    cluster. A term stands once in its collection, by its least fdr; a term without genes is alone. A term opens a cluster
    if no stronger representative is like it, so representatives are chosen in rounds and terms are held against
    representatives, not against all others; terms with the same genes are one set until the end, since only the first of
    them can open a cluster."""
    share = Fraction(str(threshold))
    genes = F.array_sort(F.array_distinct(F.coalesce(F.filter("genes", lambda g: g.isNotNull()), F.array().cast(dict(terms.dtypes)["genes"]))))
    least = F.min(F.struct(F.col("fdr").isNull().alias("unknown"), F.col("fdr").alias("fdr"), genes.alias("genes"))).alias("x")
    once = terms.where("term IS NOT NULL").groupBy(F.col(collection).alias("collection"), "term").agg(least)
    rank = F.struct("x.unknown", "x.fdr", "term")
    alone = F.when(F.size("x.genes") == 0, F.col("term")).alias("alone")
    rows = _saved(once.select("term", rank.alias("rank"), F.struct("collection", F.col("x.genes").alias("genes"), alone).alias("set")))
    # A node is a set, numbered by collection and rank of its first term.
    heads = in_order(rows.groupBy("set").agg(F.min("rank").alias("rank")), F.col("set.collection"), F.col("rank"))
    plain = heads.select("node", F.col("set.collection").alias("collection"), F.col("set.genes").alias("genes"))
    sets = _saved(_sets(plain))
    near = _nearness(sets, share.numerator, share.denominator)
    against = lambda strong, weak: near(weak, strong, "r_node < node").select(F.col("other").alias("strong"), F.col("node").alias("weak"))
    found = plain.where(F.size("genes") == 0).select("node").unionByName(_leaders(sets, ["collection"], against, "weak", first=FIRST))
    leads = _saved(scans.row_numbers(found.join(_apart(plain.select("node", "collection")), "node"), ["collection"], [F.col("node")], "cluster"))
    named = leads.join(_apart(heads.select("node", "rank")), "node").select("node", "rank", "cluster")
    linked = near(sets, sets.join(_apart(leads.select("node")), "node")).unionByName(leads.select("node", F.col("node").alias("other"), F.lit(1.0).alias("jaccard")))
    offers = linked.join(_apart(named.withColumnRenamed("node", "other")), "other").groupBy("node").agg(F.collect_list(F.struct((-F.col("jaccard")).alias("j"), F.col("rank").alias("lead"), "cluster")).alias("offers"))
    of_set = offers.join(_apart(heads.select("node", "set")), "node").select("set", "offers")
    chosen = F.array_min(F.filter("offers", lambda x: x["lead"] <= F.col("rank")))
    best = rows.join(_apart(of_set), "set").select(F.col("set.collection").alias("collection"), "term", chosen.alias("x"))
    return best.select("collection", "term", F.col("x.cluster").cast("long").alias("cluster"), F.col("x.lead.term").alias("representative"))
