"""Joins with rules of their own: cardinality, precedence, ambiguity, evidence assembly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import scans
from .graphs import _saved
from .grouping import assert_unique, keep_first


#: Owners whose sizes are sent to all tasks.
FEW_OWNERS = 1_000_000


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join many to one; a repeated key on the right is an error at run time."""
    return left.join(assert_unique(right, keys), list(keys), "left")


def outer_evidence(left: DataFrame, right: DataFrame, keys: Sequence[str], coalesced: Sequence[str] = ()) -> DataFrame:
    """Full outer join; columns in coalesced take the left value first; presence names the side."""
    a = left.withColumn("_l", F.lit(True)).alias("a")
    b = right.withColumn("_r", F.lit(True)).alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    shared = {*keys, *coalesced}
    both = [F.coalesce(f"a.{c}", f"b.{c}").alias(c) for c in (*keys, *coalesced)]
    rest = [F.col(f"a.{c}") for c in left.columns if c not in shared] + [F.col(f"b.{c}") for c in right.columns if c not in shared]
    presence = F.when(F.col("_l") & F.col("_r"), "BOTH").when(F.col("_l"), "LEFT_ONLY").otherwise("RIGHT_ONLY")
    return a.join(b, on, "full").select(*both, *rest, presence.alias("presence"))


def match_by_position_and_alleles(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """rows (row_id, chrom, pos, a1, a2) with reference (ref_id, chrom, pos, ref, alt): matched is the one
    candidate with the same two alleles in either order; without any, a single candidate at the position is
    taken although its alleles differ; several are ambiguous. status: MATCHED, POSITION_ONLY, AMBIGUOUS, ABSENT."""
    # The candidates of a position, and of its alleles, are counted first, so that a row meets one row of each.
    pair = lambda x, y: F.concat_ws("|", F.least(x, y), F.greatest(x, y)).alias("_pair")
    known = reference.select("chrom", "pos", "ref_id", pair("ref", "alt"))
    at_place = known.groupBy("chrom", "pos").agg(F.count("ref_id").alias("_n"), F.min("ref_id").alias("_any"))
    alike = known.groupBy("chrom", "pos", "_pair").agg(F.count("*").alias("_same"), F.min("ref_id").alias("_id"))
    met = rows.select("row_id", "chrom", "pos", pair("a1", "a2")).join(at_place, ["chrom", "pos"], "left").join(alike, ["chrom", "pos", "_pair"], "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0).cast("long"))
    joined = met.groupBy("row_id").agg(total("_n").alias("candidates"), total("_same").alias("exact"), F.min("_id").alias("exact_id"), F.min("_any").alias("any_id"))
    status = F.when(F.col("exact") == 1, "MATCHED").when(F.col("exact") > 1, "AMBIGUOUS").when(F.col("candidates") == 1, "POSITION_ONLY").when(F.col("candidates") > 1, "AMBIGUOUS").otherwise("ABSENT")
    out = joined.withColumn("status", status)
    return out.select("row_id", "status", F.when(F.col("status") == "MATCHED", F.col("exact_id")).when(F.col("status") == "POSITION_ONLY", F.col("any_id")).alias("ref_id"))


def match_in_two_stages(rows: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """rows (row_id, key1, key2) by key1 in first (key1, ref_id), then by key2 in second (key2, ref_id);
    only keys with a single candidate count. method says which stage matched."""
    unique = lambda df, k, name: df.groupBy(k).agg(F.count("*").alias("_n"), F.min("ref_id").alias(name)).where("_n = 1").drop("_n")
    out = rows.join(unique(first, "key1", "_one"), "key1", "left").join(unique(second, "key2", "_two"), "key2", "left")
    return out.select("row_id", F.coalesce("_one", "_two").alias("ref_id"), F.when(F.col("_one").isNotNull(), "FIRST").when(F.col("_two").isNotNull(), "SECOND").otherwise("UNMATCHED").alias("method"))


def first_seen_map(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """key to the value of its first row."""
    return keep_first(df.where(F.col(key).isNotNull() & F.col(value).isNotNull()), [key], [F.col(order)]).select(key, value)


def assemble(base: DataFrame, keys: Sequence[str], tables: Sequence[DataFrame], defaults: dict | None = None) -> DataFrame:
    """base LEFT JOIN each table in turn; columns that base already has are dropped from the right."""
    for t in tables:
        base = base.join(t.select(*keys, *(c for c in t.columns if c not in base.columns)), list(keys), "left")
    return base.na.fill(defaults) if defaults else base


def domain_grid(df: DataFrame, key: str, domain: DataFrame) -> DataFrame:
    """Every key with every value of a small fixed domain."""
    return df.select(key).distinct().crossJoin(F.broadcast(domain))


def compare_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """key and label COMMON, LEFT_ONLY or RIGHT_ONLY."""
    a, b = left.select(key).distinct().withColumn("_l", F.lit(1)), right.select(key).distinct().withColumn("_r", F.lit(1))
    return a.join(b, key, "full").select(key, F.when(F.col("_l").isNull(), "RIGHT_ONLY").when(F.col("_r").isNull(), "LEFT_ONLY").otherwise("COMMON").alias("label"))


def shared_members(df: DataFrame, owner: str, member: str) -> DataFrame:
    """Pairs of owners with a member in common: shared, n_left, n_right, jaccard. An owner is sent, for each of its members, the list
    of the owners after it, and its pairs are made and summed where they arrive; members that very many owners share make
    this long, so owners should be few (sets), members many."""
    pairs = df.select(owner, member).where(F.col(member).isNotNull() & F.col(owner).isNotNull()).distinct()
    sizes = _saved(df.select(owner, member).distinct().groupBy(owner).agg(F.count("*").alias("n")))
    lists = pairs.groupBy(member).agg(F.collect_list(owner).alias("owners"))
    after = lists.select(F.explode("owners").alias("left_id"), "owners").select("left_id", F.filter("owners", lambda o: o > F.col("left_id")).alias("after")).where(F.size("after") > 0)
    shared = after.repartition("left_id").select("left_id", F.explode("after").alias("right_id")).groupBy("left_id", "right_id").agg(F.count("*").alias("shared"))
    small = F.broadcast if sizes.count() <= FEW_OWNERS else lambda x: x
    side = lambda c: small(sizes.select(F.col(owner).alias(f"{c}_id"), F.col("n").alias(f"n_{c}")))
    out = shared.join(side("left"), "left_id").join(side("right"), "right_id")
    return out.withColumn("jaccard", F.col("shared") / (F.col("n_left") + F.col("n_right") - F.col("shared"))).select("left_id", "right_id", "shared", "n_left", "n_right", "jaccard")


def parities(member: str) -> list:
    """Aggregates low and high: whether an odd number of members fall on each of 128 places by hash. Two sets differ by
    as many members at least as by places."""
    at = f"cast(pmod(xxhash64(7, {member}), 128) as int)"
    return [F.expr(f"bit_xor(CASE WHEN {at} < 64 THEN shiftleft(1L, {at}) ELSE 0L END)").alias("low"), F.expr(f"bit_xor(CASE WHEN {at} >= 64 THEN shiftleft(1L, {at} - 64) ELSE 0L END)").alias("high")]


def among_rarest(size: str, place: str, num: int, den: int):
    return F.col(place) <= F.col(size) - F.expr(f"({size} * {num} + {den - 1}) div {den}") + 1


def may_be_near(num: int, den: int):
    """For rows (n, place, low, high) and (r_n, r_place, ...) that meet in their first common rarest member: false only if
    they share too few, by their sizes, by the members from there on, or by their parities."""
    both = F.col("n") + F.col("r_n")
    sizes = (F.col("n") * den >= F.col("r_n") * num) & (F.col("r_n") * den >= F.col("n") * num)
    rest = (F.least(F.col("n") - F.col("place"), F.col("r_n") - F.col("r_place")) + 1) * (den + num) >= both * num
    apart = F.expr("bit_count(low ^ r_low) + bit_count(high ^ r_high)") * (den + num) <= both * (den - num)
    return sizes & rest & apart


def similar_sets(df: DataFrame, owner: str, member: str, num: int, den: int) -> DataFrame:
    """Pairs (left_id, right_id) of owners whose sets of members have a Jaccard similarity of num / den or more, with shared,
    n_left and n_right; NULL is no member. Of two such sets each has one of the other's rarest members among its own rarest (as
    many as it may lack, and one more), so only owners that share one there, and are of near sizes, are counted; a
    member of very many owners is among the rarest of sets of such members alone. Pairs whose places there, or whose
    parities of members, show that they share too few go before anything is kept. Equal sets are one until the end."""
    pairs = _saved(df.where(F.col(owner).isNotNull() & F.col(member).isNotNull()).select(F.col(owner).alias("o"), F.col(member).alias("m")).distinct())
    # Equal sets have equal size and equal sums of two hashes.
    of_owner = pairs.groupBy("o").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("m")).alias("x"), F.bit_xor(F.xxhash64(F.lit(3), "m")).alias("y"), *parities("m"))
    heads = _saved(of_owner.groupBy("n", "x", "y").agg(F.min("o").alias("s"), F.min("low").alias("low"), F.min("high").alias("high")))
    owners = _saved(of_owner.join(heads.select("n", "x", "y", "s"), ["n", "x", "y"]).select("o", "n", "s"))
    sets = _saved(pairs.join(heads.select(F.col("s").alias("o"), "n", "low", "high"), "o").select(F.col("o").alias("s"), "n", "low", "high", "m"))
    often = sets.groupBy("m").agg(F.count("*").alias("f"))
    ranked = scans.row_numbers(sets.join(often, "m"), ["s"], [F.col("f"), F.col("m")], "place")
    rare = _saved(ranked.where(among_rarest("n", "place", num, den)).select("s", "n", "low", "high", "place", "m"))
    other = rare.select(*(F.col(c).alias(f"r_{c}") for c in rare.columns))
    asked = _saved(rare.join(other, F.col("m") == F.col("r_m")).where((F.col("s") < F.col("r_s")) & may_be_near(num, den)).select(F.col("s").alias("p"), F.col("n").alias("n_p"), F.col("r_s").alias("q"), F.col("r_n").alias("n_q")).distinct())
    first = asked.join(sets.select(F.col("s").alias("p"), "m"), "p")
    shared = first.join(sets.select(F.col("s").alias("q"), "m"), ["q", "m"]).groupBy("p", "q", "n_p", "n_q").agg(F.count("*").alias("shared"))
    good = shared.where(F.col("shared") * (den + num) >= (F.col("n_p") + F.col("n_q")) * num).select("p", "q", "shared")
    same = heads.select(F.col("s").alias("p"), F.col("s").alias("q"), F.col("n").alias("shared"))
    linked = good.unionByName(same)
    out = linked.join(owners.select(F.col("s").alias("p"), F.col("o").alias("a"), F.col("n").alias("n_a")), "p").join(owners.select(F.col("s").alias("q"), F.col("o").alias("b"), F.col("n").alias("n_b")), "q").where("a <> b AND (p <> q OR a < b)")
    turn = F.col("a") < F.col("b")
    side = lambda x, y, into: F.when(turn, F.col(x)).otherwise(F.col(y)).alias(into)
    return out.select(side("a", "b", "left_id"), side("b", "a", "right_id"), "shared", side("n_a", "n_b", "n_left"), side("n_b", "n_a", "n_right"))


def duplicate_flags(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn("is_duplicate", F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1)


def signature(*parts: str):
    """Hash of columns as text, NULL apart from empty, each with its length, so that no two rows of parts run together."""
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.length(F.col(p).cast("string")), F.lit(":"), F.col(p).cast("string")), F.lit("-")) for p in parts)), 256)


def unfinished(items: DataFrame, manifest: DataFrame, identity: Sequence[str], parameters: Sequence[str], into: str = "signature") -> DataFrame:
    """Items, with their signature, that the manifest (the same columns, and complete) doesn't list as complete with the
    same identity and parameters: what a resumed run still has to do."""
    done = manifest.where("complete").select(signature(*identity, *parameters).alias(into)).distinct()
    return items.withColumn(into, signature(*identity, *parameters)).join(done, into, "left_anti")


def chosen_target(wanted: DataFrame, records: DataFrame, key: str, record: str, score: str, least: int = 100) -> DataFrame:
    """Per key of wanted the record with the highest score, the first of equal ones by record, and a status:
    SCORE_n, NO_CONFIDENT_HUMAN_MATCH below least (no record then), NO_RESULTS without records."""
    best = records.groupBy(key).agg(F.max(F.col(score)).alias("_s"), F.min_by(F.col(record), F.struct(-F.col(score), F.col(record))).alias("_r"))
    found = wanted.select(key).distinct().join(best, key, "left")
    status = F.when(F.col("_s").isNull(), "NO_RESULTS").when(F.col("_s") < least, "NO_CONFIDENT_HUMAN_MATCH").otherwise(F.concat(F.lit("SCORE_"), F.col("_s").cast("string")))
    return found.select(key, F.when(F.col("_s") >= least, F.col("_r")).alias(record), status.alias("status"))
