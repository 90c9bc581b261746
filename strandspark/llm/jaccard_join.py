"""Exact Jaccard join of shingle sets by universe partition, and its connected components.

Sets that reach the threshold differ in few elements. Elements are dealt by hash into segments, as many
(by size band) as leave equal segments between any two such sets; equal segments are found by
equality alone. Per band the cheaper plan is taken:

- exact: H + 1 + spare segments for at most H differences, each signed by its whole subset. Segments with
  fewer than `tiny` elements say little and are not signed; the spare ones make up for them, and the
  few sets with more tiny segments than spare ones sign those too.
- one deletion: (H + 1) / 2 segments, signed by their subset and by each subset less one element, so
  that segments with one difference meet as well. Cheaper for small sets.

Equal sets are one node from the start. Signatures are shuffled once, straight from the texts: a window over each
signature tells which are shared. Those that several nodes of one block share are known to be shared where they are made, and
all but one of their rows travel under keys of their own, so that a signature of very many nodes makes
no large partition. Two linked sets have more than `spare` equal segments, so a node with fewer
shared signatures under a plan, less its own tiny segments, takes no part in it; one with more tiny segments than spare
ones needs a single one, as its partner may have signed none of those. Nodes that shared signatures
connect form a cluster; nodes are never compared all with all.

Clusters of any size take one path. Of each member's set, the rarest elements that one of two linked sets must share
(prefix filter; any one order of all elements is right, and counts in COUNTERS places by hash tell rare from frequent) deal the
members of a cluster, by size band, into groups. Each has a pivot (the least node); groups of one pivot are one group from then on. Each other
member is verified with the pivot; links to it close most groups. An open one of at most SETTLED members is
verified within one task, through an index of their elements. In a larger one, with p the pivot and E(x) the elements
in which x and p differ, two members with nothing common to E(x) and E(y) are linked only if both are linked to p; so
what remains are pairs that share elements of E. Those are found through the rarest elements of E (as
above, in the order of their frequency within the group): the members that share one are a new group without the
old pivot, treated as above with a pivot of its own. (Pivots rise from round to round. Groups with the very same
members are one, and so are small ones of one pivot.)

Elements are 64-bit hashes of shingles: "exact" is meant of the sets of these.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .common import rows_of, small, stash, texts
from .components import components

col = F.col

#: Bands are at least so wide, and as wide as linked sizes may differ: a set is signed under two of them.
BAND_RATIO = 1.4
#: More spare segments cost signatures and ask more company of a node.
LEAST_SPARE = 3
#: What a pivot leaves open among so many members is settled in one task, if they have so many elements at most.
SETTLED, SETTLED_ELEMENTS = 2_048, 2_000_000
#: Members of a cluster that meet one copy of their pivot's set.
PER_PIVOT = 256
#: Places at which elements of candidates are counted, for an order from rare to frequent.
COUNTERS = 1 << 18
#: Nodes whose signatures a task remembers to have made, so that copies add none.
REMEMBERED = 200_000


@lru_cache(maxsize=8)
def bands(num: int, den: int) -> tuple[np.ndarray, list[tuple]]:
    """First size of each band, and its plan: (kind, segments, spare, tiny)."""
    starts, plans, lo = [], [], 1
    while lo < 1 << 31:
        nxt = max(lo + 1, math.ceil(lo * BAND_RATIO), -(-lo * den // num))
        starts.append(lo)
        plans.append(_plan(lo, nxt - 1, num, den))
        lo = nxt
    return np.array(starts, np.int64), plans


def _plan(lo: int, hi: int, num: int, den: int) -> tuple:
    most = (den - num) * 2 * hi // (den + num)
    if not most:
        return ("none", 0, 0, 0)
    half = -(-(most + 1) // 2)
    best = (float(half + hi), ("deletion", half, 0, 0))
    for tiny in (2, 1):
        spare = LEAST_SPARE
        for _ in range(40):
            m = most + 1 + spare
            mean = m * _tiny_share(lo / m, tiny)
            need = math.ceil(mean + 2.33 * math.sqrt(mean))
            if need <= spare:
                break
            spare = need
        else:
            continue
        if spare <= most:
            # What a signature costs beside its row: company of no use, likelier the fewer its elements.
            cost = m * (1 + 30 * math.exp(-lo / m) * ((lo / m) if tiny == 1 else (lo / m) ** 2 / 2) / 10)
            best = min(best, (cost, ("exact", m, spare, tiny)))
    return best[1]


def _tiny_share(mean: float, tiny: int) -> float:
    return math.exp(-mean) * (1 if tiny == 1 else 1 + mean)


def shingle_sets(block: W.Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, in order, and where each row's begin."""
    count, h = block.n_words, block.hashes()
    at = W.whole(block.first_word, k)
    row, token = [block.row_of_word[at]], [W.grams(h, k)[at]]
    for n in range(1, k):
        short = np.flatnonzero(count == n)
        if len(short):
            row.append(short)
            token.append(W.grams(h, n)[block.first_word[short]])
    row, token = np.concatenate(row), np.concatenate(token)
    order = np.lexsort((token, row))
    row, token = row[order], token[order]
    if len(row):
        new = np.r_[True, (row[1:] != row[:-1]) | (token[1:] != token[:-1])]
        row, token = row[new], token[new]
    return token, np.searchsorted(row, np.arange(len(count) + 1))


def set_keys(token: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One even number per set, from the sum over its elements: equal for equal sets. (The last
    bit is free to tell a node's two plans apart.)"""
    total = np.r_[np.uint64(0), np.cumsum(W.mix(token), dtype=np.uint64)]
    return W.mix(total[first[1:]] - total[first[:-1]] + W.mix(np.diff(first).astype(np.uint64))) & ~np.uint64(1)


def signatures(token: np.ndarray, first: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(2 row + step, signature) of all sets: step 0 under the plan of their band, step 1 under that of
    the next one where a set of it may reach the threshold; and how many signatures a set
    shares at least with any it is linked to, by 2 row + step."""
    starts, plans = bands(num, den)
    n, rows, sigs = np.diff(first), [], []
    need = np.ones(2 * len(n), np.int64)
    total = np.r_[np.uint64(0), np.cumsum(W.mix(token ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)]
    own = np.searchsorted(starts, n, "right") - 1
    for step in (0, 1):
        band = own + step
        for b in np.unique(band[n > 0]).tolist():
            kind, m, spare, tiny = plans[b]
            mine = np.flatnonzero((band == b) & (n > 0))
            if step:
                mine = mine[n[mine] * den >= starts[b] * num]
            if kind == "none" or not len(mine):
                continue
            at = W.spread(first[mine], n[mine])
            owner = np.repeat(np.arange(len(mine)), n[mine])
            segment = ((token[at] >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
            # Elements are in order of their hash, so each segment is a run of them.
            edge = np.searchsorted(owner * m + segment, np.arange(len(mine) * m + 1))
            size = np.diff(edge)
            inner = len(at) - 1
            sums = total[at[np.maximum(edge[1:] - 1, 0)] + 1] - total[at[np.minimum(edge[:-1], inner)]]
            sums = np.where(size > 0, sums, np.uint64(0))
            who = np.repeat(np.arange(len(mine)), m)
            salt = W.mix((np.uint64(b) << np.uint64(32)) + np.arange(m, dtype=np.uint64))
            salt = np.tile(salt, len(mine))
            if kind == "exact":
                weak = size < tiny
                few = np.bincount(who, weak, len(mine)).astype(np.int64)
                # One with more tiny segments than spare ones may be linked to one that signs none of its tiny ones.
                need[2 * mine + step] = np.where(few > spare, 1, spare + 1 - few)
                keep = ~weak | (few > spare)[who]
                rows.append(2 * mine[who[keep]] + step)
                sigs.append(W.mix(sums[keep] + salt[keep] + size[keep].astype(np.uint64)))
            else:
                rows.append(2 * mine[who] + step)
                sigs.append(W.mix(sums + salt + size.astype(np.uint64)))
                place = np.repeat(np.arange(len(size)), size)
                less = sums[place] - (total[at + 1] - total[at])
                rows.append(2 * mine[owner] + step)
                sigs.append(W.mix(less + salt[place] + (size[place] - 1).astype(np.uint64)))
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), need
    row, sig = np.concatenate(rows), np.concatenate(sigs)
    order = np.argsort(row, kind="stable")
    return row[order], sig[order], need


def _sizes(k: int):
    def run(batches):
        for batch in batches:
            for lo, hi, block in W.blocks(batch.column("text"), W.LOWER):
                token, first = shingle_sets(block, k)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(first)), pa.array(W.signed(set_keys(token, first)))], ["doc_id", "n", "node"])

    return run


def _signature_rows(k: int, num: int, den: int):
    """(sig, who, need, of): who is node + plan. Where several sets of a block share a signature, one row has the
    signature as sig and a negative need; the others have it as of, and any number as sig."""

    def run(batches):
        made: set[int] = set()
        for batch in batches:
            for _lo, _hi, block in W.blocks(batch.column("text"), W.LOWER):
                token, first = shingle_sets(block, k)
                node, n = set_keys(token, first), np.diff(first)
                _, fresh = np.unique(node, return_index=True)
                fresh = np.sort(fresh[[x not in made for x in node[fresh].tolist()]])
                if len(made) > REMEMBERED:
                    made.clear()
                made.update(node[fresh].tolist())
                mine, edge = W.spread(first[:-1][fresh], n[fresh]), np.r_[0, np.cumsum(n[fresh])]
                row, sig, need = signatures(token[mine], edge, num, den)
                who, need = node[fresh][row >> 1] + (row & 1).astype(np.uint64), np.minimum(need[row], 127)
                order = np.lexsort((who, sig))
                sig, who, need = sig[order], who[order], need[order]
                follows = np.r_[False, sig[1:] == sig[:-1]] if len(sig) else np.zeros(0, bool)
                shared = follows | np.r_[follows[1:], False] if len(sig) else follows
                key = np.where(follows, W.mix(who ^ W.mix(sig)), sig)
                need = np.where(shared, -need, need).astype(np.int8)
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(key)), pa.array(W.signed(who)), pa.array(need), pa.array(W.signed(sig), mask=~follows)], ["sig", "who", "need", "of"])

    return run


def _sets(k: int):
    def run(batches):
        for batch in batches:
            for _lo, _hi, block in W.blocks(batch.column("text"), W.LOWER):
                token, first = shingle_sets(block, k)
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(set_keys(token, first))), pa.ListArray.from_arrays(first.astype(np.int32), pa.array(W.signed(token)))], ["node", "tokens"])

    return run


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()


def _differ(num: int, den: int, with_elements: bool):
    """Per member of a group and its pivot: whether they reach the threshold, or in which elements they differ."""

    def run(batches):
        for batch in batches:
            (a, a_at), (b, b_at) = _lists(batch.column("x")), _lists(batch.column("y"))
            apart = [np.setxor1d(a[a_at[k] : a_at[k + 1]], b[b_at[k] : b_at[k + 1]], assume_unique=True) for k in range(batch.num_rows)]
            d, n = np.array([len(x) for x in apart], np.int64), np.diff(b_at).astype(np.int64)
            out = [batch.column("pivot"), batch.column("node"), pa.array(d * (den + num) <= (np.diff(a_at) + n) * (den - num))]
            if with_elements:
                edge = np.r_[0, np.cumsum(d)].astype(np.int32)
                flat = np.concatenate(apart) if apart else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays([*out, pa.array(n), pa.ListArray.from_arrays(edge, pa.array(W.signed(flat)))], ["pivot", "node", "near", "n", "apart"])
            else:
                yield pa.RecordBatch.from_arrays(out, ["pivot", "node", "near"])
            W.give_back()

    return run


def _beside_pivots(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pivot, node, x (the pivot's set) and y (the node's) of pairs (pivot, node): the pivot's set is copied once
    for every PER_PIVOT members, so that members of a large group meet it in many tasks."""
    heads = stash(pairs.groupBy("pivot").agg((F.expr(f"1 + count(*) div {PER_PIVOT}")).alias("copies")), "pivots")
    n_heads = heads.count()
    salted = pairs.join(small(heads, n_heads), "pivot").select("pivot", "node", F.expr("pmod(xxhash64(node), copies)").alias("salt"))
    copies = small(heads, n_heads).join(sets.select(col("node").alias("pivot"), col("tokens").alias("x")), "pivot").select("pivot", "x", F.explode(F.expr("sequence(0L, copies - 1)")).alias("salt"))
    return small(salted, pairs.count()).join(sets.select("node", col("tokens").alias("y")), "node").join(copies, ["pivot", "salt"]).select("pivot", "node", "x", "y")


def _verify_group(num: int, den: int):
    """Links between members of one group that other links don't join already: candidates share one of the
    elements that are rarest within the group, and are then counted in full."""

    def run(group: pa.Table) -> pa.Table:
        node, label = (group[c].to_numpy() for c in ("node", "label"))
        values, edge = _lists(group["tokens"].combine_chunks())
        values, n = np.unique(values[edge[0] : edge[-1]], return_inverse=True)[1], np.diff(edge)
        first, row = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
        length = np.maximum(n - -(-num * n // den) + 1, 0)
        often = np.bincount(values)
        mine = W.spread(first, np.minimum(length, n))
        rare = values[np.lexsort((values, often[values], row))][mine]
        owner, own = row[mine], np.r_[0, np.cumsum(np.minimum(length, n))]
        order = np.argsort(rare, kind="stable")
        posting, owner = np.searchsorted(rare[order], np.arange(len(often) + 1)), owner[order]
        _, root = np.unique(label, return_inverse=True)
        found, held = [], np.zeros(len(often), bool)
        for i in range(len(node)):
            e = rare[own[i] : own[i + 1]]
            near = np.unique(owner[W.spread(posting[e], posting[e + 1] - posting[e])])
            near = near[(root[near] != root[i]) & (near < i) & (n[near] * den >= n[i] * num) & (n[i] * den >= n[near] * num)]
            if not len(near):
                continue
            held[values[first[i] : first[i] + n[i]]] = True
            common = np.add.reduceat(held[values[W.spread(first[near], n[near])]], np.r_[0, np.cumsum(n[near])[:-1]], dtype=np.int64)
            held[values[first[i] : first[i] + n[i]]] = False
            near = near[common * (den + num) >= num * (n[i] + n[near])]
            for r in np.unique(root[near]).tolist():
                found.append((node[i], node[near[root[near] == r][0]]))
                root[root == r] = root[i]
        a, b = zip(*found, strict=True) if found else ((), ())
        if len(values) > 100_000:
            W.give_back()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _shared_signatures(source: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """sig, node, w: signatures that several nodes share, each of these nodes, and how many it shares."""
    rows = source.mapInArrow(_signature_rows(k, num, den), "sig long, who long, need byte, of long")
    order = Window.partitionBy("sig").orderBy("who")
    beside = (F.lag("who").over(order) != col("who")) | (F.lead("who").over(order) != col("who"))
    members = rows.withColumn("beside", F.coalesce(beside, F.lit(False))).where("beside or need < 0")
    members = stash(members.select(F.coalesce("of", "sig").alias("sig"), "who", F.abs("need").alias("need")), "shared-signatures")
    company = members.groupBy("who").agg(F.count("*").alias("w"), F.max("need").alias("need"))
    enough = stash(company.where("w >= need").select("who"), "nodes-with-company")
    return stash(members.join(small(enough, enough.count()), "who", "left_semi").select("sig", F.expr("who - pmod(who, 2)").alias("node")), "kept-signatures")


def _with_least(groups: DataFrame, key: str) -> DataFrame:
    """(pivot, node) of the members of groups (key, node): the least member of a group is its pivot. It is found
    before members move, and they meet it in a join, which Spark splits where a group is large."""
    least = groups.groupBy(key).agg(F.min("node").alias("pivot"))
    return groups.join(least, key).where("node <> pivot").select("pivot", "node").distinct()


def _clusters(shared: DataFrame) -> DataFrame:
    """node and label of all nodes that shared signatures connect with another."""
    return stash(components(_with_least(shared, "sig").toDF("a", "b")), "clusters")


def _counters(batches):
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        flat, at = _lists(batch.column("tokens"))
        total += np.bincount(flat[at[0] : at[-1]] & np.uint64(COUNTERS - 1), minlength=COUNTERS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["place", "n"])


def _rare_elements(counted, num: int, den: int):
    """(node, e): of each set the rarest elements, one more than a linked set may lack, marked with its size
    band and, where it may be linked with a set of that, the next one."""
    starts = bands(num, den)[0]

    def run(batches):
        count = counted.value
        for batch in batches:
            flat, at = _lists(batch.column("tokens"))
            e, n = flat[at[0] : at[-1]], np.diff(at)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((e, count[e & np.uint64(COUNTERS - 1)], row))
            length = n - -(-num * n // den) + 1
            own = np.searchsorted(starts, n, "right") - 1
            for step in (0, 1):
                some = np.flatnonzero((n > 0) & ((step == 0) | (n * den >= starts[own + step] * num)))
                mine = W.spread((np.cumsum(n) - n)[some], length[some])
                marked = W.mix(e[order[mine]] ^ W.mix(np.repeat(own[some] + step, length[some]).astype(np.uint64)))
                yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(row[mine])), pa.array(W.signed(marked))], ["node", "e"])
            W.give_back()

    return run


def _groups(clusters: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(group, pivot, node): members of one cluster and of near sizes that share an element of their prefixes."""
    spark = sets.sparkSession
    counts = sets.select("tokens").mapInArrow(_counters, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(COUNTERS, np.int64)
    count[counts["place"].to_numpy()] = counts["n"].to_numpy()
    rare = sets.mapInArrow(_rare_elements(spark.sparkContext.broadcast(count), num, den), "node long, e long")
    dealt = stash(rare.join(small(clusters, clusters.count()), "node").select(F.xxhash64("label", "e").alias("shared"), "node"), "dealt-elements")
    return stash(_with_least(dealt, "shared").select(col("pivot").alias("group"), "pivot", "node"), "groups")


def _links(groups: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) that connect all that are linked among the members of each group (group, pivot, node)."""
    links, sizes = [], stash(sets.select("node", F.size("tokens").alias("n")), "sizes")
    n_sizes = sizes.count()
    while True:
        sized = groups.select("pivot", "node").distinct().join(small(sizes, n_sizes), "node").join(small(sizes.select(col("node").alias("pivot"), col("n").alias("of")), n_sizes), "pivot")
        alike = stash(sized.where(f"n * {den}L >= of * {num}L and of * {den}L >= n * {num}L").select("pivot", "node"), "pairs-of-near-sizes")
        judged = _beside_pivots(alike, sets).mapInArrow(_differ(num, den, False), "pivot long, node long, near boolean")
        links.append(stash(judged.where("near").select(col("pivot").alias("a"), col("node").alias("b")), "pivot-links"))
        labels = stash(components(_all(links)), "labels")
        labelled = groups.join(small(sizes, n_sizes), "node").join(small(labels, labels.count()), "node", "left").withColumn("label", F.coalesce("label", "node"))
        # The pivot's own links are known; what is open lies between the others.
        several = labelled.groupBy("group").agg(F.min("label").alias("low"), F.max("label").alias("high"), ((F.count("*") <= SETTLED) & (F.sum("n") <= SETTLED_ELEMENTS)).alias("few")).where("low <> high").select("group", "few")
        several = stash(several, "open-groups")
        left = stash(labelled.join(small(several, several.count()), "group"), "open-members")
        few = left.where("few")
        together = small(few, few.count()).join(sets, "node").select("group", "node", "label", "tokens")
        links.append(stash(together.groupBy("group").applyInArrow(_verify_group(num, den), "a long, b long"), "settled-links"))
        many = left.where("not few").drop("few", "n")
        if many.isEmpty():
            return _all(links)
        groups = _by_shared_differences(many, sets, num, den)


def _all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def _by_shared_differences(members: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """New groups (group, pivot, node) of members (group, pivot, node, label) that share one of the rarest
    differences from their pivot."""
    apart = stash(_beside_pivots(members.select("pivot", "node").distinct(), sets).mapInArrow(_differ(num, den, True), "pivot long, node long, near boolean, n long, apart array<long>"), "differences")
    mine = small(members, members.count()).join(apart, ["pivot", "node"])
    element = mine.select("group", "node", F.explode("apart").alias("e"))
    often = stash(element.groupBy("group", "e").agg(F.count("*").alias("df")).where("df > 1"), "frequent-differences")
    ranked = element.join(small(often, often.count()), ["group", "e"]).groupBy("group", "node").agg(F.sort_array(F.collect_list(F.struct("df", "e"))).alias("common"))
    # Elements that nobody shares come first in the order and take up their part of the prefix. Of two
    # sets the one that differs less needs the shorter prefix; a set linked to the
    # pivot never needs more than that beside one that isn't.
    most = F.expr(f"cast(({den - num} * (n + n * {den} div {num})) div {den + num} as int)")
    prefix = F.least(col("d"), F.when(col("near"), F.floor(most / 2).cast("int")).otherwise(most) + 1)
    length = F.greatest(prefix - (col("d") - F.size("common")), F.lit(0))
    known = ranked.join(mine.select("group", "node", "label", "near", "n", F.size("apart").alias("d")), ["group", "node"])
    probes = stash(known.select("group", "node", "label", F.explode(F.slice(F.transform("common", lambda t: t["e"]), F.lit(1), length)).alias("e")), "shared-differences")
    sized = probes.groupBy("group", "e").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("node").alias("pivot"), F.count("*").alias("m"), F.bit_xor(F.xxhash64("node")).alias("who"))
    heads = sized.where("low <> high").groupBy("group", "m", "who", "pivot").agg(F.min("e").alias("e"))
    into = F.when(col("m") <= SETTLED // 8, F.xxhash64("group", "pivot")).otherwise(F.xxhash64("group", "e", F.lit(1)))
    heads = stash(heads.select("group", "e", "pivot", into.alias("into")), "mixed-groups")
    found = probes.join(small(heads, heads.count()), ["group", "e"]).where("node <> pivot").select(col("into").alias("group"), "pivot", "node").distinct()
    return stash(found, "groups")


def _one_each(sets: DataFrame) -> DataFrame:
    """sets without repeated nodes (of rows that repeat a doc_id, which are few): the others aren't shuffled."""
    again = stash(sets.groupBy("node").agg(F.count("*").alias("c")).where("c > 1").select("node"), "repeated-nodes")
    n = again.count()
    if not n:
        return sets
    once = sets.join(small(again, n), "node", "left_anti")
    return stash(once.unionByName(sets.join(small(again, n), "node", "left_semi").dropDuplicates(["node"])), "sets-once")


def near_copies(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: documents whose sets of k-word shingles have a
    Jaccard similarity of at least num / den are linked, and component_id is the least doc_id that
    links reach.

    A text with fewer than k words is one shingle; null, empty and blank texts have an empty set, are linked with
    nothing and are their own component. Repeated rows have equal sets and share a component. A row with a null
    doc_id belongs with rows of an equal set and is linked with no other. Texts are read whole.
    """
    source = texts(docs)
    kind = source.schema["doc_id"].dataType.simpleString()
    described = stash(source.mapInArrow(_sizes(k), f"doc_id {kind}, n long, node long"), "described")
    reps = stash(described.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep")), "classes")
    clusters = _clusters(_shared_signatures(source, k, num, den))
    n_clusters = clusters.count()
    asked = stash(reps.join(small(clusters, n_clusters), "node", "left_semi").where("rep is not null").select(col("rep").alias("doc_id")).distinct(), "representatives")
    sets = _one_each(stash(rows_of(source, asked).mapInArrow(_sets(k), "node long, tokens array<long>"), "sets"))
    labels = components(_links(_groups(clusters, sets, num, den), sets, num, den))
    named = reps.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of_node = stash(named.join(least, "label").select("node", "component_id"), "component-of-node")
    alone = described.where("n = 0").select("doc_id", col("n").alias("n_shingles"), col("doc_id").alias("component_id"))
    return described.where("n > 0").select("doc_id", col("n").alias("n_shingles"), "node").join(of_node, "node").select("doc_id", "n_shingles", "component_id").unionByName(alone)
