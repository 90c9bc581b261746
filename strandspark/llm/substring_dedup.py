"""Removal of repeated passages: exact, at any number of documents.

Equal texts are one class from the start, named by the least doc_id. A window of `window` words lies in the run
of windows that share its least gram of `gram` words (a minimiser, chosen by content alone), so equal
windows meet under one anchor. Anchors of a single document are dropped at once; the rest have their runs of
words, each distinct one once, dealt to shards by anchor. A shard indexes its runs (FM-index over a
wavelet matrix) and streams them against it by backward search; wherever the match is `window` words
or longer, the least doc_id among its occurrences is reported. Results go back to every class that holds the run.

An anchor with more than `company` distinct runs (the edge of a passage that thousands of documents share, each
in its own context) would make one shard as large as its company. Its runs are cut, by where the anchor stands in a
window, into shorter runs of `WIDTHS` windows, dealt by the words that all windows of a cut have in common: equal
windows still meet. A cut that is still crowded is cut again, at last into single windows, of which equal
ones are one run. Every cut is indexed and searched as any run is, and what is found goes back along the cuts.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import rows_of, small, stash, texts
from .fm_index import FMIndex

#: Windows to a run where an anchor is crowded, by turns; the last must be 1.
WIDTHS = (8, 1)
NO_WORDS = hashlib.sha256(b"").hexdigest()


def _joined(block: W.Block, keep: np.ndarray | None = None) -> list[bytes]:
    """Per row its words (those kept), joined by single blanks."""
    starts, ends, row = block.starts, block.ends, block.row_of_word
    if keep is not None:
        starts, ends, row = starts[keep], ends[keep], row[keep]
    size = ends - starts + 1
    at = W.spread(starts, size)
    flat = block.bytes[np.minimum(at, max(len(block.bytes) - 1, 0))]
    edge = np.r_[0, np.cumsum(size)]
    flat[edge[1:] - 1] = 32
    data, first = flat.tobytes(), edge[np.searchsorted(row, np.arange(len(block.first_word)))].tolist()
    return [data[a : b - 1] if b > a else b"" for a, b in zip(first[:-1], first[1:], strict=True)]


def _keys(block: W.Block) -> np.ndarray:
    return W.hashes_in_order(block.hashes(), block.first_word[:-1], block.n_words)


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    n, step, least = len(x) - width + 1, 1, x
    while step * 2 <= width:
        least = np.minimum(least[: len(least) - step], least[step:])
        step *= 2
    return np.minimum(least[:n], least[width - step : width - step + n])


def _runs(block: W.Block, window: int, gram: int):
    """(row, start in row, windows, anchor, hash of the run's words) of all runs."""
    at, h = W.whole(block.first_word, window), block.hashes()
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    anchor = _sliding_least(W.grams(h, gram), window - gram + 1)[at]
    row = block.row_of_word[at]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
    count = np.diff(np.r_[new, len(at)])
    return row[new], at[new] - block.first_word[row[new]], count, anchor[new], W.hashes_in_order(W.grams(h, window)[at], new, count)


_run = pa.struct([("anchor", pa.int64()), ("run", pa.int64()), ("start", pa.int32()), ("n", pa.int32())])


def _describe(window: int, gram: int):
    def go(batches):
        for batch in batches:
            for lo, hi, block in W.blocks(batch.column("text"), W.AS_IS):
                row, start, count, anchor, run = _runs(block, window, gram)
                edge = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                flat = pa.StructArray.from_arrays([pa.array(W.signed(anchor)), pa.array(W.signed(run)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))], fields=list(_run))
                sha = [hashlib.sha256(x).hexdigest() for x in _joined(block)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(block.n_words.astype(np.int64)), pa.array(W.signed(_keys(block))), pa.array(sha), pa.ListArray.from_arrays(edge, flat)], ["doc_id", "n_words", "key", "sha", "runs"])

    return go


def _said(block: W.Block, first: np.ndarray, end: np.ndarray) -> list[bytes]:
    """The words from first up to end (numbers in the block), joined by single blanks."""
    data = block.bytes.tobytes()
    return [b" ".join(data[x:y] for x, y in zip(block.starts[a:b].tolist(), block.ends[a:b].tolist(), strict=True)) for a, b in zip(first.tolist(), end.tolist(), strict=True)]


def _extract(window: int):
    """The words of each run asked for."""

    def go(batches):
        for batch in batches:
            asked, keys, ids = batch.column("asked"), batch.column("key").to_numpy(), batch.column("doc_id").to_numpy()
            anchor, run, start, n, last = (asked.values.field(k).to_numpy() for k in range(5))
            edge = asked.offsets.to_numpy()
            for lo, hi, block in W.blocks(batch.column("text"), W.AS_IS):
                same = W.signed(_keys(block)) == keys[lo:hi]
                count = np.diff(edge[lo : hi + 1]).astype(np.int64)
                row = np.repeat(np.arange(hi - lo), count)
                mine = W.spread(edge[lo:hi].astype(np.int64), count)
                row, mine = row[same[row]], mine[same[row]]
                first = block.first_word[row] + start[mine]
                said = _said(block, first, first + n[mine] + window - 1)
                yield pa.RecordBatch.from_arrays([pa.array(anchor[mine]), pa.array(anchor[mine]), pa.array(run[mine]), pa.array(ids[lo:hi][row]), pa.array(last[mine]), pa.array(said, pa.binary())], ["place", "anchor", "run", "rep", "last", "words"])

    return go


def _cut(window: int, gram: int, width: int):
    """Shorter runs: windows that have the same anchor at places of one stretch of `width`. Each knows the run it
    was cut from and where it began there; its place is the hash of the words common to all windows so placed."""

    def go(batches):
        for batch in batches:
            anchors, runs, reps, lasts = (batch.column(c).to_numpy() for c in ("anchor", "run", "rep", "last"))
            for lo, hi, block in W.blocks(batch.column("words").cast(pa.large_binary()), W.AS_IS):
                h, row_of, first, end, core, common = block.hashes(), [], [], [], [], []
                g = W.signed(W.grams(h, gram))
                for k in range(hi - lo):
                    base, n = int(block.first_word[k]), int(block.n_words[k]) - window + 1
                    at = np.flatnonzero(g[base : base + n + window - gram] == anchors[lo + k])
                    place = at[np.searchsorted(at, np.arange(n))]
                    part = (place - np.arange(n)) // width
                    new = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (place[1:] != place[:-1])])
                    least = part[new] * width  # words before the anchor: from least to most
                    most = np.minimum(least + width - 1, window - gram)
                    row_of.append(np.full(len(new), k))
                    first.append(base + new)
                    end.append(base + np.r_[new[1:], n] + window - 1)
                    core.append(base + place[new] - least)
                    common.append(window - most + least)
                if not row_of:
                    continue
                row, a, b, c, size = (np.concatenate(x).astype(np.int64) for x in (row_of, first, end, core, common))
                mine = lo + row
                yield pa.RecordBatch.from_arrays(
                    [pa.array(W.signed(W.hashes_in_order(h, c, size))), pa.array(anchors[mine]), pa.array(W.signed(W.hashes_in_order(h, a, b - a))), pa.array(runs[mine]), pa.array(a - block.first_word[row]), pa.array(reps[mine]), pa.array(lasts[mine]), pa.array(_said(block, a, b), pa.binary())],
                    ["place", "anchor", "run", "parent", "offset", "rep", "last", "words"],
                )

    return go


def _search_shard(window: int):
    def go(shard: pa.Table) -> pa.Table:
        run, rep, last = (shard[c].to_numpy() for c in ("run", "rep", "last"))
        found: list[tuple] = []
        column = shard["words"].combine_chunks()
        _lo, _hi, block = next(W.blocks(column.cast(pa.large_binary()), W.AS_IS, 1 << 40))
        symbols = np.unique(block.hashes(), return_inverse=True)[1]
        first = block.first_word
        index = FMIndex(symbols, first, window)
        least = index.least_of_groups(rep)
        size = np.diff(first)
        order = np.argsort(-size, kind="stable")
        lo, hi = np.zeros(len(size), np.int64), np.full(len(size), index.n)
        cells = np.full(len(symbols), np.iinfo(np.int64).max)
        for t in range(int(size.max())):
            live = order[: np.searchsorted(-size[order], -t, "left")]  # sequences with more than t words
            at = first[1:][live] - 1 - t
            lo[live], hi[live] = index.step(symbols[at], lo[live], hi[live])
            if t + 1 >= window:
                cells[at] = least[index.group[lo[live]]]
        for k in np.flatnonzero(size >= window).tolist():
            m = cells[first[k] : first[k] + size[k] - window + 1]
            cut = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(m)], strict=True):
                if m[a] < last[k]:
                    found.append((int(run[k]), a, b, int(m[a])))
        cols = list(zip(*found, strict=True)) or [()] * 4
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("run", "lo", "hi", "least"), cols, strict=True)})

    return go


def _remove(window: int):
    def go(batches):
        for batch in batches:
            spans, keys = batch.column("spans"), batch.column("key").to_numpy()
            edge, fields = spans.offsets.to_numpy(), spans.values
            starts, ends = (fields.field(k).to_numpy() for k in range(2))
            for lo, hi, block in W.blocks(batch.column("text"), W.AS_IS):
                same = W.signed(_keys(block)) == keys[lo:hi]
                depth = np.zeros(len(block.starts) + 1, np.int64)
                mine = W.spread(edge[lo:hi].astype(np.int64), np.diff(edge[lo : hi + 1]).astype(np.int64))
                base = np.repeat(np.where(same, block.first_word[:-1], -1), np.diff(edge[lo : hi + 1]))
                good = base >= 0
                np.add.at(depth, (base + starts[mine])[good], 1)
                np.add.at(depth, (base + ends[mine])[good], -1)
                gone = np.cumsum(depth[:-1]) > 0
                sha = [hashlib.sha256(x).hexdigest() for x in _joined(block, np.flatnonzero(~gone))]
                keep = pa.array(same)
                yield pa.RecordBatch.from_arrays([x.filter(keep) for x in (batch.column("key").slice(lo, hi - lo), pa.array(block.per_row(gone).astype(np.int64)), pa.array(sha))], ["key", "removed", "kept_sha"])

    return go


def repeated_passages(docs: DataFrame, window: int = 50, gram: int = 20, company: int = 4_096, shard_words: int = 100_000) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256. A word goes if it lies in a window of so many
    consecutive words whose sequence also starts in a row with a smaller doc_id.

    Null, empty and short texts keep all they have. Repeated rows with one doc_id don't remove each
    other's words; a null doc_id is neither smaller nor larger than any, so such rows
    keep all words and remove none. Texts are read whole. A window of more than 64 words (words.LONGEST_GRAM) is a ValueError.
    """
    source = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    runs = "array<struct<anchor:bigint,run:bigint,start:int,n:int>>"
    described = stash(source.mapInArrow(_describe(window, gram), f"doc_id long, n_words long, key long, sha string, runs {runs}"), "described")
    longer = described.where(F.col("doc_id").isNotNull() & (F.size("runs") > 0))
    classes = stash(longer.groupBy("key").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("top"), F.first("runs").alias("runs")), "classes")
    every = classes.select("key", "rep", F.explode("runs").alias("r")).select("key", "rep", "r.*")
    shared = stash(every.groupBy("anchor").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("anchor"), "shared-anchors")
    found = stash(every.join(small(shared, shared.count()), "anchor"), "runs-of-shared-anchors")
    distinct = stash(found.groupBy("anchor", "run").agg(F.min(F.struct("rep", "key", "start", "n")).alias("first"), F.max("rep").alias("last")), "distinct-runs")
    asked = stash(distinct.groupBy(F.col("first.rep").alias("doc_id"), F.col("first.key").alias("key")).agg(F.collect_list(F.struct("anchor", "run", F.col("first.start").alias("start"), F.col("first.n").alias("n"), "last")).alias("asked")), "asked-runs")
    wanted = rows_of(source, stash(asked.select("doc_id").distinct(), "asked-documents"))
    cells = "place long, anchor long, run long, rep long, last long, words binary"
    pieces = stash(wanted.join(asked, "doc_id").select("doc_id", "text", "key", "asked").mapInArrow(_extract(window), cells).dropDuplicates(["run"]), "pieces")
    total = distinct.agg(F.sum(F.col("first.n") + window)).first()[0] or 0

    settled, cuts = [], []
    for width in WIDTHS:
        crowded = stash(pieces.groupBy("place").agg(F.count("*").alias("c")).where(F.col("c") > company).select("place"), "crowded")
        n_crowded = crowded.count()
        if not n_crowded:
            break
        settled.append(pieces.join(small(crowded, n_crowded), "place", "left_anti"))
        cut = stash(pieces.join(small(crowded, n_crowded), "place", "left_semi").select("anchor", "run", "rep", "last", "words").mapInArrow(_cut(window, gram, width), "place long, anchor long, run long, parent long, offset long, rep long, last long, words binary"), "cut-runs")
        cuts.append(cut.select("run", "parent", "offset"))
        # Places of one document have nothing to give or to lose.
        company_of = stash(cut.groupBy("place").agg(F.min("rep").alias("low"), F.max("last").alias("high")).where("low < high").select("place"), "shared-places")
        several = cut.join(small(company_of, company_of.count()), "place", "left_semi")
        pieces = stash(several.groupBy("place", "anchor", "run").agg(F.min(F.struct("rep", "words")).alias("first"), F.max("last").alias("last")).select("place", "anchor", "run", "first.rep", "last", "first.words"), "distinct-cuts")
        total += pieces.count() * (window + width)
    settled.append(pieces)
    n_shards = max(1, -(-int(total) // shard_words))
    runs_of_all = functools.reduce(DataFrame.unionByName, settled).select("place", "run", "rep", "last", "words")
    searched = runs_of_all.withColumn("shard", F.pmod("place", F.lit(n_shards))).drop("place").groupBy("shard").applyInArrow(_search_shard(window), "run long, lo long, hi long, least long")
    matches = stash(searched, "matches")
    for cut in reversed(cuts):  # what is found in a cut holds in the run it came from
        back = matches.join(cut, "run").select(F.col("parent").alias("run"), (F.col("lo") + F.col("offset")).alias("lo"), (F.col("hi") + F.col("offset")).alias("hi"), "least")
        matches = matches.unionByName(back)

    spans = found.join(matches, "run").where("least < rep").select("key", F.col("rep").alias("doc_id"), F.struct((F.col("start") + F.col("lo")).cast("int").alias("a"), (F.col("start") + F.col("hi") + (window - 1)).cast("int").alias("b")).alias("s"))
    by_class = stash(spans.groupBy("key", "doc_id").agg(F.collect_list("s").alias("spans")), "spans")
    touched = rows_of(source, stash(by_class.select("doc_id").distinct(), "touched-documents"))
    kept = stash(touched.join(by_class, "doc_id").select("key", "text", "spans").mapInArrow(_remove(window), "key long, removed long, kept_sha string").dropDuplicates(["key"]), "kept")
    # Only classes with copies or with removals change what their rows keep.
    changed = stash(classes.select("key", "rep", "top").join(kept, "key", "left").where("rep < top or removed is not null").select("key", "rep", "removed", "kept_sha"), "changed")
    joined = described.select("doc_id", "n_words", "key", "sha").join(changed, "key", "left")
    copy, first = F.col("doc_id") > F.col("rep"), (F.col("doc_id") == F.col("rep")) & F.col("removed").isNotNull()
    return joined.select("doc_id", "n_words", F.when(copy, F.col("n_words")).when(first, F.col("removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"), F.when(copy, F.lit(NO_WORDS)).when(first, F.col("kept_sha")).otherwise(F.col("sha")).alias("kept_sha256"))
