"""Harmonic packing of token sequences.

A document of L ids belongs to the reciprocal class k = floor(capacity / L): k documents of class k always fit a
sequence, whatever their lengths. Every task fills the sequences of its own classes with k documents each, on its
own, and cuts the longest of its documents only to fill what those sequences leave open. A text of
capacity ids or more first gives off whole sequences. Documents of a class that don't make up a sequence yet wait for
the task's next block (fewer than k of each class); at the end of the task they are laid one after the other, and the last
sequence is cut into powers of two, so nothing is padded. The number of sequences of
each task, a table as small as the number of tasks, gives each task its first sequence_id.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import stash, texts
from .words import spread


class Spans:
    """Stretches of documents: which document, first id there, length, ids of the document, place in the pool."""

    FIELDS = ("doc", "start", "length", "doc_tokens", "at")

    def __init__(self, *columns: np.ndarray) -> None:
        self.doc, self.start, self.length, self.doc_tokens, self.at = columns

    def part(self, which: np.ndarray, skip=0, length: np.ndarray | None = None) -> Spans:
        """The spans at these places, without their first so many ids, of these lengths."""
        return Spans(self.doc[which], self.start[which] + skip, self.length[which] - skip if length is None else length, self.doc_tokens[which], self.at[which] + skip)

    def __add__(self, other: Spans) -> Spans:
        return Spans(*(np.concatenate([getattr(self, f), getattr(other, f)]) for f in self.FIELDS))

    def __len__(self) -> int:
        return len(self.length)


def _lay(spans: Spans, sizes: np.ndarray) -> tuple[Spans, np.ndarray, np.ndarray, Spans]:
    """Spans laid one after the other into slots of these sizes: pieces, slot and offset in the slot of
    each, and what is left of the spans."""
    ends, edges = np.cumsum(spans.length), np.cumsum(sizes)
    total = int(edges[-1]) if len(edges) else 0
    cuts = np.unique(np.concatenate([[0, total], ends[ends < total], edges]))
    first, last = cuts[:-1], cuts[1:]
    of, slot = np.searchsorted(ends, first, "right"), np.searchsorted(edges, first, "right")
    pieces = spans.part(of, first - (ends - spans.length)[of], last - first)
    rest = np.flatnonzero(ends > total)
    return pieces, slot, first - (edges - sizes)[slot], spans.part(rest, np.maximum(total - (ends - spans.length)[rest], 0))


def _powers_of_two(n: int) -> list[int]:
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


class Packer:
    """One task's sequences; settle() takes the spans at hand and returns pieces, their sequences and offsets,
    and the spans that wait."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.sequences = capacity, 0

    def _whole(self, spans: Spans) -> tuple[Spans, Spans]:
        full = spans.length // self.capacity
        of = np.repeat(np.arange(len(spans)), full)
        pieces = spans.part(of, spread(np.zeros(len(full), np.int64), full) * self.capacity, np.full(len(of), self.capacity))
        left = np.flatnonzero(spans.length % self.capacity)
        return pieces, spans.part(left, full[left] * self.capacity)

    def _new(self, n: int) -> np.ndarray:
        self.sequences += n
        return np.arange(self.sequences - n, self.sequences)

    def settle(self, spans: Spans, last: bool = False) -> tuple[Spans, np.ndarray, np.ndarray, Spans]:
        pieces, spans = self._whole(spans)
        sequence, offset = self._new(len(pieces)), np.zeros(len(pieces), np.int64)
        spans = spans.part(np.argsort(-spans.length, kind="stable"))
        if last:
            total = int(spans.length.sum())
            sizes = np.array([self.capacity] * (total // self.capacity) + _powers_of_two(total % self.capacity), np.int64)
            more, slot, place, waiting = _lay(spans, sizes)
            sequence, offset = np.r_[sequence, self._new(len(sizes))[slot]], np.r_[offset, place]
            return pieces + more, sequence, offset, waiting
        if not len(spans):
            return pieces, sequence, offset, spans
        # The longest come first, so classes are runs; from the first of those that aren't cut on, each
        # class fills as many sequences as it can.
        k = self.capacity // spans.length
        begin = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        each, end, total = k[begin], np.r_[begin[1:], len(k)], np.r_[0, np.cumsum(spans.length)]

        def filled(m: int) -> tuple[np.ndarray, np.ndarray, int]:
            """First document and number of sequences of each class, and what they leave open, if m are cut."""
            lo = np.minimum(np.maximum(begin, m), end)
            n = (end - lo) // each
            return lo, n, int((n * self.capacity - total[lo + n * each] + total[lo]).sum())

        low, high = 0, len(spans)
        while low < high:  # about the fewest that fill all that is left open
            m = (low + high) // 2
            low, high = (low, m) if total[m] >= filled(m)[2] else (m + 1, high)
        while total[low] < filled(low)[2]:
            low += 1
        lo, n, _ = filled(low)
        mine = spread(lo, n * each)
        per = np.repeat(each, n)  # documents of each sequence
        edge = np.r_[0, np.cumsum(per)]
        size = np.r_[0, np.cumsum(spans.length[mine])]
        gaps = self.capacity - (size[edge[1:]] - size[edge[:-1]])
        made = self._new(len(per))
        open_ones = np.flatnonzero(gaps)
        cut, slot, place, rest = _lay(spans.part(np.arange(low)), gaps[open_ones])
        unfinished = spread(lo + n * each, end - lo - n * each)
        pieces = pieces + spans.part(mine) + cut
        sequence = np.concatenate([sequence, np.repeat(made, per), made[open_ones[slot]]])
        offset = np.concatenate([offset, size[:-1] - np.repeat(size[edge[:-1]], per), (self.capacity - gaps)[open_ones[slot]] + place])
        return pieces, sequence, offset, spans.part(unfinished) + rest


def _pieces(capacity: int, end_id: int, path: str, with_ids: bool):
    def run(batches):
        from pyspark import TaskContext

        task, packer = TaskContext.get().partitionId(), Packer(capacity)
        held, pool, names = Spans(*(np.zeros(0, np.int64) for _ in Spans.FIELDS)), np.zeros(0, np.uint32), None

        def rows(spans: Spans, pool: np.ndarray, names: pa.Array, last: bool = False):
            nonlocal held
            pieces, sequence, offset, held = packer.settle(spans, last)
            data = memoryview(np.ascontiguousarray(pool, "<u4").view(np.uint8))
            crc = np.fromiter((zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(pieces.at.tolist(), pieces.length.tolist(), strict=True)), np.int64, len(pieces))
            columns = [names.take(pa.array(pieces.doc)), *map(pa.array, (pieces.start, pieces.length, crc, pieces.doc_tokens, np.full(len(pieces), task, np.int64), sequence, offset))]
            made = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "sequence", "offset"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(np.r_[0, np.cumsum(pieces.length)].astype(np.int32), pa.array(pool[spread(pieces.at, pieces.length)].astype(np.int32))))
                made.append("ids")
            return pa.RecordBatch.from_arrays(columns, made)

        for batch in batches:
            for lo, hi, ids, first in tokens.encoded(batch.column(1), path, end_id, added=True):
                n, known = np.diff(first), 0 if names is None else len(names)
                mine = batch.column(0).slice(lo, hi - lo)
                names = mine if names is None else pa.concat_arrays([names, mine])
                fresh = Spans(known + np.arange(hi - lo), np.zeros(hi - lo, np.int64), n, n, len(pool) + first[:-1])
                pool = np.concatenate([pool, ids])
                yield rows(held + fresh, pool, names)
                # Only what waits is kept.
                pool, names = pool[spread(held.at, held.length)], names.take(pa.array(held.doc))
                held = Spans(np.arange(len(held)), held.start, held.length, held.doc_tokens, np.cumsum(held.length) - held.length)
        if len(held):
            yield rows(held, pool, names, last=True)

    return run


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 1, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with with_ids
    the piece's ids.

    capacity is a power of two. A null or empty text is the end id alone. Repeated rows are
    packed as often as they occur; a very long text fills many whole sequences; no rows
    give no pieces. Other columns are not looked at.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{c} long" for c in ("start", "length", "ids_crc32", "doc_tokens", "task", "sequence", "offset"))
    pieces = stash(texts(docs).mapInArrow(_pieces(capacity, end_id, path or tokens.vocabulary_path(), with_ids), f"doc_id {kind}, {longs}" + (", ids array<int>" if with_ids else "")), "pieces")
    counts = pieces.groupBy("task").agg((F.max("sequence") + 1).alias("n"))
    before = counts.select("task", F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    placed = pieces.join(F.broadcast(before), "task")  # a row for each task
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("sequence") + F.col("before")).cast("long").alias("sequence_id"), "offset", *(["ids"] if with_ids else []))
