"""Benchmark decontamination by winnowing.

Of every six neighbouring five-word grams the one with the least hash is kept, with its place: that is the
fingerprint of the ten-word window they span. Documents and benchmark choose alike, so equal windows have equal
fingerprints at equal places. A bitmap of the benchmark's fingerprints (of a size that follows their number, FILTER_BITS at
most) turns nearly all of the documents' away; what is left is joined with the benchmark by fingerprint and by what lies around
it, two 64-bit hashes of the whole window, and hits that touch are extended to one span. An item with fewer words than a
window is one window of its own length, and its own fingerprint.

Each window of the benchmark is one row of the join, however many items share it, so a prompt that all items begin
with costs no more than one. Items come last: windows of the same items name one set, documents with
the same sets look up their union once. No side passes through the driver, of any size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import small, stash, unused

#: The bitmap has a bit for each value of so many first bits of a fingerprint: 2 MB at least, 64 MB at most.
FILTER_BITS = (24, 29)
CHUNK = 4096
GRAM = 5
KEY = ("length", "mark", "one", "two")


def _winnowed(grams: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Place of the least gram of each window of size words (the first of equal ones)."""
    least, place = grams[at], at.copy()
    for k in range(1, size - GRAM + 1):
        other = grams[at + k]
        less = other < least
        least, place = np.where(less, other, least), np.where(less, at + k, place)
    return place


def _windows(block: W.Block, lengths, size: int, bits: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(length, places, fingerprints, first and second hashes) of the windows of each length whose fingerprint is in bits."""
    words = None
    for length in lengths:
        at = W.whole(block.first_word, length)
        if not len(at):
            continue
        words = words if words is not None else block.hashes(0)
        gram = GRAM if length == size and size > GRAM else length
        grams = W.grams(words, gram)
        mark = W.mix(grams[_winnowed(grams, at, length) if gram < length else at] + np.uint64(length))
        if bits is not None:
            key = mark >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
            kept = (bits[(key >> np.uint64(3)).astype(np.int64)] >> (key & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at, mark = at[kept], mark[kept]
        if len(at):
            yield length, at, mark, W.grams(words, length)[at], W.grams(block.hashes(1), length, 1)[at]


def _window_rows(size: int):
    """(item, length, mark, one, two) of every window of the benchmark."""

    def run(batches):
        for batch in batches:
            for lo, hi, block in W.blocks(batch.column(1), W.ALNUM):
                item, n = batch.column(0).slice(lo, hi - lo), block.n_words
                for length, at, *hashes in _windows(block, [x for x in np.unique(np.minimum(n, size)).tolist() if x], size):
                    row = np.searchsorted(block.first_word, at, "right") - 1
                    own = (n[row] == length) | (length == size)  # a shorter item is one window
                    yield pa.RecordBatch.from_arrays([item.take(pa.array(row[own])), pa.array(np.full(int(own.sum()), length, np.int32)), *(pa.array(W.signed(x[own])) for x in hashes)], ["item", *KEY])

    return run


def _bits(n_bits: int):
    """Chunks of the bitmap of a task's fingerprints."""

    def run(batches):
        bits = np.zeros(1 << (n_bits - 3), np.uint8)
        for batch in batches:
            key = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - n_bits)
            np.bitwise_or.at(bits, (key >> np.uint64(3)).astype(np.int64), (1 << (key & np.uint64(7))).astype(np.uint8))
        some = np.flatnonzero(bits.reshape(-1, CHUNK).any(1))
        for k in np.array_split(some, len(some) // 1_000 + 1):
            yield pa.RecordBatch.from_arrays([pa.array(k), pa.array([bits[x * CHUNK : (x + 1) * CHUNK].tobytes() for x in k.tolist()], pa.binary())], ["chunk", "bits"])

    return run


def _either(group: pa.Table) -> pa.Table:
    chunk = np.zeros(CHUNK, np.uint8)
    for x in group["bits"].to_pylist():
        chunk |= np.frombuffer(x, np.uint8)
    return pa.table({"chunk": group["chunk"][:1].combine_chunks(), "bits": pa.array([chunk.tobytes()], pa.binary())})


def _bitmap(windows: DataFrame, n: int):
    """The bitmap of all fingerprints, for the tasks: its size has a bound, whatever the benchmark's is."""
    n_bits = min(max(FILTER_BITS[0], (16 * n).bit_length()), FILTER_BITS[1])
    bits = np.zeros(1 << (n_bits - 3), np.uint8)
    chunks = windows.select("mark").mapInArrow(_bits(n_bits), "chunk long, bits binary").groupBy("chunk").applyInArrow(_either, "chunk long, bits binary").toArrow()
    for k, x in zip(chunks["chunk"].to_pylist(), chunks["bits"].to_pylist(), strict=True):
        bits[k * CHUNK : (k + 1) * CHUNK] = np.frombuffer(x, np.uint8)
    return windows.sparkSession.sparkContext.broadcast(bits)


_PLACES = pa.list_(pa.int32())
_FOUND = pa.list_(pa.struct([("length", pa.int32()), ("mark", pa.int64()), ("one", pa.int64()), ("two", pa.int64()), ("places", _PLACES)]))
_FOUND_SQL = "array<struct<length:int,mark:bigint,one:bigint,two:bigint,places:array<int>>>"


def _found(block: W.Block, lengths, size: int, bits: np.ndarray) -> pa.Array:
    """Per row the distinct windows that may be the benchmark's, each with its places in the row."""
    parts = [(np.full(len(at), length, np.int32), at, *hashes) for length, at, *hashes in _windows(block, lengths, size, bits)]
    length, at, mark, one, two = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int32), *(np.zeros(0, np.int64),) * 4)
    row = np.searchsorted(block.first_word, at, "right") - 1
    order = np.lexsort((at, two, one, length, row))
    length, at, mark, one, two, row = (x[order] for x in (length, at, mark, one, two, row))
    new = np.r_[True, (row[1:] != row[:-1]) | (length[1:] != length[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])][: len(row)]
    first = np.flatnonzero(new)
    places = pa.ListArray.from_arrays(pa.array(np.r_[first, len(row)], pa.int32()), pa.array((at - block.first_word[row]).astype(np.int32)))
    each = pa.StructArray.from_arrays([pa.array(length[first]), *(pa.array(x[first].view(np.int64)) for x in (mark, one, two)), places], fields=list(_FOUND.value_type))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row[first], np.arange(len(block.n_words) + 1)), pa.int32()), each)


def _scan(bitmap, lengths: list[int], size: int, schema: pa.Schema):
    """Rows with a number, their words and the windows found; all but the text travels along."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            for lo, hi, block in W.blocks(batch.column(0), W.ALNUM):
                part, n = batch.slice(lo, hi - lo), hi - lo
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(1, batch.num_columns)), pa.array(np.arange(number, number + n)), pa.array(block.n_words.astype(np.int64)), _found(block, lengths, size, bitmap.value)], schema=schema)
                number += n

    return run


_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _united(batches):
    """Spans of hits, joined where they touch or overlap."""
    for batch in batches:
        out = []
        for each in batch.column(1).to_pylist():
            spans: list[dict] = []
            for start, end in sorted((p, p + x["length"]) for x in each for p in x["places"]):
                if spans and start <= spans[-1]["end"]:
                    spans[-1]["end"] = max(end, spans[-1]["end"])
                else:
                    spans.append({"start": start, "end": end})
            out.append(spans)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), batch.column(2)], ["row", "spans", "sets"])


class Benchmark:
    """Windows of a benchmark (item_id, text), each once, with the set of items that it names."""

    def __init__(self, benchmark: DataFrame, size: int) -> None:
        self.size = size
        item = F.coalesce(F.col("item_id").cast("string"), F.lit("None")).alias("item")
        rows = benchmark.select(item, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(_window_rows(size), "item string, length int, mark long, one long, two long")
        self.rows = stash(rows.distinct(), "benchmark-windows")
        # A set of items is told by two sums over distinct rows, so no list is made for each window.
        self.windows = stash(self.rows.groupBy(*KEY).agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("item")).alias("x"), F.bit_xor(F.xxhash64(F.lit(7), "item")).alias("y")).select(*KEY, F.struct("n", "x", "y").alias("set")), "windows")
        self.n = self.windows.count()
        self.lengths = sorted(r[0] for r in self.windows.select("length").distinct().collect())  # at most size of them
        self.bitmap = _bitmap(self.windows, self.n)

    def candidates(self, source: DataFrame) -> DataFrame:
        """source (text, ...) without text, with row, n_words and found, saved."""
        from pyspark.sql.pandas.types import to_arrow_schema

        names = source.columns[1:]
        fields = T.StructType([*(source.schema[c] for c in names), T.StructField("row", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("found", T._parse_datatype_string(_FOUND_SQL))])
        out = to_arrow_schema(T.StructType(fields.fields[:-1])).append(pa.field("found", _FOUND))
        return stash(source.mapInArrow(_scan(self.bitmap, self.lengths, self.size, out), fields), "candidates")

    def hits(self, found: DataFrame, key: str) -> DataFrame:
        """key, length, places and set of the windows that are the benchmark's."""
        each = found.where(F.size("found") > 0).select(key, F.explode("found").alias("w")).select(key, *(F.col(f"w.{c}").alias(c) for c in (*KEY, "places")))
        return each.join(small(self.windows, self.n), [*KEY]).select(key, "length", "places", "set")

    def items_of(self, sets: DataFrame) -> DataFrame:
        """sets and items, the ids of all items of distinct arrays of sets."""
        of_set = self.windows.groupBy("set").agg(F.min(F.struct(*KEY)).alias("w")).select("set", "w.*")
        members = self.rows.join(of_set, [*KEY]).groupBy("set").agg(F.array_sort(F.collect_list("item")).alias("items"))
        united = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
        return sets.select("sets", F.explode("sets").alias("set")).join(members, "set").groupBy("sets").agg(united.alias("items"))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """text_md5 of the texts of docs in which a window of the benchmark occurs, each once."""
    known = Benchmark(benchmark, size)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = known.candidates(docs.select(text.alias("text"), F.md5(text).alias("text_md5")))
    return known.hits(found, "text_md5").select("text_md5").distinct()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, size: int = 10, keep: tuple[str, ...] = (), into: tuple[str, str, str] = ("n_words", "items", "hits"), describe: Callable[[Column], Column] = lambda items: items,
) -> DataFrame:
    """Per row of docs: doc_id, the columns named in keep, and as into names them n_words, items (ids of the benchmark
    items with a window that occurs, as strings in order) and hits (spans of words inside
    such windows, joined where they touch or overlap). describe turns the items into what is wanted of them, once for
    all documents with the same ones.

    Null and empty texts have no words and hit nothing; repeated rows each get their own
    row; an empty benchmark hits nothing; a null item_id is reported as "None", and items of one id are one; a text of any
    length is read whole. Other columns of either table are not looked at. size is 64 words at most.
    """
    known = Benchmark(benchmark, size)
    # Columns travel under numbers, so that no name of docs can clash.
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    names = ["doc_id", *keep]
    found = known.candidates(docs.select(text, *(F.col(c).alias(f"_{k}") for k, c in enumerate(names))))
    sets = F.array_sort(F.collect_set("set")).alias("sets")
    hit = known.hits(found, "row").groupBy("row").agg(F.collect_list(F.struct("length", "places")).alias("spans"), sets)
    kinds = "row long, spans array<struct<start:int,end:int>>, sets array<struct<n:bigint,x:bigint,y:bigint>>"
    hit = stash(hit.mapInArrow(_united, kinds), "hits")
    items = known.items_of(hit.select("sets").distinct()).select("sets", describe(F.col("items")).alias("items"))
    hit = hit.join(items, "sets").select("row", "spans", "items")
    none = describe(F.array().cast("array<string>"))
    columns = lambda items, spans: [*(F.col(f"_{k}").alias(c) for k, c in enumerate(names)), F.col("n_words").alias(into[0]), items.alias(into[1]), spans.alias(into[2])]
    clean = found.where(F.size("found") == 0).select(*columns(none, F.array().cast(_SPANS)))
    seen = found.where(F.size("found") > 0).join(hit, "row", "left").select(*columns(F.coalesce("items", none), F.coalesce(F.col("spans"), F.array().cast(_SPANS))))
    return clean.unionByName(seen)
