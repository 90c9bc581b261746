"""Token-id files of independent zstandard frames with a trailing seek table.

A file holds documents in ascending order of doc_id. Consecutive documents share a frame of
about FRAME_IDS ids (a long document has a frame of its own); frames are compressed apart and
carry zstandard's own content checksum. Then follow two skippable frames, which any zstandard
decoder steps over: an index (doc_ids and number of ids of each document, documents of each
frame) and, last in the file, the seek table of the public seekable format: compressed size, size
and low 32 bits of the xxh64 of each frame. A reader takes the tail, then only the frames
that hold the documents asked for.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import new_folder, texts

FRAME_IDS = 1 << 15
# Fixed values of the public seekable zstandard format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUM_FLAG = 0x80
TAIL = 1 << 16


def _checksum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class FileWriter:
    """Adds documents in order; memory holds one frame and the index."""

    def __init__(self, sink) -> None:
        import zstandard

        self.sink, self.zstd = sink, zstandard.ZstdCompressor(level=3, write_checksum=True, write_content_size=True)
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.doc_ids: list[int] = []
        self.sizes: list[int] = []
        self.frames: list[tuple[int, int, int]] = []
        self.frame_docs: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self.held and self.held + len(ids) > FRAME_IDS:
            self._flush()
        self.doc_ids.append(np.iinfo(np.int64).min if doc_id is None else doc_id)
        self.sizes.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)

    def _flush(self) -> None:
        data = np.concatenate(self.waiting).astype("<u4").tobytes()
        packed = self.zstd.compress(data)
        self.sink.write(packed)
        self.frames.append((len(packed), len(data), _checksum(data)))
        self.frame_docs.append(len(self.waiting))
        self.waiting, self.held = [], 0

    def close(self) -> None:
        if self.waiting:
            self._flush()
        body = np.array(self.doc_ids, "<i8").tobytes() + np.array(self.sizes, "<u4").tobytes() + np.array(self.frame_docs, "<u4").tobytes()
        index = struct.pack("<QQ", len(self.doc_ids), len(self.frames)) + self.zstd.compress(body)
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        # Where the index begins is found from the seek table: it follows the frames' sizes.
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK, len(table)) + table)


class FileReader:
    """Reads the tail of a file at once and frames on demand, each checked twice."""

    def __init__(self, source) -> None:
        import zstandard

        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        size = source.size()
        n, flag, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError("no seek table at the end of the file")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self.frames = table
        self.begin = np.r_[0, np.cumsum(table[:, 0].astype(np.int64))]
        tag, length = struct.unpack("<II", self._at(int(self.begin[-1]), 8))
        if tag != SKIPPABLE_INDEX:
            raise ValueError("no document index before the seek table")
        index = self._at(int(self.begin[-1]) + 8, length)
        docs, frames = struct.unpack_from("<QQ", index)
        body = self.zstd.decompress(index[16:], max_output_size=12 * docs + 4 * frames) if docs else b""
        self.doc_ids = np.frombuffer(body, "<i8", docs, 0)
        self.sizes = np.frombuffer(body, "<u4", docs, 8 * docs).astype(np.int64)
        self.frame_docs = np.frombuffer(body, "<u4", frames, 12 * docs).astype(np.int64)
        self.first_doc = np.r_[0, np.cumsum(self.frame_docs)]
        self.opened = 0

    def _at(self, place: int, n: int) -> bytes:
        self.source.seek(place)
        return self.source.read(n)

    def frame(self, k: int) -> np.ndarray:
        data = self.zstd.decompress(self._at(int(self.begin[k]), int(self.frames[k, 0])), max_output_size=int(self.frames[k, 1]))
        if _checksum(data) != int(self.frames[k, 2]):
            raise ValueError(f"frame {k} is damaged")
        self.opened += 1
        return np.frombuffer(data, "<u4")

    def documents(self, wanted: set[int] | None = None):
        """(doc_id, ids) in file order, of all documents or of those wanted; frames without
        a wanted document stay compressed."""
        for k in range(len(self.frames)):
            lo, hi = int(self.first_doc[k]), int(self.first_doc[k + 1])
            ids_of = self.doc_ids[lo:hi].tolist()
            if wanted is not None and wanted.isdisjoint(ids_of):
                continue
            data, at = self.frame(k), 0
            for doc_id, n in zip(ids_of, self.sizes[lo:hi].tolist(), strict=True):
                if wanted is None or doc_id in wanted:
                    yield (None if doc_id == np.iinfo(np.int64).min else doc_id), data[at : at + n]
                at += n


def _write(folder: str, end_id: int, path: str):
    def run(batches):
        from pyspark import TaskContext

        part, writer, total = TaskContext.get().partitionId(), None, 0
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        name = f"{base}/part-{part:06d}-{uuid.uuid4().hex}.ids.zst"  # every attempt has a file of its own
        first = None
        for batch in batches:
            for lo, hi, ids, at in tokens.encoded(batch.column(1), path, end_id, added=True):
                if writer is None:
                    store.create_dir(base, recursive=True)
                    sink = store.open_output_stream(name, compression=None)
                    writer = FileWriter(sink)
                names = batch.column(0).slice(lo, hi - lo).to_pylist()
                first = names[0] if first is None else first
                for k, doc_id in enumerate(names):
                    writer.add(doc_id, ids[at[k] : at[k + 1]])
                total += len(ids)
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [name], "n_docs": [len(writer.doc_ids)], "n_ids": [total]}, schema=pa.schema([("part", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))

    return run


def _only(folder: str, names: set[str]) -> None:
    """Removes what lost attempts have left: the files named are those of the attempts that count."""
    store, base = pyarrow.fs.FileSystem.from_uri(folder)
    for found in store.get_file_info(pyarrow.fs.FileSelector(base, allow_not_found=True)):
        if found.path.endswith(".ids.zst") and found.path not in names:
            store.delete_file(found.path)


def write_token_files(docs: DataFrame, folder: str | None = None, end_id: int = 2, path: str | None = None) -> tuple[str, list]:
    """Writes docs as token files in ascending doc_id order and returns the folder and, for each
    file, (part, file, n_docs, n_ids). doc_id is an integer.

    A null or empty text is the end id alone; a null doc_id comes first; repeated rows are
    written as often as they occur, by text. No rows make no files. Other columns are left out. A task that runs twice writes
    two files, of which the driver keeps the one that counts; nothing is renamed.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    ordered = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    made = ordered.mapInArrow(_write(folder, end_id, path or tokens.vocabulary_path()), "part long, file string, n_docs long, n_ids long")
    files = sorted(tuple(r) for r in made.collect())  # a line for each file
    _only(folder, {name for _, name, _, _ in files})
    return folder, files


def _read(folder: str, wanted: frozenset | None):
    def run(batches):
        store, _ = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(name) as source:
                    reader = FileReader(source)
                    starts = base + np.r_[0, np.cumsum(reader.sizes)]
                    if wanted is None:
                        place = 0
                        rows: list[tuple] = []
                        for doc_id, ids in reader.documents():
                            rows.append((doc_id, int(starts[place]), ids))
                            place += 1
                            if len(rows) == 512:
                                yield _rows(rows)
                                rows = []
                    else:
                        at = {}
                        for k, d in enumerate(reader.doc_ids.tolist()):
                            at.setdefault(d, []).append(int(starts[k]))
                        rows = [(d, at[d].pop(0), ids) for d, ids in reader.documents(set(wanted))]
                    if rows:
                        yield _rows(rows)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    data = [np.ascontiguousarray(x[2]) for x in rows]
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()), pa.array([len(x) for x in data], pa.int64()), pa.array([zlib.crc32(x) for x in data], pa.int64()), pa.array([x.astype(np.int64) for x in data], pa.list_(pa.int64()))], ["doc_id", "start", "n_tokens", "ids_crc32", "ids"])


def read_token_files(spark: SparkSession, folder: str, files: list, wanted: frozenset | None = None) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens,
    ids_crc32 and ids. With wanted, only frames that hold one of these doc_ids are opened."""
    base, parts = 0, []
    for _part, name, _docs, n_ids in sorted(files):
        parts.append((name, base))
        base += n_ids
    listed = spark.createDataFrame(parts, "file string, base long").repartition(max(1, len(parts)))
    return listed.mapInArrow(_read(folder, wanted), "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<long>")
