"""Small helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows, and bytes, that travel to a Python worker at a time: whole texts are long, and both sides hold a batch or two.
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS rows and BATCH_BYTES, unless they are smaller already."""
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows, "10000")) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    if spark.conf.get(size, "64m") in ("64m", "67108864b"):
        spark.conf.set(size, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir as the cluster
    sets it. Only where it is unset (tests, one machine) a temporary folder is made."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strandspark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


_made: list[list[str]] = []


def _on_store(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def new_folder(spark: SparkSession, label: str) -> str:
    """A new name in the shared folder; the file system removes it when the JVM ends, or passing() before."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    store, jvm_path = _on_store(spark, path)
    store.deleteOnExit(jvm_path)
    if _made:
        _made[-1].append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    store, jvm_path = _on_store(spark, path)
    store.delete(jvm_path, True)


@contextlib.contextmanager
def passing(spark: SparkSession):
    """Folders made inside go at its end: what reads them must have been written by then."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            remove_folder(spark, path)


def stash(df: DataFrame, label: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: the lineage ends
    there, and a lost executor costs no more than the reader's own tasks."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    bound_batches(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(name: str, *taken: str) -> str:
    """name, lengthened until no taken column has it (Spark's names ignore case)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, whatever else the table holds; a null text is empty."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def crc32_of_id(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary"))


#: Rows of at most a few dozen bytes that may be broadcast, once counted.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """df marked for broadcast if it is known to have few rows; else joins on it shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def rows_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is in ids (distinct, not null, stashed)."""
    return docs.join(small(ids, ids.count()), "doc_id", "left_semi")
