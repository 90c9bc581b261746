"""Sinks. Spark's commit protocol makes each write whole or absent; Parquet is the native format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean


def write_tsv(df: DataFrame, path: str, gzip: bool = True) -> None:
    """Header, blank for NULL."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("nullValue", "").option("emptyValue", "").option("compression", "gzip" if gzip else "none").csv(path)


def finite(df: DataFrame) -> DataFrame:
    """NaN and infinities as NULL, so that JSON stays valid."""
    return df.withColumns({f.name: clean.numeric(F.col(f.name)) for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))})


def write_json(df: DataFrame, path: str, append: bool = False) -> None:
    finite(df).write.mode("append" if append else "overwrite").json(path)


def vcf_lines(df: DataFrame) -> Column:
    """The eight fixed columns of a VCF row from chrom, pos, id, ref, alt."""
    return F.concat_ws("\t", F.col("chrom").cast("string"), F.col("pos").cast("string"), F.coalesce("id", F.lit(".")), "ref", "alt", F.lit("."), F.lit("."), F.lit("."))


def write_vcf(df: DataFrame, path: str, contigs: Sequence[tuple[str, int]]) -> None:
    """Rows in order of place under path/body, header under path/header."""
    spark = df.sparkSession
    head = ["##fileformat=VCFv4.2", *(f"##contig=<ID={c},length={n}>" for c, n in contigs), "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]
    spark.createDataFrame([(h,) for h in head], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/header")
    ordered = df.repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos")
    ordered.select(vcf_lines(df).alias("value")).write.mode("overwrite").text(f"{path}/body")


def write_by_key(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """One folder per key; rows are brought together by key first, so each has few files."""
    df.repartition(*keys).write.mode("overwrite").partitionBy(*keys).parquet(path)


def graphml(nodes: DataFrame, edges: DataFrame, most: int = 20_000) -> str:
    """GraphML of a small network (node; a, b, score). More than most nodes or edges is an error:
    the tables themselves are the form for large graphs."""
    from xml.sax.saxutils import quoteattr

    n, e = nodes.limit(most + 1).collect(), edges.limit(most + 1).collect()
    if len(n) > most or len(e) > most:
        raise ValueError(f"more than {most} nodes or edges")
    body = [f"<node id={quoteattr(str(x['node']))}/>" for x in n] + [f"<edge source={quoteattr(str(x['a']))} target={quoteattr(str(x['b']))}><data key=\"score\">{x['score']}</data></edge>" for x in e]
    return '<?xml version="1.0"?><graphml xmlns="http://graphml.graphdrawing.org/xmlns"><key id="score" for="edge" attr.name="score" attr.type="double"/><graph edgedefault="undirected">' + "".join(body) + "</graph></graphml>"


def selection_ledger(df: DataFrame, reasons: Sequence[tuple[Column, str]], order: Sequence[Column], path: str | None = None) -> DataFrame:
    """Every candidate with its first exclusion reason (SELECTED without one) and its rank among the selected."""
    from pyspark.sql import Window

    from ..functions.classify import first_failure

    out = df.withColumn("reason", first_failure(tuple(reasons), "SELECTED"))
    rank = F.row_number().over(Window.partitionBy("reason").orderBy(*order))
    out = out.withColumn("rank", F.when(F.col("reason") == "SELECTED", rank))
    if path:
        out.write.mode("overwrite").parquet(path)
    return out


def _counted(df: DataFrame) -> list[Column]:
    """Rows, and a sum over them that no order changes."""
    row = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_xor(row), F.lit(0).cast("long")).alias("sum")]


def write_reconciled(df: DataFrame, path: str) -> DataFrame:
    """Writes df as Parquet and holds what was counted while writing against what is read back: rows_written, rows_read
    and reconciled (rows and their hashes agree), one row. df should give the same rows whenever it is run."""
    seen = Observation()
    df.observe(seen, *_counted(df)).write.mode("overwrite").parquet(path)
    rows, total = seen.get["rows"], seen.get["sum"]
    back = df.sparkSession.read.parquet(path)
    return back.agg(*_counted(back)).select(F.lit(rows).cast("long").alias("rows_written"), F.col("rows").alias("rows_read"), ((F.col("rows") == rows) & (F.col("sum") == F.lit(total))).alias("reconciled"))


def write_by_position(df: DataFrame, path: str, chrom: str = "chrom", pos: str = "pos") -> None:
    """A folder a chromosome, in files and row groups that each cover a stretch of positions: what region scans read."""
    df.repartitionByRange(chrom, pos).sortWithinPartitions(chrom, pos).write.mode("overwrite").partitionBy(chrom).parquet(path)


def write_pages(df: DataFrame, path: str, order: str, size: int) -> None:
    """df as landed pages of a paged interface: page-n.json with the count of all rows and up to size rows under rows, in
    order of an integer column that leaves no ties. Each page is one file."""
    import pyarrow.fs

    from ..operators import scans

    total = df.count()
    paged = scans.row_numbers(df, [], [F.col(order)], "_n").withColumn("_page", F.floor((F.col("_n") - 1) / size).cast("int"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("_n", F.struct(*(F.col(c) for c in df.columns)).alias("row")))), lambda x: x["row"])
    pages = paged.groupBy("_page").agg(F.to_json(F.struct(F.lit(total).alias("count"), rows.alias("rows"))).alias("page"))

    def land(batches):
        store, base = pyarrow.fs.FileSystem.from_uri(path)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for k, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_output_stream(f"{base}/page-{k}.json") as out:
                    out.write(page.encode())
            yield batch.select([0])

    pages.mapInArrow(land, "_page int").count()
