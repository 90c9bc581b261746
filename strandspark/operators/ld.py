"""Correlations among the variants of a locus as a product of blocks, so that no task holds a locus."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .graphs import _saved

#: Variants of a block, and numbers that it may hold: fewer variants where there are many samples.
BLOCK, CELLS = 512, 8_000_000


#: Dosages, and correlations, that one call of Python takes on at least: a call for each block would cost more than its work.
BATCH = 100_000


def _runs(table: pa.Table, *names: str):
    """Slices of a table with equal values of names."""
    table = table.combine_chunks().sort_by([(c, "ascending") for c in names])
    if not table.num_rows:
        return
    change = np.zeros(table.num_rows - 1, bool)
    for c in names:
        x = table[c].combine_chunks()
        change |= pc.not_equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
    first = [0, *(np.flatnonzero(change) + 1).tolist(), table.num_rows]
    for i, j in zip(first, first[1:], strict=False):
        yield table.slice(i, j - i)


def _pack(rows: pa.Table) -> pa.Table:
    """Each block as one matrix of centred and scaled dosages, samples in order; a missing one is 0."""
    out = {c: [] for c in ("locus", "block", "variants", "samples", "x")}
    for part in _runs(rows, "locus", "block"):
        variants, row = np.unique(part["variant"].to_numpy(), return_inverse=True)
        samples, column = np.unique(part["sample"].to_numpy(), return_inverse=True)
        x, file = np.zeros((len(variants), len(samples))), io.BytesIO()
        x[row, column] = part["x"].to_numpy()
        np.save(file, x)
        for c, v in (("locus", part["locus"][0].as_py()), ("block", part["block"][0].as_py()), ("variants", variants), ("samples", samples), ("x", file.getvalue())):
            out[c].append(v)
    kinds = {"locus": rows.schema.field("locus").type, "block": pa.int64(), "variants": pa.list_(rows.schema.field("variant").type), "samples": pa.list_(rows.schema.field("sample").type), "x": pa.binary()}
    return pa.table({c: pa.array(out[c], kinds[c]) for c in out})


def _products(locus_type: pa.DataType, variant_type: pa.DataType):
    """Correlations of pairs of blocks, one pair a row."""

    def of_pair(row: dict) -> tuple:
        (names, x), (other, y) = (_aligned(row, side) for side in (("variants", "samples", "x", "r_samples"), ("r_variants", "r_samples", "r_x", "samples")))
        r = np.clip(x @ y.T, -1, 1)
        i, j = np.nonzero(names[:, None] < other[None, :]) if row["i"] == row["j"] else np.nonzero(names[:, None] != other[None, :])
        a, b = names[i], other[j]
        swap = b < a
        return np.where(swap, b, a), np.where(swap, a, b), r[i, j]

    def table(found: list) -> pa.RecordBatch:
        loci = pa.array([k for k, _ in found], locus_type).take(pa.array(np.repeat(np.arange(len(found)), [len(x[0]) for _, x in found])))
        i, j, r = (np.concatenate([x[k] for _, x in found]) for k in range(3))
        return pa.RecordBatch.from_arrays([loci, pa.array(i, variant_type), pa.array(j, variant_type), pa.array(r)], ["locus", "i", "j", "r"])

    def run(batches):
        found, n = [], 0
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            for k in range(batch.num_rows):
                row = {c: x[k].values.to_numpy(zero_copy_only=False) if c.endswith(("variants", "samples")) else x[k].as_py() for c, x in columns.items()}
                pair = of_pair(row)
                if len(pair[0]):
                    found.append((row["locus"], pair))
                    n += len(pair[0])
                if n >= BATCH:
                    yield table(found)
                    found, n = [], 0
        if found:
            yield table(found)

    return run


def _aligned(row: dict, names: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    variants, samples, x, others = (row[c] for c in names)
    x = np.load(io.BytesIO(x))
    if len(samples) == len(others) and (samples == others).all():
        return variants, x
    every = np.union1d(samples, others)
    out = np.zeros((len(x), len(every)))
    out[:, np.searchsorted(every, samples)] = x
    return variants, out


def ld_matrix(dosage: DataFrame, least_maf: float = 0.01, most_missing: float = 0.05, block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """dosage (locus, variant, sample, dosage): locus, i, j (i < j) and signed correlation of every pair of
    variants that pass: of at most so many missing samples among those of their locus, of no lower allele frequency, and not
    constant. Missing dosages count as the variant's mean; of a repeated one the greatest counts.

    Variants are dealt to blocks by hash, as many as the samples leave room for; each pair of blocks is one product in one task, and
    tasks grow with the square of the number of blocks."""
    known = dosage.where("locus IS NOT NULL AND variant IS NOT NULL AND sample IS NOT NULL AND dosage IS NOT NULL").groupBy("locus", "variant", "sample").agg(F.max("dosage").cast("double").alias("dosage"))
    known = _saved(known)
    # Samples of a locus count whether or not a dosage is known.
    width = dosage.where("locus IS NOT NULL AND sample IS NOT NULL").groupBy("locus").agg(F.count_distinct("sample").alias("samples"))
    stats = known.groupBy("locus", "variant").agg(F.count("*").alias("n"), F.avg("dosage").alias("mean"), F.var_pop("dosage").alias("var"))
    frequency = F.col("mean") / 2
    fit = (1 - F.col("n") / F.col("samples") <= most_missing) & (F.least(frequency, 1 - frequency) >= least_maf) & (F.col("var") > 0)
    fit_rows = _saved(stats.join(width, "locus").where(fit).select("locus", "variant", "mean", F.sqrt(F.col("var") * F.col("n")).alias("norm"), "samples"))
    most = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(cells) / F.col("samples"))))
    blocks = fit_rows.groupBy("locus", "samples").agg(F.count("*").alias("m")).select("locus", "m", "samples", F.ceil(F.col("m") / most).alias("blocks"))
    dealt = fit_rows.drop("samples").join(blocks, "locus").select("locus", "variant", "mean", "norm", F.pmod(F.xxhash64("variant"), "blocks").alias("block"))
    scaled = known.join(dealt, ["locus", "variant"]).select("locus", "block", "variant", "sample", ((F.col("dosage") - F.col("mean")) / F.col("norm")).alias("x"))
    kind = {f.name: f.dataType.simpleString() for f in dosage.schema}
    schema = f"locus {kind['locus']}, block long, variants array<{kind['variant']}>, samples array<{kind['sample']}>, x binary"
    calls = 1 + (blocks.agg(F.sum(F.col("m") * F.col("samples"))).first()[0] or 0) // BATCH
    batch = F.pmod(F.xxhash64("locus", "block"), F.lit(calls))
    packed = _saved(scaled.groupBy(batch.alias("batch")).applyInArrow(_pack, schema)).join(blocks.select("locus", "blocks"), "locus")
    # A block is the left side of pairs with itself and all after it, the right side of those with all before.
    left = packed.select("locus", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), "variants", "samples", "x")
    right = packed.select("locus", F.explode(F.sequence(F.lit(0).cast("long"), "block")).alias("i"), F.col("block").alias("j"), F.col("variants").alias("r_variants"), F.col("samples").alias("r_samples"), F.col("x").alias("r_x"))
    types = to_arrow_schema(dosage.select("locus", "variant").schema)
    run = _products(types.field("locus").type, types.field("variant").type)
    return left.join(right, ["locus", "i", "j"]).mapInArrow(run, f"locus {kind['locus']}, i {kind['variant']}, j {kind['variant']}, r double")
