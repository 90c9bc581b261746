"""Quality by logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader updates.

Words and runs of signs, and pairs of neighbouring ones, are hashed to 2**BITS places; a text is the sparse
vector of its damped counts, scaled to length one. A bounded sample of labelled rows (SAMPLE, taken by
hash of doc_id) trains the weights in one task; scoring a text is one sparse dot product where it lies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .toxicity import labelled_sample

SAMPLE = 12_000
BITS = 18
EPOCHS = 3


def vectors(column: pa.Array):
    """(first row, end row, row, place, value) by block; each row's values have length one."""
    for lo, hi, block in W.blocks(column, W.SIGNS):
        row, h = block.row_of_word, block.hashes()
        pair = W.whole(block.first_word, 2)
        places = np.concatenate([h, W.grams(h, 2)[pair]]) >> np.uint64(64 - BITS)
        key = np.concatenate([row, row[pair]]).astype(np.int64) << BITS | places.astype(np.int64)
        key, count = np.unique(key, return_counts=True)
        of, value = key >> BITS, 1 + np.log(count)
        norm = np.sqrt(np.bincount(of, value**2, hi - lo))
        yield lo, hi, of, key & ((1 << BITS) - 1), value / norm[of]


class Leader:
    """FTRL-Proximal with a rate for each coordinate (McMahan et al. 2013)."""

    def __init__(self, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)  # the last place is the constant

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def update(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
        g = (p - y) * x
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def _learn(batches):
    rows = []
    for batch in batches:
        edge = batch.column("at").offsets.to_numpy()
        at, x = batch.column("at").values.to_numpy(), batch.column("x").values.to_numpy()
        rows += [(d, y, np.r_[at[a:b], 1 << BITS], np.r_[x[a:b], 1.0]) for d, y, a, b in zip(batch.column("doc_id").to_pylist(), batch.column("y").to_pylist(), edge[:-1], edge[1:], strict=True)]
    ids = np.array([r[0] for r in rows], np.int64)
    order = np.lexsort((np.array([len(r[2]) for r in rows]), W.mix(ids.astype(np.uint64)))) if rows else []
    leader = Leader()
    for _ in range(EPOCHS):
        for k in order:
            _, y, at, x = rows[k]
            leader.update(at, x, float(y))
    w = leader.weights(slice(None))
    at = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["at", "w"])


def train(docs: DataFrame, labels: DataFrame, learn: Column, bound: int = SAMPLE) -> np.ndarray:
    def sparse(batches):
        for batch in batches:
            for lo, hi, of, at, x in vectors(batch.column("text")):
                edge = np.searchsorted(of, np.arange(hi - lo + 1)).astype(np.int32)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), pa.ListArray.from_arrays(edge, pa.array(at)), pa.ListArray.from_arrays(edge, pa.array(x))], ["doc_id", "y", "at", "x"])

    sample = labelled_sample(docs, labels, "quality", learn, bound).select(F.col("doc_id").cast("long").alias("doc_id"), "y", "text")
    rows = sample.mapInArrow(sparse, "doc_id long, y int, at array<bigint>, x array<double>").repartition(1)
    learnt = rows.mapInArrow(_learn, "at long, w double").toArrow()
    weights = np.zeros((1 << BITS) + 1)
    weights[learnt["at"].to_numpy()] = learnt["w"].to_numpy()
    return weights


def score(docs: DataFrame, labels: DataFrame, learn: Column, bound: int = SAMPLE) -> DataFrame:
    """doc_id and score (0..1) of every row. A null text is empty; a text without words has the
    score of the constant alone; repeated rows score alike; without labels every score is 0.5."""
    weights = docs.sparkSession.sparkContext.broadcast(train(docs, labels, learn, bound))
    source = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            w, got = weights.value, [np.zeros(0)]
            for lo, hi, of, at, x in vectors(batch.column("text")):
                got.append(1 / (1 + np.exp(-np.clip(np.bincount(of, w[at] * x, hi - lo) + w[-1], -35, 35))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.concatenate(got))], ["doc_id", "score"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")
