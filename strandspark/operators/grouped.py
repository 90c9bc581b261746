"""Kernels whose steps depend on each other within a locus: loci in parallel, several small ones to a call. Each is a
short numpy function under groupBy().applyInPandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .graphs import _saved


def susie(z: np.ndarray, r: np.ndarray, n: int, effects: int = 10, iterations: int = 100, tolerance: float = 1e-3, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Sum of single effects from z scores and correlations (Wang 2020, Zou 2022), residual variance 1:
    (effects x variants) inclusion probabilities, and log Bayes factors."""
    p = len(z)
    r = (r + r.T) / 2
    r = (1 - ridge) * r
    np.fill_diagonal(r, 1.0)
    z = z * np.sqrt((n - 1) / (z**2 + n - 2))
    xty, diag = np.sqrt(n - 1) * z, float(n - 1)
    effects = min(effects, p)
    alpha, mean, second = np.full((effects, p), 1 / p), np.zeros((effects, p)), np.zeros((effects, p))
    prior, lbf = np.full(effects, 0.2), np.zeros((effects, p))
    s2 = 1 / diag
    last = alpha.copy()
    for _ in range(iterations):
        total = mean.sum(0)
        for k in range(effects):
            residual = xty - (n - 1) * (r @ (total - mean[k]))
            beta = residual * s2
            lbf[k] = 0.5 * np.log(s2 / (s2 + prior[k])) + 0.5 * beta**2 / s2 * prior[k] / (s2 + prior[k])
            w = np.exp(lbf[k] - lbf[k].max())
            alpha[k] = w / w.sum()
            variance = 1 / (1 / s2 + 1 / prior[k]) if prior[k] > 0 else 0.0
            mu = variance / s2 * beta
            total -= mean[k]
            mean[k], second[k] = alpha[k] * mu, alpha[k] * (mu**2 + variance)
            total += mean[k]
            prior[k] = max(second[k].sum(), 1e-12)  # EM
        if np.abs(alpha - last).max() < tolerance:
            break
        last = alpha.copy()
    return alpha, lbf


def _matrix(s: pd.DataFrame, edges: pd.DataFrame) -> np.ndarray:
    """Correlations (i, j, r) as a matrix in the order of s."""
    r, at = np.eye(len(s)), pd.Index(s.variant)
    i, j = at.get_indexer(edges.i), at.get_indexer(edges.j)
    both = (i >= 0) & (j >= 0)
    r[i[both], j[both]] = r[j[both], i[both]] = edges.r.to_numpy()[both]
    return r


def mismatch(z: np.ndarray, r: np.ndarray, n: int) -> float:
    """How far z scores and correlations disagree: the s from 0 to 1 for which z is likeliest under
    (1 - s) R + s I (Zou 2022). The likelihood is taken along R's eigenvectors; a grid, then golden sections about its best."""
    z = z * np.sqrt((n - 1) / (z**2 + n - 2))
    values, vectors = np.linalg.eigh((r + r.T) / 2)
    values, square = np.maximum(values, 0.0), (vectors.T @ z) ** 2

    def loss(s: float) -> float:
        d = np.maximum((1 - s) * values + s, 1e-8)
        return float(0.5 * np.log(d).sum() + 0.5 * (square / d).sum())

    grid = np.linspace(0, 1, 41)
    best = int(np.argmin([loss(s) for s in grid]))
    low, high, turn = grid[max(best - 1, 0)], grid[min(best + 1, 40)], (5**0.5 - 1) / 2
    a, b = high - turn * (high - low), low + turn * (high - low)
    fa, fb = loss(a), loss(b)
    while high - low > 1e-7:
        if fa <= fb:
            high, b, fb = b, a, fa
            a = high - turn * (high - low)
            fa = loss(a)
        else:
            low, a, fa = a, b, fb
            b = low + turn * (high - low)
            fb = loss(b)
    return min((loss(s), s) for s in (0.0, (low + high) / 2, 1.0))[1]


def _fit(s: pd.DataFrame, r: np.ndarray, coverage: float, effects: int, least_purity: float):
    """(number, members, probabilities, log Bayes factors) of the components of one locus; members are none where
    the set is not pure enough or equal to an earlier one. s is in the order of the matrix."""
    alpha, lbf = susie(s.z.to_numpy(float), r, int(s.n.max()), effects)
    seen = set()
    for k, (a, factors) in enumerate(zip(alpha, lbf, strict=True), 1):
        order = np.argsort(-a, kind="stable")
        mine = order[: int(np.searchsorted(np.cumsum(a[order]), coverage)) + 1]
        if tuple(sorted(mine)) in seen or np.abs(r[np.ix_(mine, mine)]).min() < least_purity:
            mine = mine[:0]
        else:
            seen.add(tuple(sorted(mine)))
        yield k, mine, a, factors


def _known(s: pd.DataFrame) -> pd.DataFrame:
    return s.dropna(subset=["z"]).sort_values("variant").reset_index(drop=True)


#: Traits of a locus that one call fits, and cells of correlations that a call takes on at least.
TRAITS, CELLS = 16, 50_000


def _by_locus(stats: DataFrame, ld: DataFrame, fit, schema: str) -> DataFrame:
    """fit(key, known stats of a trait, their correlations) over all traits of all loci: small loci share a call, and
    traits of a locus share its correlations, which are sent once for so many traits. stats has locus, trait, variant, z, n."""
    stats = _saved(stats.select("locus", "trait", "variant", "z", "n"))
    sizes = _saved(stats.groupBy("locus").agg(F.count_distinct("trait").alias("traits"), F.count_distinct("variant").cast("double").alias("m")))
    calls = int(1 + (sizes.agg(F.sum(F.col("m") * F.col("m"))).first()[0] or 0) // CELLS)
    crowded = _saved(sizes.where(F.col("traits") > TRAITS).select("locus", F.ceil(F.col("traits") / TRAITS).alias("parts")))
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    batch = F.pmod(F.xxhash64("locus"), F.lit(calls)).alias("_batch")
    left = stats.join(crowded, "locus", "left").select(batch, F.pmod(F.xxhash64("trait"), parts).alias("_part"), "locus", "trait", "variant", "z", "n")
    copies = ld.join(sizes.select("locus"), "locus", "left_semi").join(crowded, "locus", "left")
    right = copies.select(batch, F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("_part"), "locus", "i", "j", "r")
    empty = pd.DataFrame(columns=[f.split()[0] for f in schema.split(", ")])

    def run(key: tuple, s: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        out, of_locus = [], edges.groupby("locus").indices
        for locus, mine in s.groupby("locus", dropna=False):
            near = edges.iloc[of_locus.get(locus, [])]
            every = mine[["variant"]].drop_duplicates().sort_values("variant").reset_index(drop=True)
            whole, at = _matrix(every, near), pd.Index(every.variant)
            for trait, x in mine.groupby("trait", dropna=False):
                x = _known(x)
                if len(x):
                    k = at.get_indexer(x.variant)
                    r = whole[np.ix_(k, k)]
                    np.fill_diagonal(r, 1.0)
                    out += fit((locus, trait), x, r)
        return pd.concat(out) if out else empty

    return left.groupBy("_batch", "_part").cogroup(right.groupBy("_batch", "_part")).applyInPandas(run, schema)


def fine_map(stats: DataFrame, ld: DataFrame, coverage: float = 0.95, effects: int = 10, least_purity: float = 0.5) -> DataFrame:
    """stats (locus, variant, z, n) and ld (locus, i, j, r): locus, variant, pip, sets (names like L1;L3).
    A component without a set of purity least_purity, or equal to an earlier one, names none."""

    def fit(key: tuple, s: pd.DataFrame, r: np.ndarray) -> list[pd.DataFrame]:
        names, none = [[] for _ in range(len(s))], np.ones(len(s))
        for k, mine, alpha, _ in _fit(s, r, coverage, effects, least_purity):
            none *= 1 - alpha
            for v in mine:
                names[v].append(f"L{k}")
        return [pd.DataFrame({"locus": key[0], "variant": s.variant, "pip": 1 - none, "sets": [";".join(x) for x in names]})]

    kinds = dict(stats.dtypes)
    one = stats.select("locus", F.lit("").alias("trait"), "variant", "z", "n")
    return _by_locus(one, ld, fit, f"locus {kinds['locus']}, variant {kinds['variant']}, pip double, sets string")


def signals(stats: DataFrame, ld: DataFrame, coverage: float = 0.95, effects: int = 10, least_purity: float = 0.5) -> DataFrame:
    """stats (locus, trait, variant, z, n) and ld (locus, i, j, r): locus, trait, component, variant and lbf, the log
    Bayes factors of every variant in each component that names a credible set. The traits of a locus are fitted
    apart, each on the correlations among its own variants alone."""

    def fit(key: tuple, s: pd.DataFrame, r: np.ndarray) -> list[pd.DataFrame]:
        found = _fit(s, r, coverage, effects, least_purity)
        return [pd.DataFrame({"locus": key[0], "trait": key[1], "component": k, "variant": s.variant, "lbf": lbf}) for k, mine, _, lbf in found if len(mine)]

    kinds = dict(stats.dtypes)
    return _by_locus(stats, ld, fit, f"locus {kinds['locus']}, trait {kinds['trait']}, component int, variant {kinds['variant']}, lbf double")


def ld_mismatch(stats: DataFrame, ld: DataFrame) -> DataFrame:
    """stats (locus, trait, variant, z, n) and ld (locus, i, j, r): locus, trait, s (see mismatch), max_abs_z and n_variants."""

    def fit(key: tuple, s: pd.DataFrame, r: np.ndarray) -> list[pd.DataFrame]:
        row = (*key, mismatch(s.z.to_numpy(float), r, int(s.n.max())), float(s.z.abs().max()), len(s))
        return [pd.DataFrame([row], columns=["locus", "trait", "s", "max_abs_z", "n_variants"])]

    kinds = dict(stats.dtypes)
    return _by_locus(stats, ld, fit, f"locus {kinds['locus']}, trait {kinds['trait']}, s double, max_abs_z double, n_variants long")
