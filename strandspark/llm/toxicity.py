"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: density, number and variety of lexicon words in plain and in disguised writing, their
nearness to second-person words, capitals, punctuation, and rates of digits inside words and
stretched letters. Beside the fixed lexicon stand learnt ones, of words and of word beginnings (so that
inflected and foreign words count): the log odds of a text with the word to be labelled 1, counted over
the sample. Rows that grow the trees or fit the calibration see lexicons counted on the other half.
Trees are grown on histograms of a bounded sample of labelled rows (SAMPLE, taken by hash of doc_id); a
fourth of the sample is kept from the trees and fits the calibration. Every text is scored where it lies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import stash, texts, unused

SAMPLE = 20_000
NEAR = 5
#: Part of a score that is the trees' own; the rest is calibrated.
ORDER = 0.02
#: Learnt lexicons: of the first so many bytes of words (None: whole words), at 2**PLACES places each;
#: a word counts with LEAST texts labelled 1 and is strong from log odds of STRONG on.
BEGINNINGS = (None, 4, 6, 8)
PLACES, LEAST, STRONG = 17, 3, 1.5
# Insults and threats, and words that address the reader.
LEXICON = (
    "abscheulich abschaum asshole bastard bitch bollocks clown connard coward crap creep cretin degenerate dick disgusting douche dumb dumbass dummkopf dégoûtant estúpido "
    "filth filthy freak fuck fucking garbage gilipollas hate hateful hideous idiot idiota idiote idiotic ignorant imbecile imbécil imbécile jerk kill liar loser losers lowlife maggot "
    "miserable monster moron moronic nasty nutjob pathetic perdedor pig pitiful psycho puta retard retarded rubbish salaud scum scumbag shit shut sick sicko slut stupid stupide "
    "suck sucks terrible toxic trash trashy ugly useless verlierer vermin vile whore worthless wretch"
).split()
SECOND_PERSON = "you your yours yourself youre u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch usted ustedes tú ti tus vuestro".split()

_leet = np.arange(256, dtype=np.uint8)
_leet[65:91] += 32
for _a, _b in zip(b"0134578@$!", b"oieastbasi", strict=True):
    _leet[_a] = _b
_leet_group = np.zeros(256, np.uint8)
_leet_group[97:123] = 1
_leet_group[128:] = 1
_LEET = (_leet, np.where(np.isin(np.arange(256), list(b"!")), 0, _leet_group[_leet]).astype(np.uint8))
_letter = np.zeros(256, bool)
_letter[65:91] = _letter[97:123] = True
_letter[128:] = True

FEATURES = ("log_words", "lexicon", "lexicon_density", "lexicon_variety", "second_person", "near_second_person", "near_density", "capitals", "capital_words", "punctuation", "exclamations", "questions", "disguised", "disguised_density", "digits_in_words", "stretched", "word_length", "densest", *(f"{what}_{b or 'word'}" for b in BEGINNINGS for what in ("strong", "strong_density", "odds")))


def _hashes_of(terms: list[str]) -> np.ndarray:
    block = next(W.blocks(pa.array([" ".join(terms)]), W.ALNUM))[2]
    return np.unique(block.hashes())


def _member(h: np.ndarray, of: np.ndarray) -> np.ndarray:
    return of[np.minimum(np.searchsorted(of, h), len(of) - 1)] == h


def features(block: W.Block, disguise: W.Block, lexicon: np.ndarray, second: np.ndarray, learnt: np.ndarray) -> np.ndarray:
    raw, n = block.raw, len(block.first_word) - 1
    words = np.maximum(block.n_words, 1).astype(np.float64)
    size = np.maximum(np.diff(block.offsets), 1).astype(np.float64)
    h = block.hashes()
    bad, you, row = _member(h, lexicon), _member(h, second), block.row_of_word
    lex = block.per_row(bad)
    pairs = np.unique(np.stack([row[bad], np.searchsorted(lexicon, h[bad])], 1), axis=0) if bad.any() else np.zeros((0, 2), np.int64)
    variety = np.bincount(pairs[:, 0], minlength=n)
    near = np.zeros(len(h), bool)
    for k in range(1, NEAR + 1):
        same = row[k:] == row[:-k]
        near[k:] |= bad[k:] & you[:-k] & same
        near[:-k] |= bad[:-k] & you[k:] & same
    close = block.per_row(near)
    capital = (raw >= 65) & (raw <= 90)
    letters = np.maximum(block.per_text(_letter[raw]), 1)
    caps = np.r_[0, np.cumsum(capital)]
    length = block.ends - block.starts
    shouted = (caps[block.ends] - caps[block.starts] == length) & (length > 2)
    digit = np.r_[0, np.cumsum((raw >= 48) & (raw <= 57))]
    digits = digit[block.ends] - digit[block.starts]
    mixed = (digits > 0) & (digits < length)
    run = np.zeros(len(raw), bool)
    run[2:] = (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2]) & _letter[raw[2:]]
    runs = np.r_[0, np.cumsum(run)]
    stretched = runs[block.ends] > runs[block.starts]
    hidden = np.maximum(disguise.per_row(_member(disguise.hashes(), lexicon)) - lex, 0)
    # The most lexicon words in any 32 words, so that one bad passage of a long text shows.
    total = np.r_[0, np.cumsum(bad)]
    end = np.minimum(np.arange(len(h)) + 32, np.repeat(block.first_word[1:], block.n_words))
    ahead = total[end] - total[:-1]
    densest = np.zeros(n)
    np.maximum.at(densest, row[bad], ahead[bad])
    punct = (raw > 32) & (raw < 127) & ~_letter[raw] & ~((raw >= 48) & (raw <= 57))
    more = []
    for odds, places in zip(learnt, _places(block), strict=True):
        w = odds[places]
        strong = block.per_row(w >= STRONG)
        more += [strong, strong / words, block.per_row(w.astype(np.float64)) / words]
    return np.stack([np.log1p(block.n_words), lex, lex / words, variety, block.per_row(you) / words, close, close / words, block.per_text(capital) / letters, block.per_row(shouted) / words, block.per_text(punct) / size, block.per_text(raw == 33) / size, block.per_text(raw == 63) / size, hidden, hidden / words, block.per_row(mixed) / words, block.per_row(stretched) / words, block.per_row(length) / words, densest, *more], 1)


def _places(block: W.Block):
    return ((block.hashes(first=b) >> np.uint64(64 - PLACES)).astype(np.int64) for b in BEGINNINGS)


def feature_blocks(column: pa.Array, learnt: np.ndarray):
    lexicon, second = _hashes_of(list(LEXICON)), _hashes_of(list(SECOND_PERSON))
    for lo, hi, raw, offsets in W.cuts(column):
        yield lo, hi, features(W.Block(raw, offsets, W.ALNUM), W.Block(raw, offsets, _LEET), lexicon, second, learnt)


def _half(ids: np.ndarray) -> np.ndarray:
    return (W.mix(ids.astype(np.uint64) + np.uint64(11)) & np.uint64(1)).astype(np.int64)


def _counts(batches):
    """Texts of each half and label that hold a word, by lexicon and place; summed by task."""
    n = 1 << PLACES
    seen, total = np.zeros((len(BEGINNINGS), 4, n), np.int32), np.zeros(4, np.int64)
    for batch in batches:
        group = 2 * _half(batch.column("doc_id").to_numpy()) + batch.column("y").to_numpy()
        total += np.bincount(group, minlength=4)
        for lo, _hi, block in W.blocks(batch.column("text"), W.ALNUM):
            for k, places in enumerate(_places(block)):
                pair = np.unique(block.row_of_word << PLACES | places)
                np.add.at(seen[k], (group[lo + (pair >> PLACES)], pair & (n - 1)), 1)
    if total.any():
        kind, place = np.nonzero(seen.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[kind, -1]), pa.array(np.r_[place, 0]), *(pa.array(np.r_[seen[kind, g, place].astype(np.int64), total[g]]) for g in range(4))], ["kind", "place", "a0", "a1", "b0", "b1"])


def learn_lexicons(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log odds by lexicon and place: counted on all of the sample, on its second half (for rows of
    the first), and on its first half."""
    summed = sample.mapInArrow(_counts, "kind long, place long, a0 long, a1 long, b0 long, b1 long").groupBy("kind", "place").agg(*(F.sum(c).alias(c) for c in ("a0", "a1", "b0", "b1")))
    rows = summed.where((F.col("kind") < 0) | (F.col("a1") + F.col("b1") >= LEAST)).toArrow()
    kind, place, a0, a1, b0, b1 = (rows[c].to_numpy() for c in ("kind", "place", "a0", "a1", "b0", "b1"))
    whole, of = kind >= 0, []
    for clean, bad in ((a0 + b0, a1 + b1), (b0, b1), (a0, a1)):
        odds = np.zeros((len(BEGINNINGS), 1 << PLACES), np.float32)
        if not whole.all() and bad[~whole].sum() and clean[~whole].sum():
            w = np.log((bad + 0.5) / (bad[~whole].sum() + 1)) - np.log((clean + 0.5) / (clean[~whole].sum() + 1))
            odds[kind[whole], place[whole]] = np.where(bad >= LEAST, w, 0)[whole]
        of.append(odds)
    return of[0], of[1], of[2]


class Boosted:
    """Logistic loss, trees of fixed depth over quantile bins; each split halves a node by the
    best gain, with least_rows rows on either side."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 48, least_rows: int = 20, ridge: float = 1.0) -> None:
        self.trees, self.depth, self.rate, self.bins, self.least_rows, self.ridge = trees, depth, rate, bins, least_rows, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T, strict=True)], 1)
        mean = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
        self.start = float(np.log(mean / (1 - mean)))
        raw, self.grown = np.full(len(y), self.start), []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-raw))
            grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
            split = np.full((2**self.depth - 1, 2), (-1, 0), np.int64)
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first, width = 2**level - 1, 2**level
                best = np.zeros(width)
                for f, edges in enumerate(self.edges):
                    if not len(edges):
                        continue
                    n_bins = len(edges) + 1
                    key = (node - first) * n_bins + binned[:, f]
                    g, h, c = (np.bincount(key, w, width * n_bins).reshape(width, n_bins).cumsum(1) for w in (grad, hess, np.ones(len(y))))
                    all_g, all_h, all_c = g[:, -1:], h[:, -1:], c[:, -1:]
                    gain = g**2 / (h + self.ridge) + (all_g - g) ** 2 / (all_h - h + self.ridge) - all_g**2 / (all_h + self.ridge)
                    gain = np.where((c >= self.least_rows) & (all_c - c >= self.least_rows), gain, 0)[:, :-1]
                    at = gain.argmax(1)
                    better = gain[np.arange(width), at] > best + 1e-9
                    split[first : first + width][better] = np.stack([np.full(width, f), at], 1)[better]
                    best = np.maximum(best, gain[np.arange(width), at])
                node = self._down(split, node, binned)
            leaf = node - (2**self.depth - 1)
            value = self.rate * np.bincount(leaf, grad, 2**self.depth) / (np.bincount(leaf, hess, 2**self.depth) + self.ridge)
            self.grown.append((split, value))
            raw += value[leaf]
        return self

    @staticmethod
    def _down(split: np.ndarray, node: np.ndarray, binned: np.ndarray) -> np.ndarray:
        f, at = split[node, 0], split[node, 1]
        right = (f >= 0) & (binned[np.arange(len(node)), np.maximum(f, 0)] > at)
        return 2 * node + 1 + right

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(self.edges, x.T, strict=True)], 1)
        raw = np.full(len(x), self.start)
        for split, value in self.grown:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = self._down(split, node, binned)
            raw += value[node - (2**self.depth - 1)]
        return raw


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a rising curve from margin to share of label 1, one for each pool
    at its mean margin. Half a row of the overall share is added to each pool, so that none claims certainty."""
    order = np.argsort(margin, kind="stable")
    pools: list[list[float]] = []
    for m, t in zip(margin[order].tolist(), y[order].tolist(), strict=True):
        pools.append([t, 1.0, m, m])
        while len(pools) > 1 and (pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1] or pools[-2][3] == m):
            t1, n1, sum1, hi = pools.pop()
            pools[-1] = [pools[-1][0] + t1, pools[-1][1] + n1, pools[-1][2] + sum1, hi]
    share = np.array([(total + 0.5 * y.mean()) / (n + 0.5) for total, n, _, _ in pools])
    return np.array([sums / n for _, n, sums, _ in pools]), np.maximum.accumulate(share)


class Model:
    """score(features) in 0..1. Without both labels in the sample every text gets the
    share of label 1 (0 without labels)."""

    def __init__(self, x: np.ndarray, y: np.ndarray, fold: np.ndarray) -> None:
        self.constant = None
        if len(y) < 40 or y.min() == y.max():
            self.constant = float(y.mean()) if len(y) else 0.0
            return
        grow = fold != 0
        if y[grow].min() == y[grow].max() or y[~grow].size == 0 or y[~grow].min() == y[~grow].max():
            grow = np.ones(len(y), bool)
        self.trees = Boosted().fit(x[grow], y[grow])
        kept = ~grow if not grow.all() else grow
        self.knots, self.shares = isotonic(self.trees.margin(x[kept]), y[kept])

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        margin = self.trees.margin(x)
        # A little of the margin itself keeps the order of texts between and beyond the knots.
        return np.clip((1 - ORDER) * np.interp(margin, self.knots, self.shares) + ORDER / (1 + np.exp(-np.clip(margin, -35, 35))), 0, 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, bound: int) -> DataFrame:
    """doc_id, text and y of at most bound labelled rows, the first by hash of doc_id; the bound is what
    lets the sample's ids be broadcast. Rows with a null doc_id or label are left out; an id that repeats in
    docs counts with one of its texts, so the bound holds for what is joined too."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learn)
    picked = usable.select("doc_id", (F.col(label) == 1).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(bound)
    found = stash(texts(docs).join(F.broadcast(picked), "doc_id"), "labelled")
    again = found.groupBy("doc_id", "y").agg(F.count("*").alias("c")).where("c > 1")
    return found if again.isEmpty() else stash(found.groupBy("doc_id", "y").agg(F.min("text").alias("text")), "labelled-once")


def train(docs: DataFrame, labels: DataFrame, learn: Column, bound: int = SAMPLE) -> tuple[Model, np.ndarray]:
    sample = labelled_sample(docs, labels, "toxic", learn, bound).select(F.col("doc_id").cast("long").alias("doc_id"), "y", "text")
    final, *halves = learn_lexicons(sample)
    shared = docs.sparkSession.sparkContext.broadcast(halves)

    def run(batches):
        for batch in batches:
            half = _half(batch.column("doc_id").to_numpy())
            for k, learnt in enumerate(shared.value):
                part = batch.filter(pa.array(half == k))
                for lo, hi, x in feature_blocks(part.column("text"), learnt):
                    mine = part.slice(lo, hi - lo)
                    yield pa.RecordBatch.from_arrays([mine.column("doc_id"), mine.column("y"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "y", "x"])

    rows = sample.mapInArrow(run, "doc_id long, y int, x array<double>").toArrow()
    ids, y = rows["doc_id"].to_numpy(), rows["y"].to_numpy().astype(np.float64)
    x = np.array(rows["x"].combine_chunks().flatten()).reshape(len(y), len(FEATURES))
    order = np.lexsort((*x.T, y, ids))  # the same sample gives the same trees
    fold = (W.mix(ids[order].astype(np.uint64)) % np.uint64(4)).astype(np.int64)
    return Model(x[order], y[order], fold), final


def score(docs: DataFrame, labels: DataFrame, learn: Column, bound: int = SAMPLE, keep: tuple[str, ...] = (), into: str = "score") -> DataFrame:
    """doc_id, the columns in keep, and score (0..1, named as into says) of every row. Null texts are empty; they and texts
    without words get the score of their features, as all others; repeated rows score alike."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, learn, bound))
    names = ["doc_id", *keep]
    whole = unused("_text", *names)
    source = docs.select(*names, F.coalesce(F.col("text").cast("string"), F.lit("")).alias(whole))

    def run(batches):
        for batch in batches:
            column = batch.column(whole)
            got = np.concatenate([model.value[0].score(x) for _, _, x in feature_blocks(column, model.value[1])] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(got)], [*names, into])

    fields = ", ".join(f"`{n}` {source.schema[n].dataType.simpleString()}" for n in names)
    return source.mapInArrow(run, f"{fields}, `{into}` double")
