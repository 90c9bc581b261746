"""Words and hashes of whole texts, for a block of rows at a time.

A block is cut from Arrow's own buffers, so no Python object is made per word: a byte table
says which bytes belong to words, and words are hashed eight bytes at a time, each step a bijection of
64 bits (so that words of one length up to eight bytes never collide, whatever they hold). Blocks hold whole
texts and about BLOCK_BYTES, so memory stays flat whatever a batch holds; one long text makes one larger block.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads every bit of x over all 64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, base, np.uint64)
    down = np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse from 0 to n at least. One table per base is kept, as
    long as a common block; a very long text has its own for as long as it takes."""
    if n > 2 * BLOCK_BYTES:
        return _powers(n, _BASES[which])
    if which not in _kept or len(_kept[which][0]) <= n:
        _kept[which] = _powers(-(-(n + 1) // (1 << 17)) * (1 << 17), _BASES[which])
    return _kept[which]


_SEEDS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
#: Spans of more bytes than this are hashed by blake2b, one by one.
LONG_SPAN = 256
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_space = np.ones(256, np.uint8)
_space[[32, 9, 10, 11, 12, 13]] = 0
_alnum = np.zeros(256, np.uint8)
_alnum[48:58] = _alnum[97:123] = 1
_alnum[128:] = 1
#: (byte as hashed, group of the byte; 0 is outside words): words between blanks as they are, the
#: same in lower case, runs of lower-cased letters, digits and everything beyond ASCII, and those
#: together with runs of other visible signs.
AS_IS = (np.arange(256, dtype=np.uint8), _space)
LOWER = (_lower, _space)
ALNUM = (_lower, _alnum[_lower])
SIGNS = (_lower, np.where(_space == 0, 0, np.where(_alnum[_lower] == 1, 1, 2)).astype(np.uint8))


class Block:
    """Texts of some rows: bytes, where words start and end, and the first word of each row."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, kind) -> None:
        fold, group = kind
        self.raw, self.offsets, self._eights = raw, offsets, None
        self.bytes = fold[raw]
        n, of = len(raw), group[raw]
        turn = np.ones(n + 1, bool)  # where a text or another group of bytes begins
        turn[1:n] = of[1:] != of[:-1]
        turn[offsets] = True
        self.starts = np.flatnonzero(turn[:n] & (of != 0))
        self.ends = np.flatnonzero(turn[1:] & (of != 0)) + 1
        self.first_word = np.searchsorted(self.starts, offsets)

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first_word)

    def hashes(self, which: int = 0, first: int | None = None) -> np.ndarray:
        """Hashes of the words, or of their first so many bytes."""
        if self._eights is None:
            self._eights = eights(self.bytes)
        ends = self.ends if first is None else np.minimum(self.ends, self.starts + first)
        return span_hashes(self.bytes, self.starts, ends, which, self._eights)

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per word over the words of each row."""
        total = np.r_[0, np.cumsum(values)]
        return total[self.first_word[1:]] - total[self.first_word[:-1]]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over the bytes of each row."""
        total = np.r_[0, np.cumsum(values)]
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    @property
    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first_word) - 1), self.n_words)


def first_bytes(size: np.ndarray) -> np.ndarray:
    """Masks of the first so many bytes, at most eight, of a number of eights()."""
    return _FIRST_BYTES[np.clip(size, 0, 8)]


def eights(data: np.ndarray) -> np.ndarray:
    """At each place, it and the seven bytes after it as one number (zeros beyond the end)."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,)).astype(np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0, numbers: np.ndarray | None = None) -> np.ndarray:
    """Hashes of spans of bytes: numbers are those of eights(data)."""
    numbers = eights(data) if numbers is None else numbers
    size = ends - starts
    h = np.uint64(_SEEDS[which]) ^ mix(size.astype(np.uint64) + np.uint64(_SEEDS[1 - which]))
    h = mix(h ^ (numbers[starts] & first_bytes(size)))
    live, done = np.flatnonzero((size > 8) & (size <= LONG_SPAN)), 8
    while len(live):
        left = size[live] - done
        h[live] = mix((h[live] ^ (numbers[starts[live] + done] & first_bytes(left))) * np.uint64(_BASES[which]))
        live, done = live[left > 8], done + 8
    for k in np.flatnonzero(size > LONG_SPAN).tolist():
        key = hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8, key=bytes([which])).digest()
        h[k] = np.uint64(int.from_bytes(key, "little"))
    return h


#: Grams of more elements have no hash here: a polynomial modulo 2**64 tells longer runs of two alternating
#: values apart too badly (powers of two of them can cancel out).
LONGEST_GRAM = 64


def grams(h: np.ndarray, n: int, which: int = 0) -> np.ndarray:
    """Hash of the n hashes from each place on; the last n - 1 places have none."""
    if n > LONGEST_GRAM:
        raise ValueError(f"a gram has at most {LONGEST_GRAM} elements")
    if len(h) < n:
        return np.zeros(0, np.uint64)
    up, down = powers(len(h), which)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * up[: len(h)], out=total[1:])
    return mix((total[n:] - total[:-n]) * down[: len(h) - n + 1] + np.uint64(n))


def hashes_in_order(h: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One hash for each run of hashes (start, count), from all of its members with their places; runs
    lie one after the other and apart."""
    place = spread(np.zeros(len(starts), np.int64), counts).astype(np.uint64)
    each = mix(h[spread(starts, counts)] + mix(place * np.uint64(_BASES[1])))
    total = np.zeros(len(each) + 1, np.uint64)
    np.cumsum(each, out=total[1:])
    edge = np.r_[0, np.cumsum(counts)]
    return mix(total[edge[1:]] - total[edge[:-1]] + mix(counts.astype(np.uint64)))


def whole(first_word: np.ndarray, n: int) -> np.ndarray:
    """The places from which n words of one row follow."""
    count = np.maximum(np.diff(first_word) - n + 1, 0)
    return spread(first_word[:-1], count)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start and count, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    return np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(total)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Returns memory that a batch needed to the system: workers are kept, and others run beside them."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def cuts(column: pa.Array, limit: int | None = None) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of blocks of whole texts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not (pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)):
        column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    places = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    limit, lo = limit or BLOCK_BYTES, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(places, places[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, data[places[lo] : places[hi]], places[lo : hi + 1] - places[lo]
        lo = hi
    give_back()


def blocks(column: pa.Array, kind, limit: int | None = None) -> Iterator[tuple[int, int, Block]]:
    for lo, hi, raw, offsets in cuts(column, limit):
        yield lo, hi, Block(raw, offsets, kind)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
