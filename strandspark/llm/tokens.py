"""Token ids of whole texts, each distinct stretch encoded once.

Byte-level BPE of this family always begins a new token at a single blank between two
visible characters, before and after a single line feed between such, and between a letter and a sign
after it, so a text's ids are those of the stretches between these places, one after the
other. The vocabulary's added tokens, like <|endoftext|>, are stretches of their own with their one id, as the library
has it by default. Stretches repeat far more than texts do: each worker keeps the ids of
the stretches it has seen (at most CACHE of them) and has the tokenizers library encode the rest. A stretch
is taken for one seen before only if all of its bytes are equal. A tokenizer of another kind is given whole texts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from . import words as W

#: Stretches that a worker keeps: about 60 bytes each. When there are more, it begins anew.
CACHE = 1_200_000
#: Bytes of texts taken on at a time (twice as many took as long and 45 MB more of a worker).
BLOCK_BYTES = 1 << 20
DEFAULT = "byte_bpe_50k.json"

_visible = np.zeros(256, bool)
_visible[33:127] = True
_visible[128:] = True
_firm = _visible.copy()  # not the first byte of a blank beyond ASCII either
_firm[128:0xC3] = _firm[0xE0:] = False
_letter = np.zeros(256, bool)
_letter[65:91] = _letter[97:123] = True
_sign = _visible & ~_letter
_sign[48:58] = _sign[128:] = False


def vocabulary_path(name: str = DEFAULT) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _cuts_hold(tokenizer) -> bool:
    """Whether it splits texts as the rules above count on: byte-level BPE with the usual pattern."""
    made = json.loads(tokenizer.to_str())
    before = made.get("pre_tokenizer") or {}
    usual = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    plain = not made.get("normalizer") and not made.get("truncation") and not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in made.get("added_tokens", ()))
    return bool(usual and plain and made["model"].get("type") == "BPE")


def stretch_cuts(raw: np.ndarray) -> np.ndarray:
    """Places within texts at which a new token always begins."""
    cut = np.zeros(len(raw), bool)
    single = _visible[raw][:-2] & _firm[raw[2:]]
    feed = (raw[1:-1] == 10) & single
    cut[1:-1] = (raw[1:-1] == 32) & single | feed
    cut[2:] |= feed
    cut[1:] |= _letter[raw[:-1]] & _sign[raw[1:]]
    return cut


class Stretches:
    """The stretches seen so far, by hash, with their first and second eight bytes, their size and, of longer
    ones, all bytes; a number for each, in order of sight."""

    def __init__(self) -> None:
        self.count, self.mask = 0, (1 << 16) - 1
        self.place = np.full(self.mask + 1, -1, np.int32)  # open addressing: numbers of stretches by hash
        self.hash = np.zeros(1 << 15, np.uint64)
        self.low, self.high, self.size = np.zeros(1 << 15, np.uint64), np.zeros(1 << 15, np.uint64), np.zeros(1 << 15, np.int64)
        self.rest, self.rest_used, self.rest_at = np.zeros(1 << 16, np.uint8), 0, np.zeros(1 << 15, np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of the stretch of each hash, -1 where there is none."""
        found, live = np.full(len(h), -1, np.int64), np.arange(len(h))
        at = h & np.uint64(self.mask)
        while len(live):
            number = self.place[at]
            same = (number >= 0) & (self.hash[number] == h[live])
            found[live[same]] = number[same]
            on = (number >= 0) & ~same
            live, at = live[on], (at[on] + np.uint64(1)) & np.uint64(self.mask)
        return found

    def _put(self, h: np.ndarray, numbers: np.ndarray) -> None:
        live, at = np.arange(len(h)), h & np.uint64(self.mask)
        while len(live):
            free = np.flatnonzero(self.place[at] < 0)
            self.place[at[free]] = numbers[live[free]]
            on = self.place[at] != numbers[live]  # taken before, or by another of these
            live, at = live[on], (at[on] + np.uint64(1)) & np.uint64(self.mask)

    def add(self, h: np.ndarray, low: np.ndarray, high: np.ndarray, size: np.ndarray, raw: np.ndarray, starts: np.ndarray) -> None:
        """New stretches (distinct hashes that find() knows nothing of)."""
        first, self.count = self.count, self.count + len(h)
        while self.count > len(self.hash):
            self.hash, self.low, self.high, self.size, self.rest_at = (np.concatenate([x, np.zeros_like(x)]) for x in (self.hash, self.low, self.high, self.size, self.rest_at))
        for kept, x in ((self.hash, h), (self.low, low), (self.high, high), (self.size, size)):
            kept[first : self.count] = x
        more = np.where(size > 16, size, 0)
        while self.rest_used + int(more.sum()) > len(self.rest):
            self.rest = np.concatenate([self.rest, np.zeros_like(self.rest)])
        self.rest_at[first : self.count] = self.rest_used + np.cumsum(more) - more
        self.rest[self.rest_used : self.rest_used + int(more.sum())] = raw[W.spread(starts, more)]
        self.rest_used += int(more.sum())
        if 2 * self.count > self.mask:
            while 2 * self.count > self.mask:
                self.mask = 2 * self.mask + 1
            self.place = np.full(self.mask + 1, -1, np.int32)
            self._put(self.hash[: self.count], np.arange(self.count))
        else:
            self._put(h, np.arange(first, self.count))

    def equal(self, number: np.ndarray, low: np.ndarray, high: np.ndarray, size: np.ndarray, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Whether stretches have the very bytes of those of these numbers."""
        same = (self.low[number] == low) & (self.high[number] == high) & (self.size[number] == size)
        longer = np.flatnonzero(same & (size > 16))
        if len(longer):
            n = size[longer]
            apart = raw[W.spread(starts[longer], n)] != self.rest[W.spread(self.rest_at[number[longer]], n)]
            same[longer] = np.add.reduceat(apart, np.r_[0, np.cumsum(n)[:-1]]) == 0
        return same


class Encoder:
    def __init__(self, path: str, added: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        self.finer = _cuts_hold(self.tokenizer)
        names = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.added = re.compile(b"|".join(map(re.escape, sorted(names, key=len, reverse=True)))) if names else None
        self.reset()

    def reset(self) -> None:
        self.seen = Stretches()
        self.flat, self.used = np.zeros(1 << 16, np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32), 0
        self.begin, self.count = np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int64)

    def _ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        each = [x.ids for x in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]
        size = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter(chain.from_iterable(each), self.flat.dtype, int(size.sum())), size

    def _learn(self, parts: list[str]) -> None:
        """Ids of the stretches that the cache took in last."""
        got, size = self._ids(parts)
        while self.used + len(got) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.seen.count > len(self.begin):
            self.begin, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.count))
        first = self.seen.count - len(parts)
        self.flat[self.used : self.used + len(got)] = got
        self.begin[first : self.seen.count] = self.used + np.cumsum(size) - size
        self.count[first : self.seen.count] = size
        self.used += len(got)

    def _whole(self, raw: np.ndarray, offsets: np.ndarray, cut: np.ndarray) -> None:
        """Cut before and after each added token within a text, and nowhere in it."""
        data, at = raw.tobytes(), 0
        while m := self.added.search(data, at):
            start, end = m.span()
            if offsets[np.searchsorted(offsets, start, "right")] < end:  # of two texts
                at = start + 1
                continue
            cut[start], cut[start + 1 : end], at = True, False, end
            if end < len(cut):
                cut[end] = True

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each text's ids begin."""
        n = len(raw)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        if self.seen.count > CACHE:
            self.reset()
        cut = stretch_cuts(raw) if self.finer else np.zeros(n, bool)
        inner = offsets[1:-1]
        cut[inner[inner < n]] = True
        cut[0] = True
        if self.finer and self.added:
            self._whole(raw, offsets, cut)
        starts = np.flatnonzero(cut)
        size = np.diff(np.append(starts, n))
        numbers = W.eights(raw)
        low = numbers[starts] & W.first_bytes(size)
        high = numbers[np.minimum(starts + 8, n)] & W.first_bytes(size - 8)
        h = W.span_hashes(raw, starts, starts + size, 0, numbers)
        number = self.seen.find(h)
        data = None
        if len(new := np.flatnonzero(number < 0)):
            data = raw.tobytes()
            _, one = np.unique(h[new], return_index=True)
            one = new[one]
            self.seen.add(h[one], low[one], high[one], size[one], raw, starts[one])
            self._learn(_texts(data, starts[one], size[one]))
            number[new] = self.seen.find(h[new])
        count, at = self.count[number], self.begin[number]
        odd = np.flatnonzero(~self.seen.equal(number, low, high, size, raw, starts))
        source = self.flat[: self.used]
        if len(odd):  # other bytes with the hash of a stretch seen before
            got, more = self._ids(_texts(data or raw.tobytes(), starts[odd], size[odd]))
            count[odd], at[odd] = more, self.used + np.cumsum(more) - more
            source = np.concatenate([source, got])
        ids = source[W.spread(at, count)].astype(np.uint32)
        total = np.r_[0, np.cumsum(count)]
        return ids, total[np.searchsorted(starts, offsets)]


def _texts(data: bytes, starts: np.ndarray, size: np.ndarray) -> list[str]:
    return [str(data[a : a + n], "utf-8", "replace") for a, n in zip(starts.tolist(), size.tolist(), strict=True)]


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, added: bool = False) -> Encoder:
    """One for each worker process, kept from task to task."""
    if (path, added) not in _encoders:
        _encoders[path, added] = Encoder(path, added)
    return _encoders[path, added]


def encoded(column: pa.Array, path: str, end_id: int, added: bool = False) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, offsets) by block; each text's ids end with end_id. With added, added tokens
    in a text have their one id (the library's default); without, they are spelled like other text."""
    enc = encoder(path, added)
    for lo, hi, raw, offsets in W.cuts(column, BLOCK_BYTES):
        ids, first = enc.encode(raw, offsets)
        shifted = first + np.arange(len(first))
        out = np.empty(len(ids) + hi - lo, np.uint32)
        ends = shifted[1:] - 1
        mask = np.ones(len(out), bool)
        mask[ends] = False
        out[ends], out[mask] = end_id, ids
        yield lo, hi, out, shifted
