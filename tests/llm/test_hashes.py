"""Hashes and the stretch cache on texts made to collide: the Thue-Morse word and its complement."""

import random

import numpy as np
import pyarrow as pa
import pytest

from strandspark.llm import tokens
from strandspark.llm import words as W

LENGTHS = (512, 1024, 2048, 4096, 8192)


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(k).count("1") % 2 else a for k in range(n))


def hashes(text, kind=W.AS_IS, which=0):
    return next(W.blocks(pa.array([text]), kind))[2].hashes(which)


@pytest.mark.parametrize("n", LENGTHS)
def test_thue_morse_words_differ(n):
    for which in (0, 1):
        one, two = hashes(thue_morse(n) + " " + thue_morse(n, "b", "a"), which=which)
        assert one != two


@pytest.mark.parametrize("n", LENGTHS)
def test_runs_of_thue_morse_words_differ(n):
    h = hashes(" ".join(thue_morse(n)) + " " + " ".join(thue_morse(n, "b", "a")))
    one, two = W.hashes_in_order(h, np.array([0, n]), np.array([n, n]))
    assert one != two
    for size in (5, 20, 50, 64):
        got = W.grams(h, size)
        words = [tuple(h[k : k + size].tolist()) for k in range(len(got))]
        assert len(set(words)) == len(np.unique(got))


def test_equal_words_have_equal_hashes_wherever_they_stand():
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abé日") for _ in range(rng.choice([1, 2, 7, 8, 9, 16, 17, 100, 300]))) for _ in range(60)]
    text = [rng.choice(vocabulary) for _ in range(2000)]
    h = hashes("  ".join(text))
    by_word = {}
    for w, x in zip(text, h.tolist(), strict=True):
        assert by_word.setdefault(w, x) == x
    assert len(set(by_word.values())) == len(by_word)


@pytest.fixture(scope="module")
def unmodified():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


def ids_of(texts, **how):
    got = []
    for _, _, ids, at in tokens.encoded(pa.array(texts), tokens.vocabulary_path(), 2, added=True, **how):
        got += [ids[a : b - 1].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    return got


@pytest.mark.parametrize("n", LENGTHS)
def test_thue_morse_texts_have_their_own_ids(unmodified, n):
    texts = [thue_morse(n), thue_morse(n, "b", "a"), thue_morse(n) + " " + thue_morse(n, "b", "a")]
    assert ids_of(texts) == [e.ids for e in unmodified.encode_batch(texts, add_special_tokens=False)]


def test_equal_hashes_of_other_bytes_are_seen(unmodified, monkeypatch):
    monkeypatch.setattr(W, "span_hashes", lambda raw, starts, ends, *_: (ends - starts).astype(np.uint64) // np.uint64(9))
    enc, texts = tokens.Encoder(tokens.vocabulary_path(), True), ["one two three", "a longer-than-sixteen-bytes b", "a longer+than+sixteen+bytes b", "six ten"]
    data = "".join(texts).encode()
    edge = np.r_[0, np.cumsum([len(t.encode()) for t in texts])]
    for _ in range(2):
        ids, at = enc.encode(np.frombuffer(data, np.uint8), edge)
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)] == [e.ids for e in unmodified.encode_batch(texts, add_special_tokens=False)]


def test_the_cache_begins_anew_when_full(unmodified, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 50)
    monkeypatch.setattr(tokens, "BLOCK_BYTES", 400)
    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(40)) for _ in range(60)]
    assert ids_of(texts) == [e.ids for e in unmodified.encode_batch(texts, add_special_tokens=False)]


def test_other_tokenizers_get_whole_texts():
    class Other:
        def __init__(self, pre):
            self.pre = pre

        def to_str(self):
            import json

            return json.dumps({"normalizer": None, "pre_tokenizer": self.pre, "model": {"type": "BPE"}})

    usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    assert tokens._cuts_hold(Other(usual)) and not tokens._cuts_hold(Other(None)) and not tokens._cuts_hold(Other({"type": "Whitespace"})) and not tokens._cuts_hold(Other(usual | {"add_prefix_space": True}))
