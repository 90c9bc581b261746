"""Token alignment against whole-text encoding and set operations on token ends."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandspark.llm import token_alignment as T
from strandspark.llm import tokens

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
SIGNS = ["a", "b", " ", " ", "  ", "\n", "\t", "\r\n", "▁", "é", "é", "日本", "🙂", " ", "　", ".", "'s", "1", "42", "<0x41>", "<s>", "</s>", "<unk>", "<|endoftext|>", "the", " The", "-", "_", "​", "ﬁ", "½", "\x00", "﻿"]


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(tokens.vocabulary_path())
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=tokens.vocabulary_path(T.PIECES))


def brute(rows, encoders):
    left, right = encoders
    a_bytes, b_bytes = T.byte_level_bytes(left), T.Pieces(tokens.vocabulary_path(T.PIECES)).bytes
    counts, each = Counter(), []
    for i, text in rows:
        a, b = (left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)) if text else ([], [])
        if not text or any(b"".join(by[x] for x in ids) != (" " + text).encode() for by, ids in ((a_bytes, a), (b_bytes, b))):
            each.append((i, 0, 0, 0, [], ""))
            continue
        ends = [np.cumsum([len(by[x]) for x in ids]) for by, ids in ((a_bytes, a), (b_bytes, b))]
        shared, every = np.intersect1d(*ends), np.union1d(*ends)
        links = [(a[x], b[y]) for x, y in zip(*(np.searchsorted(e, every) for e in ends), strict=True)]
        counts.update(links)
        cuts = [np.r_[0, np.searchsorted(e, shared) + 1].tolist() for e in ends]
        said = [",".join(map(str, a[p:q])) + "|" + ",".join(map(str, b[r:s])) for p, q, r, s in zip(cuts[0], cuts[0][1:], cuts[1], cuts[1][1:], strict=False)]
        each.append((i, len(a), len(b), len(shared), links, hashlib.sha256(";".join(said).encode()).hexdigest()))
    top: dict = {}
    for (_, b), n in counts.items():
        top[b] = max(n, top.get(b, 0))
    return [(i, na, nb, g, len(links), sum(counts[x] == top[x[1]] for x in links), sum(counts[x] for x in links), h) for i, na, nb, g, links, h in each]


def odd_texts():
    rng = random.Random(5)
    fixed = [None, "", " ", "  ", "a ", "▁", "one▁two", "\n", " \n\n x", "x" * 70_000, "word " * 20_000, "don't stop-me\tnow…", "a.b,c;d", "no newline\r\nhere"]
    return fixed + ["".join(rng.choices(SIGNS, k=rng.randrange(1, 60))) for _ in range(400)]


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("block_bytes", [1, 50_000, 1 << 24])
def test_equals_whole_texts(spark, encoders, block_bytes):
    texts = odd_texts()
    rows = [*enumerate(texts), (None, "no id here"), (3, texts[20]), (3, texts[20]), (7, texts[10])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.select("*", *(F.lit("clash").alias(c) for c in ("block", "n_a", "pairs", "stretches", "n", "best", "place", "pair", "b")))
    got = T.align(docs, block_bytes=block_bytes).select(*COLUMNS).collect()
    want = brute(rows, encoders)
    assert sorted(map(key, got)) == sorted(map(key, want))
    assert sum(w[1] == 0 for w in want) > 5 and sum(w[1] > 0 for w in want) > 150


def test_cuts_never_change_tokens(encoders):
    assert T.Pieces(tokens.vocabulary_path(T.PIECES)).finer
    made = T.Aligner(tokens.vocabulary_path(), tokens.vocabulary_path(T.PIECES))
    rng = random.Random(9)
    for _ in range(300):
        text = "".join(rng.choices(SIGNS, k=rng.randrange(1, 40)))
        raw = np.frombuffer((" " + text).encode(), np.uint8)
        number, _ = made.numbers(raw, np.array([0, len(raw)]))
        if "▁" not in text:
            assert made.sizes[number].sum(0)[:2].tolist() == [len(encoders[0].encode(" " + text, add_special_tokens=False).ids), len(encoders[1].encode(text))]


def test_transducer_closes_groups_where_nothing_dangles():
    pair = lambda a, b: a << 32 | b
    made = T.Transducer([b"ab", b"c", b"abcd"], [b"a", b"bc", b"b", b"cd", b"x"])
    assert made.align([0, 1], [0, 1]) == ([([0, 1], [0, 1])], [pair(0, 0), pair(0, 1), pair(1, 1)])
    assert made.align([2], [0, 2, 3]) == ([([2], [0, 2, 3])], [pair(2, 0), pair(2, 2), pair(2, 3)])
    assert made.align([0, 1], [0, 2]) is None and made.align([0], [0, 4]) is None and made.align([0], [0, 2, 0]) is None
    assert made.align([], []) == ([], [])


def test_no_rows_and_no_tokens(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert T.align(docs).count() == 0
    nothing = T.align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).select(*COLUMNS).collect()
    assert sorted(map(tuple, nothing)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
