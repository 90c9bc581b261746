"""Tokens of two tokenizers set against each other, byte by byte.

A dangling-suffix transducer reads both token sequences of the same bytes: its state is the side that leads and the
bytes of its last token which the other side has not reached yet. Each step takes the next token of the side behind; a group
closes when nothing dangles. Steps are remembered by side, dangling bytes and next token. Each token taken while bytes
dangle overlaps the token that they belong to, and that is every overlap there is.

Texts are cut where both tokenizers always begin a new token, and each worker keeps what the transducer made of the
stretches it has seen, so that a text is put together from stretches. Ids of pairs are counted by block of about
block_bytes of text first, then over all blocks; each block asks for the corpus-wide counts of the pairs it
holds, and its texts' sums are taken stretch by stretch.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from . import words as W
from .common import stash, texts

#: Stretches that a worker keeps, about 300 bytes each; when a block begins with more, it begins anew.
CACHE = 500_000
PIECES = "piece_bpe_32k.model"


def byte_level_bytes(tokenizer) -> list[bytes]:
    """The bytes of each entry of a byte-level vocabulary. Its characters stand for bytes: printable ones of Latin-1
    for themselves, the others, in order, for the characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(plain)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    out = [b""] * tokenizer.get_vocab_size()
    for piece, k in tokenizer.get_vocab().items():
        out[k] = bytes(byte_of[c] for c in piece) if all(c in byte_of for c in piece) else piece.encode()
    return out


class Pieces:
    """A sentencepiece model with byte fallback, and where its tokens always end."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.bytes = [b"" if model.is_control(k) or model.is_unknown(k) else bytes([int(model.id_to_piece(k)[3:5], 16)]) if model.is_byte(k) else model.id_to_piece(k).replace("▁", " ").encode() for k in ids]
        # Two bytes that stand side by side in no piece are never merged over.
        self.joined = np.zeros((256, 256), bool)
        for k in ids:
            if not model.is_byte(k):
                one = np.frombuffer(self.bytes[k], np.uint8)
                self.joined[one[:-1], one[1:]] = True
        # A line feed, a piece of its own, takes the blank that the model puts before a text.
        self.lead = model.encode("\n")
        odd = "    ﬁ\t½ "
        kept = model.normalize(odd).replace("▁", " ") == " " + odd  # the text as it is, behind one blank
        self.finer = bool(kept and len(self.lead) == 2 and not self.joined[10].any() and not self.joined[:, 10].any())

    def cuts(self, raw: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(raw), bool)
        cut[1:] = ~self.joined[raw[:-1], raw[1:]] & ((raw[1:] & 0xC0) != 0x80)
        return cut

    def ids(self, parts: list[str]) -> list[list[int]]:
        """Ids of stretches; whole texts begin with the blank that the model adds by itself."""
        if not self.finer:
            return self.model.encode([p[1:] for p in parts], num_threads=1)
        return [x[2:] for x in self.model.encode(["\n" + p for p in parts], num_threads=1)]


class Transducer:
    """States are numbered: 0 where nothing dangles, else even numbers where the left side leads and odd ones where the
    right side does, each with the bytes that dangle. The step that a token takes from a state is looked up once it is known."""

    def __init__(self, left: list[bytes], right: list[bytes]) -> None:
        self.sides = (left, right)
        self.dangling: list[bytes] = [b"", b""]
        self.number: dict[tuple[int, bytes], int] = {(0, b""): 0, (1, b""): 0}
        self.steps: list[dict[int, int]] = [{}, {}]

    def _state(self, lead: int, dangling: bytes) -> int:
        if (found := self.number.get((lead, dangling))) is None:
            found = self.number[lead, dangling] = len(self.steps) + lead
            self.dangling += [dangling, dangling]
            self.steps += [{}, {}]
        return found

    def _step(self, state: int, token: int) -> int:
        """The next state, -1 where the bytes differ."""
        lead, dangling = state & 1, self.dangling[state]
        piece = self.sides[1 - lead][token]
        if dangling.startswith(piece):
            return self._state(lead, dangling[len(piece) :])
        return self._state(1 - lead, piece[len(dangling) :]) if piece.startswith(dangling) else -1

    def align(self, left: list[int], right: list[int]) -> tuple[list[tuple[list[int], list[int]]], list[int]] | None:
        """(groups, links as left id << 32 | right id) of two token sequences, or None where their bytes differ."""
        groups, links, steps, i, j, state = [], [], self.steps, 0, 0, 0
        n, m, mine, theirs, last = len(left), len(right), [], [], -1
        while True:
            if not state:
                if i == n:
                    return (groups, links) if j == m else None
                last = left[i]
                i += 1
                mine, theirs = [last], []
                state = self._state(0, self.sides[0][last]) if (known := steps[0].get(last)) is None else known
                steps[0][last] = state
                continue
            lead = state & 1
            if lead:
                if i == n:
                    return None
                token = left[i]
                i += 1
                mine.append(token)
                links.append(token << 32 | last)
            else:
                if j == m:
                    return None
                token = right[j]
                j += 1
                theirs.append(token)
                links.append(last << 32 | token)
            ahead = steps[state].get(token)
            if ahead is None:
                ahead = steps[state][token] = self._step(state, token)
            if ahead <= 0:
                if ahead < 0:
                    return None
                groups.append((mine, theirs))
            elif ahead & 1 != lead:
                last = token
            state = ahead


def _grown(x: np.ndarray, n: int) -> np.ndarray:
    while len(x) < n:
        x = np.concatenate([x, np.zeros_like(x)])
    return x


class Aligner:
    """What the transducer made of the stretches seen so far, by their number."""

    def __init__(self, path: str, pieces: str) -> None:
        self.left, self.right = tokens.Encoder(path), Pieces(pieces)
        self.left_bytes = byte_level_bytes(self.left.tokenizer)
        self.decimal = [b"%d" % k for k in range(max(len(self.left_bytes), len(self.right.bytes)))]
        self.reset()

    def reset(self) -> None:
        self.seen, self.transducer = tokens.Stretches(), Transducer(self.left_bytes, self.right.bytes)
        self.sizes = np.zeros((1 << 15, 4), np.int64)  # left tokens, right tokens, groups, whether the bytes agree
        self.links, self.used = np.zeros(1 << 16, np.int64), 0
        self.first, self.n_links = np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int64)
        self.texts: list[bytes] = []

    def _learn(self, parts: list[str], raw: list[bytes]) -> None:
        flat, size = self.left._ids(parts)
        ends, n, flat, said = np.cumsum(size).tolist(), len(self.texts), flat.tolist(), self.decimal
        # Where all bytes come back in stretches of the right sizes, each stretch's do.
        long = np.add.reduceat(np.fromiter((len(self.left_bytes[x]) for x in flat), np.int64, len(flat)), (np.cumsum(size) - size)).tolist() if flat else []
        whole = long == list(map(len, raw)) and b"".join(map(self.left_bytes.__getitem__, flat)) == b"".join(raw)
        made, first, counts, at = [], [], [], 0
        for a_end, b, data in zip(ends, self.right.ids(parts), raw, strict=True):
            a, at = flat[at:a_end], a_end
            found = self.transducer.align(a, b) if whole or b"".join(map(self.left_bytes.__getitem__, a)) == data else None
            groups, links = found or ([], [])
            self.texts.append(b";".join([said[p[0]] + b"|" + said[q[0]] if len(p) == len(q) == 1 else b",".join([said[x] for x in p]) + b"|" + b",".join([said[x] for x in q]) for p, q in groups]))
            counts.append((len(a), len(b), len(groups), found is not None))
            first.append(len(links))
            made += links
        end = n + len(parts)
        self.sizes, self.first, self.n_links, self.links = _grown(self.sizes, end), _grown(self.first, end), _grown(self.n_links, end), _grown(self.links, self.used + len(made))
        self.sizes[n:end], self.n_links[n:end] = counts, first
        self.first[n:end] = self.used + np.cumsum(first) - first
        self.links[self.used : self.used + len(made)] = made
        self.used += len(made)

    def numbers(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each stretch of some texts, and where those of each text begin."""
        cut = np.zeros(len(raw), bool)
        if self.left.finer and self.right.finer:
            cut = tokens.stretch_cuts(raw) & self.right.cuts(raw)
        cut[offsets[:-1]] = True  # no text is without its leading blank
        starts = np.flatnonzero(cut)
        size, numbers = np.diff(np.append(starts, len(raw))), W.eights(raw)
        low, high = numbers[starts] & W.first_bytes(size), numbers[np.minimum(starts + 8, len(raw))] & W.first_bytes(size - 8)
        h = W.span_hashes(raw, starts, starts + size, 0, numbers)
        number, data = self.seen.find(h), raw.tobytes()
        if len(new := np.flatnonzero(number < 0)):
            _, one = np.unique(h[new], return_index=True)
            one = new[one]
            self.seen.add(h[one], low[one], high[one], size[one], raw, starts[one])
            self._add(data, starts[one], size[one])
            number[new] = self.seen.find(h[new])
        odd = np.flatnonzero(~self.seen.equal(number, low, high, size, raw, starts))
        for k in odd.tolist():  # other bytes with the hash of a stretch seen before: a number of its own that no hash finds
            number[k] = self.seen.count
            self.seen.add(h[k : k + 1] ^ np.uint64(self.seen.count + 1), low[k : k + 1], high[k : k + 1], size[k : k + 1], raw, starts[k : k + 1])
            self._add(data, starts[k : k + 1], size[k : k + 1])
        return number, np.searchsorted(starts, offsets)

    def _add(self, data: bytes, starts: np.ndarray, size: np.ndarray) -> None:
        for lo in range(0, len(starts), 4_096):
            a, n = starts[lo : lo + 4_096], size[lo : lo + 4_096]
            self._learn(tokens._texts(data, a, n), [data[x : x + y] for x, y in zip(a.tolist(), n.tolist(), strict=True)])


_kept: dict[tuple[str, str], Aligner] = {}

_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_SUMS = ("n_a", "n_b", "n_groups", "n_links")
_FIELDS = [("block", pa.int64()), *((c, pa.int64()) for c in _SUMS), ("groups_sha256", pa.string()), ("stretches", _INTS), ("pairs", _LONGS), ("counts", _LONGS), ("known", _INTS), ("sizes", _INTS), ("links", _INTS)]
_SQL = ", ".join(f"{c} {'string' if t == pa.string() else 'long' if t == pa.int64() else 'array<long>' if t == _LONGS else 'array<int>'}" for c, t in _FIELDS)


def _list(x: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, kind.value_type))


def _aligned(path: str, pieces: str, block_bytes: int, id_field: pa.Field):
    """Per text its sums and stretches; behind the texts of a block, its pairs, their counts and the links of its stretches."""
    schema = pa.schema([id_field, *(pa.field(*f) for f in _FIELDS)])

    def close(block: int, made: Aligner, weight: np.ndarray) -> pa.RecordBatch:
        known = np.flatnonzero(weight[: len(made.texts)])
        size = made.n_links[known]
        codes = made.links[W.spread(made.first[known], size)]
        pairs, place = np.unique(codes, return_inverse=True)
        counts = np.bincount(place, np.repeat(weight[known], size).astype(np.float64), len(pairs)).astype(np.int64)
        lists = [_list(x, kind) for x, kind in ((pairs, _LONGS), (counts, _LONGS), (known, _INTS), (size, _INTS), (place, _INTS))]
        return pa.RecordBatch.from_arrays([pa.nulls(1, id_field.type), pa.array([block], pa.int64()), *(pa.nulls(1, f.type) for f in list(schema)[2:8]), *lists], schema=schema)

    def run(batches):
        from pyspark import TaskContext

        if (path, pieces) not in _kept:
            _kept[path, pieces] = Aligner(path, pieces)
        made, block, held = _kept[path, pieces], TaskContext.get().partitionId() << 32, 0
        weight = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for lo, hi, raw, offsets in W.cuts(batch.column(1)):
                if not held and made.seen.count > CACHE:
                    made.reset()
                number, first = made.numbers(raw, offsets)
                total = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(made.sizes[number], 0)])
                sums = total[first[1:]] - total[first[:-1]]
                good = (sums[:, 3] == np.diff(first)) & (np.diff(offsets) > 1)
                sums[:, 3] = sums[:, 0] + sums[:, 1] - sums[:, 2]
                sums[~good] = 0
                counted = np.repeat(good, np.diff(first))
                weight = _grown(weight, len(made.texts))
                weight[: len(made.texts)] += np.bincount(number[counted], minlength=len(made.texts))
                digests = [hashlib.sha256(b";".join(map(made.texts.__getitem__, number[a:b].tolist()))).hexdigest() if ok else "" for a, b, ok in zip(first[:-1].tolist(), first[1:].tolist(), good.tolist(), strict=True)]
                edges = np.r_[0, np.cumsum(np.where(good, np.diff(first), 0))]
                stretches = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(number[counted], pa.int32()))
                n = hi - lo
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.array(np.full(n, block)), *(pa.array(np.ascontiguousarray(x)) for x in sums.T), pa.array(digests), stretches, *(pa.nulls(n, t) for _, t in _FIELDS[7:])], schema=schema)
                held += len(raw)
                if held >= block_bytes:
                    yield close(block, made, weight)
                    block, held, weight = block + 1, 0, np.zeros(1 << 16, np.int64)
        if held:
            yield close(block, made, weight)

    return run


def _summed(names: list[str], schema: pa.Schema):
    def run(found: pa.Table, answers: pa.Table) -> pa.Table:
        at = np.flatnonzero(found["pairs"].is_valid().to_numpy())
        docs = found.filter(found["pairs"].is_null())
        best, total = np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)
        if len(at):
            part = {c: found[c][int(at[0])].values.to_numpy() for c in ("pairs", "known", "sizes", "links")}
            value = np.zeros((len(part["pairs"]), 2), np.int64)
            value[answers["place"].to_numpy()] = np.stack([answers["best"].to_numpy(), answers["n"].to_numpy()], 1)
            edge = np.r_[0, np.cumsum(part["sizes"])]
            upto = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(value[part["links"]], 0)])
            each = np.zeros((int(part["known"].max(initial=-1)) + 1, 2), np.int64)
            each[part["known"]] = upto[edge[1:]] - upto[edge[:-1]]
            lists = docs["stretches"].combine_chunks()
            number, edges = lists.flatten().to_numpy(), np.r_[0, np.cumsum(lists.value_lengths().to_numpy())]
            upto = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(each[number], 0)])
            best, total = (upto[edges[1:]] - upto[edges[:-1]]).T
        return pa.Table.from_arrays([*(docs[c] for c in names), pa.array(np.ascontiguousarray(best)), pa.array(np.ascontiguousarray(total))], schema=schema)

    return run


def align(docs: DataFrame, path: str | None = None, pieces: str | None = None, block_bytes: int = 24 << 20) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row of docs: its tokens by a byte-level
    vocabulary (A, of a blank and the text) and by a sentencepiece model (B, which adds that blank), the groups into which
    shared token ends cut them, and the overlapping pairs of tokens. A pair's count is how often its ids overlap in all of
    docs; n_best counts links whose count is the highest of their B id, ties included, count_sum sums the counts.

    A text that is null or empty, or whose tokens do not give back its bytes (B cannot tell U+2581 from a blank), has zeros
    and an empty digest and adds to no count. Repeated rows count and come back as often as they occur; a null doc_id is a
    row like others; texts of any length are taken whole. Other columns are not looked at; an empty table gives an empty one.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    path, pieces = path or tokens.vocabulary_path(), pieces or tokens.vocabulary_path(PIECES)
    source = texts(docs).select("doc_id", F.concat(F.lit(" "), "text").alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    id_field = to_arrow_schema(source.select("doc_id").schema)[0]
    found = stash(source.mapInArrow(_aligned(path, pieces, block_bytes, id_field.with_nullable(True)), f"doc_id {kind}, {_SQL}"), "aligned")
    blocks = found.where(F.col("pairs").isNotNull())
    counts = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.counts").alias("n"))
    counts = stash(counts.withColumn("b", F.col("pair").bitwiseAND((1 << 32) - 1)), "pair-counts")
    highest = F.broadcast(counts.groupBy("b").agg(F.max("n").alias("most")))  # a row for each id of B's vocabulary at most
    rated = counts.join(highest, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    asked = blocks.select("block", F.posexplode("pairs").alias("place", "pair")).join(rated, "pair").select(F.col("block").alias("q_block"), "place", "n", "best")
    names = ["doc_id", *_SUMS, "groups_sha256"]
    out = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    schema = pa.schema([id_field.with_nullable(True), *((c, pa.int64()) for c in _SUMS), ("groups_sha256", pa.string()), ("n_best", pa.int64()), ("count_sum", pa.int64())])
    left = found.select("block", *names, "stretches", "pairs", "known", "sizes", "links")
    return left.groupBy("block").cogroup(asked.groupBy("q_block")).applyInArrow(_summed(names, schema), out)
