"""Personal data with source offsets, disguised or plain.

Plain identifiers are found on the text itself. A second pass reads the text through a
transducer that folds look-alike characters, drops invisible ones, turns spelled digits into digits and
"(at)", " dot ", character references and the like into their signs, and keeps for each character it writes the span of
source characters it came from; the same detectors run on what it writes, and their spans are mapped
back. All offsets are code points of the source, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import unused

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is entered at its first digit only: from a later one nothing else can match.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Characters that look like others (Cyrillic, Greek), in natural order.
LOOKALIKES = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "․": ".", "。": ".", "．": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "＠": "@", "﹫": "@", "＋": "+",
}
INVISIBLE = "­​‌‍⁠﻿"
SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}


def _folds() -> dict[int, str]:
    """Characters that stand for one ASCII character: digits of other scripts, full-width and
    styled letters, look-alikes; invisible characters stand for nothing."""
    import sys
    import unicodedata

    made = {}
    for start, end in ((0x660, 0x66A), (0x6F0, 0x6FA), (0x966, 0x970), (0x2070, 0x209D), (0x2460, 0x24EA), (0xFF01, 0xFF5F), (0x1D400, 0x1D800)):
        for code in range(start, min(end, sys.maxunicode)):
            c = chr(code)
            digit = unicodedata.digit(c, None)
            plain = str(digit) if digit is not None else unicodedata.normalize("NFKC", c)
            if len(plain) == 1 and "!" <= plain <= "~":
                made[code] = plain
    return made | {ord(k): v for k, v in LOOKALIKES.items()} | {ord(c): "" for c in INVISIBLE}


_FOLDS = _folds()
_FOLDED = re.compile("[" + "".join(map(re.escape, map(chr, sorted(_FOLDS)))) + "]")
_DIGIT_WORD = "(?:" + "|".join(SPELLED) + ")"
_SPELLED = re.compile(rf"(?i)\b(?:plus[ -]+)?{_DIGIT_WORD}(?:[ ,.-]{{1,2}}{_DIGIT_WORD}){{6,}}\b")
_AT = re.compile(r"(?i)[\x20\t]{0,3}[\[({<][\x20\t]{0,3}(?:at|@)[\x20\t]{0,3}[\])}>][\x20\t]{0,3}")
_DOT = re.compile(r"(?i)[\x20\t]{0,3}[\[({<][\x20\t]{0,3}(?:dot|punkt|point|\.)[\x20\t]{0,3}[\])}>][\x20\t]{0,3}")
# Said out with a full stop, an address must end in a common top-level domain or one of two small letters (a country);
# with "dot" said too, in any letters that are no common word: "at noon dot then" is prose.
_DOT_WORD = r"[\x20\t]{1,3}dot[\x20\t]{1,3}"
_DOT_SAID = rf"(?:{_DOT_WORD}|\.)"
_TOP = "com|org|net|edu|gov|int|info|biz|io|co|eu|uk|de|fr|es|it|nl|ch|at|us|ca|au|jp|ru|br|in|me|tv"
_PROSE = "and|or|but|then|that|this|the|on|we|he|she|they|you|with|for|from|when|where|if|which|who|was|not|of"
_ENDING = rf"(?:{_DOT_SAID}(?:{_TOP})|{_DOT_WORD}(?!(?:{_PROSE})\b)[a-z]{{2,24}}|\.(?-i:[a-z]{{2}}))\b"
_SAID = re.compile(rf"(?i)(?<=[a-z0-9_%+.-])[\x20\t]{{1,3}}(at)[\x20\t]{{1,3}}(?=[a-z0-9-]{{1,63}}(?:{_DOT_SAID}[a-z0-9-]{{1,63}}){{0,4}}?{_ENDING})")
_SAID_DOT = re.compile(r"(?i)(?<=[a-z0-9_-])[\x20\t]{1,3}(dot)[\x20\t]{1,3}(?=[a-z0-9-])")
# Signs written as character references of web pages, or escaped as in urls.
_ENTITY = re.compile(r"(?i)&(?:#(?:x0{0,4}([2-7][0-9a-f])|0{0,4}([0-9]{2,3}))|(commat|period|plus|lowbar));|%(40|2[be])")
_NAMED = {"commat": "@", "period": ".", "plus": "+", "lowbar": "_"}
_DIGITS = re.compile(_DIGIT_WORD, re.IGNORECASE)
_ODD_CASE = str.maketrans("ſıİ", "sii")  # what re.IGNORECASE takes for s and i


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def detect(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of plain identifiers, by kind and start; within a kind leftmost, apart."""
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            found.append((0, start, m.end()))
            last = m.end()
        else:
            last = at + 1  # nothing before this sign can belong to a later address
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(m[0].count, "0123456789")) <= 15:
                found.append((3, *m.span()))
    return found


def _rewrites(text: str) -> list[tuple[int, int, str]]:
    """Stretches of the source that stand for something else, in order and apart."""
    found = [(*m.span(), _FOLDS[ord(m[0])]) for m in _FOLDED.finditer(text)] if not text.isascii() else []
    for m in _SPELLED.finditer(text):
        plus = "+" if m[0][:4].lower() == "plus" else ""
        first = True
        for d in _DIGITS.finditer(text, m.start(), m.end()):
            found.append((m.start() if first else end, d.end(), (plus if first else "") + SPELLED[d[0].translate(_ODD_CASE).lower()]))  # noqa: F821
            first, end = False, d.end()  # noqa: F841
    found += [(*m.span(), "@") for m in _AT.finditer(text)] + [(*m.span(), ".") for m in _DOT.finditer(text)]
    if said := [(*m.span(), "@") for m in _SAID.finditer(text)]:
        found += said + [(*m.span(), ".") for m in _SAID_DOT.finditer(text)]
    if "&" in text or "%" in text:
        for m in _ENTITY.finditer(text):
            code = int(m[1] or m[4], 16) if m[1] or m[4] else int(m[2] or 0)
            if m[3] or 33 <= code <= 126:
                found.append((*m.span(), _NAMED[m[3].lower()] if m[3] else chr(code)))
    out, last = [], 0
    for start, end, to in sorted(found, key=lambda x: (x[0], -x[1])):
        if start >= last:
            out.append((start, end, to))
            last = end
    return out


def transduce(text: str) -> tuple[str, list[int], list[tuple[int, int, int]]] | None:
    """The normalised text and how to map its places back: (place, source place, width) of every
    stretch, width 0 where characters were copied. None if there is nothing to normalise."""
    changes = _rewrites(text)
    if not changes:
        return None
    parts, marks, size, last = [], [], 0, 0
    for start, end, to in changes:
        if start > last:
            marks.append((size, last, 0))
            parts.append(text[last:start])
            size += start - last
        if to:
            marks.append((size, start, end - start))
            parts.append(to)
            size += len(to)
        last = end
    if last < len(text):
        marks.append((size, last, 0))
        parts.append(text[last:])
    return "".join(parts), [m[0] for m in marks], marks


def _source(places: list[int], marks: list[tuple[int, int, int]], start: int, end: int) -> tuple[int, int]:
    at, origin, width = marks[bisect_right(places, start) - 1]
    first = origin if width else origin + start - at
    at, origin, width = marks[bisect_right(places, end - 1) - 1]
    return first, origin + width if width else origin + end - at


def find(text: str, disguised: bool = True) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(plain spans, spans that only the normalised text shows: those that reach beyond a plain one of their kind too)."""
    base = detect(text)
    made, more = transduce(text) if disguised else None, []
    if made:
        normal, places, marks = made
        for kind, start, end in detect(normal):
            span = _source(places, marks, start, end)
            before = bisect_right(base, (kind, span[0], len(text))) - 1  # the only one of its kind that may hold it: they lie apart
            if before < 0 or base[before][0] != kind or base[before][2] < span[1]:
                more.append((kind, *span))
    return base, more


# What a text must hold for either pass to find anything, told from its bytes and word hashes:
_plain = np.zeros(256, bool)  # a digit or the sign of an address
_plain[48:58] = _plain[ord("@")] = True
_strange = np.zeros(256, bool)  # a bracket, or a lead byte beyond accented Latin letters
_strange[[ord(c) for c in "[({<"]] = True
_strange[0xC9:0xE0] = _strange[0xE1:] = _strange[0xE0] = _strange[0xC2] = True
_AFTER_AND, _AFTER_PERCENT = np.frombuffer(b"#cCpPlL", np.uint8), np.frombuffer(b"24", np.uint8)


def _hashes_of(terms) -> np.ndarray:
    return np.sort(next(W.blocks(pa.array([" ".join(terms)]), W.ALNUM))[2].hashes())


def _cased(term: str) -> list[str]:
    """term, and what re.IGNORECASE takes for it that isn't ASCII."""
    made = [""]
    for c in term:
        made = [m + x for m in made for x in c + {"s": "ſ", "i": "ıİ"}.get(c, "")]
    return made


_DIGIT_HASHES = _hashes_of([x for term in SPELLED for x in _cased(term)])
_AT_HASH, _DOT_HASH = _hashes_of(("at",)), _hashes_of(("dot",))


def _wanted(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that may hold plain identifiers, and rows that may hold disguised ones: no row in which
    a pattern matches is left out."""
    block = W.Block(raw, offsets, W.ALNUM)
    h = block.hashes()
    digits, ats, dots = (block.per_row(np.isin(h, x)) for x in (_DIGIT_HASHES, _AT_HASH, _DOT_HASH))
    # A full stop within an address said out is followed by a letter, a digit or a hyphen.
    stops = np.zeros(len(raw), bool)
    stops[:-1] = (raw[:-1] == ord(".")) & (raw[1:] > 32)
    said = (ats > 0) & ((dots > 0) | (block.per_text(stops) > 0))
    # A reference or escape begins with one of these pairs of signs.
    escaped = np.zeros(len(raw), bool)
    escaped[:-1] = (raw[:-1] == ord("&")) & np.isin(raw[1:], _AFTER_AND) | (raw[:-1] == ord("%")) & np.isin(raw[1:], _AFTER_PERCENT)
    # Of seven spelled digits, the first and the last may stand beside a sign that counts as a letter here.
    return block.per_text(_plain[raw]) > 0, (block.per_text(_strange[raw]) > 0) | said | (digits >= 5) | (block.per_text(escaped) > 0)


SPAN_TYPE = "array<struct<kind:string,start:int,end:int,plain:boolean>>"
_span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("plain", pa.bool_())]))


def _spans(names: list[str], into: str = "spans"):
    def run(batches):
        for batch in batches:
            column, out = batch.column(batch.schema.names.index("text")), []
            for lo, hi, raw, offsets in W.cuts(column):
                plain, strange = _wanted(raw, offsets)
                data = raw.tobytes()
                for k in range(hi - lo):
                    if not plain[k] and not strange[k]:
                        out.append(None)
                        continue
                    base, more = find(data[int(offsets[k]) : int(offsets[k + 1])].decode("utf-8", "replace"), bool(strange[k]))
                    out.append([{"kind": KINDS[k], "start": s, "end": e, "plain": p} for k, s, e, p in sorted([(*x, True) for x in base] + [(*x, False) for x in more])])
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array([x or [] for x in out], _span)], [*names, into])

    return run


def find_private(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in keep, and spans (kind, start, end, plain) by kind, then start.

    plain spans are those of the patterns on the text itself; the others were disguised and never lie within
    a plain one of their kind (they may hold one, whose beginning alone was disguised). A null text is empty and has no spans; repeated rows get a row each; texts
    of any length are read whole, in time that grows with their length.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    source = docs.select("doc_id", text, *(c for c in keep if c != "text"))
    names = ["doc_id", *keep]
    fields = ", ".join(f"`{n}` {source.schema[n].dataType.simpleString()}" for n in names)
    return source.mapInArrow(_spans(names), f"{fields}, spans {SPAN_TYPE}")


def _redacted(texts, spans):
    for text, found in zip(texts, spans, strict=True):
        if not found:
            yield text
            continue
        out, last = [], 0
        for s in sorted(found, key=lambda s: (s["start"], -s["end"])):
            if s["start"] >= last:
                out += [text[last : s["start"]], f"<{s['kind'].upper()}>"]
            last = max(last, s["end"])
        yield "".join(out) + text[last:]


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span replaced by its kind, like <EMAIL>; n_chars, if there, follows.
    Of spans that overlap, the first (then longest) names the whole stretch."""
    names = docs.columns
    others = [n for n in names if n != "text"]
    source = docs.select(*others, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    into = unused("spans", *names)

    def run(batches):
        for batch in _spans([*others, "text"], into)(batches):
            text = pa.array(list(_redacted(batch.column("text").to_pylist(), batch.column(into).to_pylist())), pa.string())
            yield pa.RecordBatch.from_arrays([text if n == "text" else batch.column(n) for n in names], names)

    fields = ", ".join(f"`{n}` {'string' if n == 'text' else docs.schema[n].dataType.simpleString()}" for n in names)
    out = source.mapInArrow(run, fields)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
