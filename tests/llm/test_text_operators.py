"""Corpus operators against plain Python on small tables, with nulls, blanks, repeats and extra columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from strandspark.llm import decontaminate, jaccard_join, packing, private_data, substring_dedup, token_files, tokens

ODD = [(None, "no id here"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, "word " * 5000), (7, "é日本 語 x")]
SCHEMA = "doc_id long, text string"


def words(text, lower=False):
    data = (text or "").encode()
    if lower:
        data = bytes(b + 32 if 65 <= b <= 90 else b for b in data)
    return re.findall(rb"[^\x20\x09-\x0D]+", data)


def with_clashes(df):
    from pyspark.sql import functions as F

    extra = ("_text", "_row", "_id", "n_words", "node", "label", "key", "score", "start", "level", "items", "run", "spans", "a", "b")
    return df.select("*", *(F.lit("clash").alias(c) for c in extra))


def near_family(rng, n=60, size=120, edits=5):
    base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
    texts = []
    for _ in range(n):
        mine = list(base)
        for _ in range(rng.randrange(edits)):
            mine[rng.randrange(len(mine))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(mine))
    return texts


def brute_components(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = words(t, True)
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize(("k", "num", "settled"), [(3, 90, 256), (5, 80, 8)])
def test_jaccard_join_finds_every_link(spark, monkeypatch, k, num, settled):
    monkeypatch.setattr(jaccard_join, "SETTLED", settled)
    monkeypatch.setattr(jaccard_join, "PER_PIVOT", 7)
    rng = random.Random(k)
    texts = near_family(rng) + near_family(rng, 20, 12, 2) + near_family(rng, 12, 400, 60) + ["a b", "A B", "a", "", None, "x y z", "x y z"]
    # A chain, each member near the next only, and texts that share one common passage.
    chain = [f"c{j}" for j in range(200)]
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = [*chain[4:], *(f"d{rng.randrange(10**6)}" for _ in range(4))]
    shared = " ".join(f"s{j}" for j in range(30))
    texts += [shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))) for _ in range(30)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    found = jaccard_join.near_copies(with_clashes(spark.createDataFrame(rows, SCHEMA)), k=k, num=num).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows, k, num, 100)


@pytest.mark.parametrize(("num", "den"), [(80, 100), (90, 100), (3, 4), (50, 100)])
def test_linked_sizes_are_at_most_one_band_apart(num, den):
    starts, _ = jaccard_join.bands(num, den)
    x = np.arange(1, 30_000)
    band, last = (np.searchsorted(starts, n, "right") - 1 for n in (x, x * den // num))
    assert (last - band <= 1).all()


def test_jaccard_join_finds_contained_sets_of_any_linked_size(spark):
    rows, rng = [], random.Random(6)
    for n, more in [(32, 40), (39, 48), (100, 122), (100, 125), (100, 126), (400, 500), (12, 15), (20, 25), (64, 77)]:
        w = [f"w{rng.randrange(10**9)}" for _ in range(more + 4)]
        rows += [(2 * n + 1000 * more, " ".join(w[: n + 4])), (2 * n + 1000 * more + 1, " ".join(w))]
    found = jaccard_join.near_copies(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(rows, 5, 80, 100)


def test_linked_sets_share_as_many_signatures_as_asked(monkeypatch):
    monkeypatch.setattr(jaccard_join, "BAND_RATIO", 1.2)
    monkeypatch.setattr(jaccard_join, "bands", jaccard_join.bands.__wrapped__)
    # 24 common elements and 3 in either alone. Of 11 and of 13 segments one set leaves 5 empty, more than
    # the 4 spare ones; the other leaves 4 empty and so doesn't sign them.
    places = [(0.5, 11), *((x, 13) for x in (2.5, 3.5, 4.8, 5.5, 7.5, 10.5)), (10.5, 11)]

    def made(k, salt):
        return (int(places[k][0] / places[k][1] * 2**32) << 32) + salt

    common = [made(k, salt) for k in range(8) for salt in (1, 2, 3)]
    a = [made(k, 9) for k in (0, 5, 6)]
    b = [made(k, 9) for k in (1, 7)] + [(int(1.5 / 11 * 2**32) << 32) + 9]
    token = np.array(sorted(common + a) + sorted(common + b), np.uint64)
    assert jaccard_join.bands(80, 100)[1][np.searchsorted(jaccard_join.bands(80, 100)[0], 27, "right") - 1] == ("exact", 11, 4, 1)
    row, sig, need = jaccard_join.signatures(token, np.array([0, 27, 54]), 80, 100)
    shared = [len(set(sig[row == s].tolist()) & set(sig[row == 2 + s].tolist())) for s in (0, 1)]
    assert any(shared[s] >= max(need[s], need[2 + s]) for s in (0, 1))


def test_jaccard_join_odd_rows(spark):
    found = jaccard_join.near_copies(spark.createDataFrame(ODD, SCHEMA)).collect()
    assert len(found) == len(ODD)
    assert {(r.doc_id, r.component_id) for r in found if r.doc_id in (1, 2, 3, 4, 5)} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 4)}
    assert jaccard_join.near_copies(spark.createDataFrame([], SCHEMA)).count() == 0


def brute_removal(rows, window):
    first, out = {}, {}
    for i, t in rows:
        w = words(t)
        for j in range(len(w) - window + 1):
            key = tuple(w[j : j + window])
            first[key] = min(first.get(key, i), i)
    for i, t in rows:
        w, gone = words(t), set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < i:
                gone.update(range(j, j + window))
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("company", [200, 8, 1])
def test_repeated_passages(spark, company):
    rng = random.Random(4)
    passage = [f"p{j}" for j in range(90)]
    rows = []
    for i in range(40):
        own = [f"o{rng.randrange(10**7)}" for _ in range(rng.randrange(5, 80))]
        a, b = sorted(rng.sample(range(91), 2))
        rows.append((i, " ".join([*own, *passage[a:b], *own[::-1], *(passage if i % 3 == 0 else [])])))
    rows += [(100 + i, rows[i % 4][1]) for i in range(8)] + [(200, "z " * 400), (201, "z " * 300), (202, None), (203, "few words")]
    found = substring_dedup.repeated_passages(with_clashes(spark.createDataFrame(rows, SCHEMA)), company=company).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == brute_removal(rows, 50)


def test_repeated_passages_odd_rows(spark):
    found = substring_dedup.repeated_passages(spark.createDataFrame(ODD, SCHEMA)).collect()
    assert len(found) == len(ODD) and all(r.n_removed == 0 for r in found)
    assert substring_dedup.repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_decontamination(spark):
    rng = random.Random(5)
    bench = [(0, " ".join(f"q{j}" for j in range(30))), (1, "short one"), (2, None), (3, "!!!"), (4, " ".join(f"q{j}" for j in range(20, 45))), (5, "lone")]
    docs = []
    for i in range(40):
        w = [rng.choice(["a", "b", "lone" if i % 9 == 0 else "c"]) for _ in range(rng.randrange(40))]
        a = rng.randrange(45)
        w[3:3] = [f"Q{j}" for j in range(a, min(45, a + rng.randrange(20)))]
        docs.append((i, "; ".join(w)))
    docs += [(50, "Short ONE"), (51, None), (52, "")]

    def tok(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())

    window = {}
    for i, t in bench:
        w = tok(t)
        n = min(10, len(w))
        for j in range(len(w) - n + 1 if n else 0):
            window.setdefault(tuple(w[j : j + n]), set()).add(str(i))
    expected = {}
    for i, t in docs:
        w, hit, items = tok(t), set(), set()
        for key, of in window.items():
            for j in range(len(w) - len(key) + 1):
                if tuple(w[j : j + len(key)]) == key:
                    hit.update(range(j, j + len(key)))
                    items |= of
        expected[i] = (len(w), len(hit), sorted(items))
    b = spark.createDataFrame(bench, "item_id long, text string")
    found = decontaminate.decontaminate(with_clashes(spark.createDataFrame(docs, SCHEMA)), b).collect()
    assert {r.doc_id: (r.n_words, sum(s["end"] - s["start"] for s in r.hits), list(r["items"])) for r in found} == expected
    hit = {r.text_md5 for r in decontaminate.contaminated_texts(with_clashes(spark.createDataFrame(docs, SCHEMA)), b).collect()}
    assert hit == {hashlib.md5((t or "").encode()).hexdigest() for i, t in docs if expected[i][1]}
    none = decontaminate.decontaminate(spark.createDataFrame(ODD, SCHEMA), b.limit(0)).collect()
    assert len(none) == len(ODD) and not any(r.hits for r in none)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(tokens.vocabulary_path())
    made.encode_special_tokens = True
    return made


def test_stretches_give_the_same_ids(tokenizer):
    import pyarrow as pa

    rng = random.Random(3)
    signs = ["a", "Z", " ", "  ", "\n", "\n\n", "\t", "'s", "'", "é", "ß", ",", ".", "1", "23", " ", "　", "%%", "日", "<|endoftext|>", "\r\n", "’", " -", "\x00"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(15))) for _ in range(20_000)]
    got = []
    for _, _, ids, at in tokens.encoded(pa.array(texts), tokens.vocabulary_path(), 2):
        got += [ids[a : b - 1].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def unmodified():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


def test_added_tokens_keep_their_id(unmodified):
    import pyarrow as pa

    rng = random.Random(8)
    signs = ["a", "Z", " ", "  ", "\n", "\n\n", "'s", "é", ".", "1", "日", "<|endoftext|>", "<|endoftext|>", "<|endo", "ftext|>", "\r\n", " -"]
    texts = ["a <|endoftext|> b", "<|endo", "ftext|>", *("".join(rng.choice(signs) for _ in range(rng.randrange(15))) for _ in range(20_000))]
    got = []
    for _, _, ids, at in tokens.encoded(pa.array(texts), tokens.vocabulary_path(), 2, added=True):
        got += [ids[a : b - 1].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]
    assert got[0] == [64, 220, 50256, 275]
    assert got == [e.ids for e in unmodified.encode_batch(texts, add_special_tokens=False)]


def test_packing_and_token_files_keep_added_tokens(spark, unmodified, tmp_path):
    rows = [(1, "a <|endoftext|> b"), (2, "x<|endoftext|>")]
    docs = spark.createDataFrame(rows, SCHEMA)
    ids = {i: unmodified.encode(t, add_special_tokens=False).ids for i, t in rows}
    assert {r.doc_id: r.doc_tokens for r in packing.pack(docs).collect()} == {i: len(x) + 1 for i, x in ids.items()}
    folder, files = token_files.write_token_files(docs, "file://" + str(tmp_path / "ids"))
    assert {r.doc_id: list(r.ids) for r in token_files.read_token_files(spark, folder, files).collect()} == {i: [*x, 2] for i, x in ids.items()}


def test_packing(spark, tokenizer):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "γ"]) for _ in range(rng.randrange(400)))) for i in range(60)] + [(100, "long " * 9000), (101, None), (102, "")]
    found = packing.pack(with_clashes(spark.createDataFrame(rows, SCHEMA))).toPandas()
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t in rows}
    assert found.length.sum() == sum(map(len, ids.values()))
    for r in found.itertuples():
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    for _, g in found.sort_values("start").groupby("doc_id"):
        assert (g.start.to_numpy() == np.r_[0, np.cumsum(g.length)][:-1]).all()
    padding = 0
    for _, g in found.sort_values("offset").groupby("sequence_id"):
        assert (g.offset.to_numpy() == np.r_[0, np.cumsum(g.length)][:-1]).all()
        n = int(g.length.sum())
        assert n <= 2048
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding == 0 and set(found.sequence_id) == set(range(found.sequence_id.nunique()))
    assert packing.pack(spark.createDataFrame([], SCHEMA)).count() == 0
    assert packing.pack(spark.createDataFrame(ODD, SCHEMA)).where("start = 0").count() == len(ODD)


def test_token_files_round_trip(spark, tokenizer, tmp_path):
    rows = [(i * 3, f"text {i} " * (i % 50)) for i in range(400)] + [(7, None), (8, ""), (10**7, "long " * 50_000), (9, "twice"), (9, "twice")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    folder, files = token_files.write_token_files(with_clashes(docs), "file://" + str(tmp_path / "ids"))
    got = token_files.read_token_files(spark, folder, files).toPandas().sort_values("start")
    place = 0
    for r, (i, t) in zip(got.itertuples(), sorted(rows, key=lambda r: r[0]), strict=True):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, place, len(ids), zlib.crc32(ids.tobytes()))
        assert list(r.ids) == ids.tolist()
        place += len(ids)
    some = token_files.read_token_files(spark, folder, files, frozenset({9, 30})).toPandas()
    assert sorted(some.doc_id) == [9, 9, 9, 30] and set(zip(some.doc_id, some.start)) <= set(zip(got.doc_id, got.start))


def test_token_file_reads_only_what_is_asked_and_sees_damage(tmp_path):
    import pyarrow.fs

    store, name = pyarrow.fs.LocalFileSystem(), str(tmp_path / "one.zst")
    with store.open_output_stream(name, compression=None) as sink:
        writer = token_files.FileWriter(sink)
        for i in range(300):
            writer.add(i, np.arange(1000, dtype=np.uint32) + i)
        writer.close()
    with store.open_input_file(name) as source:
        reader = token_files.FileReader(source)
        assert [d for d, _ in reader.documents({17})] == [17] and reader.opened == 1 < len(reader.frames)
    data = bytearray(open(name, "rb").read())
    data[40] ^= 1
    open(name, "wb").write(bytes(data))
    with store.open_input_file(name) as source, pytest.raises(Exception):
        list(token_files.FileReader(source).documents())


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain(text):
    out = []
    for kind, pattern in BASE.items():
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True, "card": 16 <= len(digits) <= 19 and private_data.luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((private_data.KINDS.index(kind), *m.span()))
    return out


def test_plain_identifiers_equal_the_patterns():
    rng = random.Random(9)
    signs = ["a", "B.", "@", "@x.y", ".", "-", " ", "1", "22", "255.1", "+", "+1 ", "(", "4539 1488 0343 6467", "4539148803436467", "é", "日", "a@b.c@d.e"]
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(16)))
        assert private_data.detect(text) == plain(text), text


@pytest.mark.parametrize(("text", "kind", "span"), [
    ("ask john (at) example [dot] org now", "email", "john (at) example [dot] org"),
    ("ask john dot doe at mail dot example dot com now", "email", "john dot doe at mail dot example dot com"),
    ("pay ４５３９ １４８８ ０３４３ ６４６７ ok", "card", "４５３９ １４８８ ０３４３ ６４６７"),
    ("call plus four four one two three four five six seven eight", "phone", "plus four four one two three four five six seven eight"),
    ("to jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
    ("at 10 (dot) 0 (dot) 0 (dot) 1", "ip", "10 (dot) 0 (dot) 0 (dot) 1"),
    ("ask jane at example dot pl now", "email", "jane at example dot pl"),
    ("ask jane at mail dot example dot museum now", "email", "jane at mail dot example dot museum"),
    ("ask jane at example.se now", "email", "jane at example.se"),
    ("ask jane&#64;example&#x2e;com, now", "email", "jane&#64;example&#x2e;com"),
    ("see ?to=jane%40example%2Ecom now", "email", "jane%40example%2Ecom"),
    ("ask &#106;ane&commat;example&period;org now", "email", "&#106;ane&commat;example&period;org"),
    ("from 10&#46;0&#46;0&#46;1 on", "ip", "10&#46;0&#46;0&#46;1"),
])
def test_disguised_identifiers(spark, text, kind, span):
    row = private_data.find_private(spark.createDataFrame([(1, text)], SCHEMA)).first()
    assert [(s["kind"], text[s["start"] : s["end"]], s["plain"]) for s in row.spans] == [(kind, span, False)]


def test_private_data_leaves_prose_alone_and_redacts(spark):
    rows = [*ODD, (10, "we meet at noon dot then"), (11, "Mail a.b@c.de, or +49 30 1234567!"), (12, "@" * 50_000), (13, "1" * 50_000)]
    found = {r.doc_id: r for r in private_data.find_private(with_clashes(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert not found[10].spans and not found[12].spans and not found[13].spans
    clean = {r.doc_id: r for r in private_data.redact(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA + ", n_chars long")).collect()}
    assert clean[11].text == "Mail <EMAIL>, or <PHONE>!" and clean[11].n_chars == len(clean[11].text)
    assert private_data.redact(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_text_with_private_data_is_passed_over():
    import pyarrow as pa

    rng = random.Random(11)
    signs = ["jane", "mail", " at ", " AT\t", " dot ", ".", "com", "org", "x-1", " ", "one two three ", "four, five-six ", "seven", "ſıx six ", "×", "(at)", "é", "а", "＠", "@", "٣", "\u00ad", "1", "&#64;", "%40", "&commat;", "&", "%2"]
    texts = ["jane at example.com", "Jane AT mail.example.org, please", "one two three four five six seven×", "×one ſıx three four five six seven÷"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 14))) for _ in range(20_000)]
    for folded in private_data._FOLDS:
        texts.append(chr(folded))
    found = 0
    for lo, _, raw, offsets in private_data.W.cuts(pa.array(texts)):
        for k, (plain_one, strange) in enumerate(zip(*private_data._wanted(raw, offsets), strict=True)):
            text, every = texts[lo + k], private_data.find(texts[lo + k])
            assert private_data.find(text, bool(strange)) == every, text
            assert plain_one or strange or every == ([], []), text
            assert strange or private_data.transduce(text) is None, text
            found += bool(every[1])
    assert found > 20


def test_addresses_said_with_a_full_stop(spark):
    rows = [(1, "write to jane at example.com now"), (2, "we met at noon. then")]
    found = {r.doc_id: r.spans for r in private_data.find_private(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [(s["kind"], rows[0][1][s["start"] : s["end"]], s["plain"]) for s in found[1]] == [("email", "jane at example.com", False)] and not found[2]
    assert private_data.redact(spark.createDataFrame(rows[:1], SCHEMA)).first().text == "write to <EMAIL> now"


def test_prose_with_at_and_dot_is_left_alone():
    for text in ("we meet at noon dot then", "look at the dot and think", "he stared at it dot and comma", "we met at noon.Then we left", "sales rose 40% at home. So", "AT&T &amp; co at 100%20 off", "at one dot on the map", "rated at 7.5 of 10"):
        assert private_data.find(text) == ([], []), text


def test_spans_are_merged_in_one_pass():
    import time

    text = " ".join(f"user{k}@example.com" for k in range(100_000)) + " а"
    began = time.time()
    base, more = private_data.find(text)
    assert len(base) == 100_000 and not more and time.time() - began < 20


def test_a_disguised_beginning_keeps_the_whole_name():
    text = "write to jоhn@example.com now"
    base, more = private_data.find(text)
    assert [text[a:b] for _, a, b in base] == ["hn@example.com"] and [text[a:b] for _, a, b in more] == ["jоhn@example.com"]


def disguised(rng, kind):
    """An identifier and a disguise of it, as a reader would still read it."""
    digit = "zero one two three four five six seven eight nine".split()
    wide = lambda x: "".join(chr(ord(c) + 0xFEE0) if c.isdigit() else c for c in x)
    if kind == "email":
        name, host = rng.choice(["jane", "max.power", "a_b", "kurt-7"]), rng.choice(["example.com", "mail.example.org", "uni.de"])
        return rng.choice([
            f"{name} (at) {host.replace('.', ' (dot) ')}", f"{name}[at]{host}", f"{name} at {host.replace('.', ' dot ')}", f"{name}＠{host}", f"{name}@{host}".replace("a", "а").replace("e", "е"),
            f"{name} <at> {host.replace('.', ' [dot] ')}", f"{name}\u200b@{host}", f"{name} {{at}} {host}", f"{name} at {host.replace('.', ' dot ')} dot nu", f"{name}&#64;{host}".replace(".", "&#x2E;"), f"{name}%40{host}",
        ])
    if kind == "ip":
        parts = [str(rng.randrange(256)) for _ in range(4)]
        return rng.choice([" (dot) ".join(parts), "[.]".join(parts), wide(".".join(parts)), "．".join(parts), "[dot]".join(parts)])
    if kind == "card":
        body = [rng.randrange(10) for _ in range(15)]
        last = next(d for d in range(10) if private_data.luhn("".join(map(str, [*body, d]))))
        number = "".join(map(str, [*body, last]))
        spaced = " ".join(number[k : k + 4] for k in range(0, 16, 4))
        return rng.choice([wide(number), wide(spaced), " ".join(digit[int(c)] for c in number), spaced.replace(" ", "–"), "\u200b".join(number)])
    number = "".join(str(rng.randrange(10)) for _ in range(10))
    return rng.choice(["plus " + " ".join(digit[int(c)] for c in "49" + number), "＋49 " + wide(number), "+" + wide("49" + number), "+49\u200b" + number[:5] + "\u200b" + number[5:], "+49–" + number])


@pytest.mark.parametrize("kind", private_data.KINDS)
def test_recall_of_planted_disguises(spark, kind):
    rng, rows, planted = random.Random(kind), [], {}
    prose = "the quick brown fox had a look around and then went home".split()
    for i in range(300):
        before, after, hidden = (" ".join(rng.choice(prose) for _ in range(rng.randrange(1, 9))) for _ in range(3))
        hidden = disguised(rng, kind)
        text = f"{before}: {hidden}, {after}"
        rows.append((i, text))
        planted[i] = (text.index(hidden), text.index(hidden) + len(hidden))
    found = {r.doc_id: {(s["kind"], s["start"], s["end"]) for s in r.spans} for r in private_data.find_private(spark.createDataFrame(rows, SCHEMA)).collect()}
    caught = [any(k == kind and a <= planted[i][0] and planted[i][1] <= b for k, a, b in found[i]) for i in planted]
    assert np.mean(caught) >= 0.9, [rows[i][1] for i in planted if not caught[i]][:5]


def test_private_data_query_columns(spark, tmp_path):
    from strandspark.llm import queries

    rng = random.Random(12)
    parts = ["a.b@c.de", "x@y", "10.0.0.1", "999.1.1.1", "4539 1488 0343 6467", "4539148803436468", "+49 30 1234567", "+1", "jane (at) example.com", "é", "日本", "word", "1-2-3"]
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(9)))) for i in range(200)] + [(500, None), (501, ""), (502, "w " * 30_000 + "a.b@c.de")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op6_private_data(spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        want = plain(text or "")
        listed = ",".join(f"{private_data.KINDS[k]}:{a}:{b}" for k, a, b in want)
        r = found[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for k, _, _ in want) for j in range(4)] and r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(listed.split(",")) - {""} <= set(spans) and len(spans) == len(want) + r.n_disguised


def test_items_with_one_prompt(spark):
    from pyspark.sql import functions as F

    prompt = " ".join(f"answer{j}" for j in range(12))
    items = [(i, f"{prompt} {i} plus {i}") for i in range(6_000)] + [(None, prompt), (5, prompt)]
    docs = [(i, f"x{i} {prompt} y{i}") for i in range(2_000)] + [(9_000, prompt + " 17 plus 17"), (9_001, prompt[:-2])]
    digest = lambda x: F.struct(F.size(x).alias("n"), F.md5(F.array_join(x, ",")).alias("md5"))
    found = decontaminate.decontaminate(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"), describe=digest).collect()
    every = sorted({str(i) for i, _ in items})
    want = (len(every), hashlib.md5(",".join(every).encode()).hexdigest())
    got = {r.doc_id: (r["items"].n, r["items"].md5, sum(s.end - s.start for s in r.hits)) for r in found}
    assert got[9_000] == (*want, 15) and got[9_001] == (*want, 11)
    assert all(got[i] == (*want, 12) for i in range(2_000)) and len(got) == len(docs)


def test_thue_morse_texts_are_told_apart(spark):
    from tests.llm.test_hashes import thue_morse

    a, b = thue_morse(2048), thue_morse(2048, "b", "a")
    item = spark.createDataFrame([(1, " ".join(a) + " end"), (2, a)], "item_id long, text string")
    found = {r.doc_id: list(r["items"]) for r in decontaminate.decontaminate(spark.createDataFrame([(1, b), (2, a)], SCHEMA), item).collect()}
    assert found == {1: [], 2: ["2"]}
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, a), (4, b)]
    removed = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert removed == brute_removal(rows, 50)
    joined = jaccard_join.near_copies(spark.createDataFrame(rows, SCHEMA), k=3, num=90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in joined} == brute_components(rows, 3, 90, 100)
