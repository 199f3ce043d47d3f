"""Operators against brute force on a small fixture: nulls, empty and long texts, ties, repeated rows, extra columns."""

import hashlib
import importlib.util
import random
import re
import time
import zlib

import numpy as np
import pytest

if importlib.util.find_spec("tidewright.llm") is None:
    pytest.skip("the subpackage is not there", allow_module_level=True)

from tidewright.llm import bpe, fingerprint, html, langid, packing, perplexity, simhash, substrings, suffixes, token_files
from tidewright.llm.queries import END_ID, VOCABULARY, tokenizer_spec

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, block int, kind string, row string"


def fixture():
    r = random.Random(5)
    words = ["the", "of", "und", "Straße", "élan", "don't", "x%%%", "漢字", "Σας", "🔥", "a1b2"] + ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(150)]
    texts = [" ".join(r.choice(words) for _ in range(r.choice([3, 12, 40, 120]))) for _ in range(40)]
    shared = " ".join(r.choice(words) for _ in range(60))
    texts += [t + "\n" + shared + " " + str(i) for i, t in enumerate(texts[:8])] + texts[:5] + [shared, None, "", " \n", "a" * 3000, "ab" * 500, "<|endoftext|> x", " ".join(words * 40)]
    rows = [(i, t, "en" if i % 2 else None, "s", 0, 7, "k", "r") for i, t in enumerate(texts)]
    rows += [(3, "tie of an id " + shared, "en", "s", 0, 7, "k", "r"), rows[6], (None, shared + " no id", None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return fixture()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def key(i):
    return -(2**63) if i is None else i


def test_bpe_equals_the_library(docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(tokenizer_spec())
    want = []
    for i, text, *_ in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got(bpe.encode_decode(docs, tokenizer_spec()), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)


def test_token_files_round_trip(docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(tokenizer_spec())
    want, start = [], 0
    for i, text, *_ in sorted(rows, key=lambda r: (key(r[0]), r[1] is not None, r[1] or "")):
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    files = token_files.write_token_files(docs, tokenizer_spec(), VOCABULARY, END_ID).df
    assert got(token_files.read_token_files(files), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


@pytest.mark.parametrize("bits", [1, 7, 11, 16, 17, 24, 31])
def test_bit_packing(bits):
    ids = np.random.default_rng(1).integers(0, 1 << bits, 10_001, dtype=np.uint32)
    data = token_files.pack_segment(ids, bits, block=100)
    assert (token_files.unpack_segment(data) == ids).all()
    assert (token_files.unpack_segment(data, 4321, 5678) == ids[4321:5678]).all()
    assert len(token_files.unpack_segment(token_files.pack_segment(ids[:0], bits))) == 0


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(tokenizer_spec())
    want = {}
    for i, text, *_ in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, END_ID], "<u4")
        want.setdefault((i, len(ids)), []).append(ids)
    pieces = packing.pack_documents(docs, tokenizer_spec(), END_ID).collect()
    ends, found = {}, {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert ends.get(p["sequence_id"], 0) == p["offset"]
        ends[p["sequence_id"]] = p["offset"] + p["length"]
        found.setdefault((p["doc_id"], p["doc_tokens"]), []).append((p["start"], p["length"], p["ids_crc32"]))
    assert all(e == 2048 or e & (e - 1) == 0 for e in ends.values()) and max(ends.values()) <= 2048
    assert set(found) == set(want)
    for k, parts in found.items():  # every id of each document, once for each row that has these ids
        cover = [0] * k[1]
        for start, n, crc in parts:
            assert crc in {zlib.crc32(ids[start : start + n].tobytes()) for ids in want[k]}
            cover[start : start + n] = [c + 1 for c in cover[start : start + n]]
        assert set(cover) == {len(want[k])}


def test_solved_counts_place_most_remainders():
    lengths = np.random.default_rng(3).lognormal(6.3, 1.0, 4000).astype(int) + 1
    sequences, rest = packing.placed(lengths.tolist(), 2048)
    assert len(rest) < 0.05 * len(lengths)
    assert all(2048 - 4 * 64 < sum(p[2] for p in s) <= 2048 for s in sequences)


def test_least_squares_against_brute_force():
    assert sorted(packing.combinations([1, 2, 4], 4, 3)) == [(1, 1, 2), (2, 2), (4,)]
    g = np.random.default_rng(4)
    for _ in range(30):
        a, h = g.integers(0, 3, (5, 4)).astype(float), g.integers(0, 20, 5).astype(float)
        best = np.inf  # over every set of columns, the one whose solution is not negative
        for mask in range(16):
            cols = [j for j in range(4) if mask >> j & 1]
            x = np.linalg.lstsq(a[:, cols], h, rcond=None)[0] if cols else np.zeros(0)
            if (x >= -1e-9).all():
                best = min(best, float(((a[:, cols] @ x - h) ** 2).sum()))
        x = packing.solve_counts(a, h)
        assert (x >= 0).all() and float(((a @ x - h) ** 2).sum()) == pytest.approx(best, abs=1e-6)


def test_pack_lengths_hold_each_token_once():
    lengths = np.random.default_rng(2).integers(1, 300, 500).tolist() + [1, 64, 64, 640]
    seen = [set() for _ in lengths]
    for s in packing.pack_lengths(lengths, 64):
        n = sum(k for _, _, k in s)
        assert n == 64 or n & (n - 1) == 0
        for i, a, k in s:
            assert not seen[i] & set(range(a, a + k))
            seen[i] |= set(range(a, a + k))
    assert [len(x) for x in seen] == lengths
    assert packing.pack_lengths([], 64) == []


def brute_words(rows, n):
    out, first = [], {}
    split = [(key(i), (t or "").encode().split()) for i, t, *_ in rows]
    for i, w in split:
        for a in range(len(w) - n + 1):
            k = tuple(w[a : a + n])
            first[k] = min(first.get(k, i), i)
    for (i, *_), (k, w) in zip(rows, split):
        cover, mine = [False] * len(w), set()
        for a in range(len(w) - n + 1):
            x = tuple(w[a : a + n])
            if first[x] < k or x in mine:
                cover[a : a + n] = [True] * n
            mine.add(x)
        out.append((i, len(w), sum(cover), b" ".join(x for x, c in zip(w, cover) if not c).decode()))
    return sorted(out, key=repr)


def test_substrings(docs, rows):
    assert got(substrings.dedup_windows(docs, 20), "doc_id", "n_words", "n_removed", "kept") == brute_words(rows, 20)


def brute_bytes(rows, n):
    first = {}
    data = [(key(i), (t or "").encode()) for i, t, *_ in rows]
    for i, b in data:
        for a in range(len(b) - n + 1):
            first[b[a : a + n]] = min(first.get(b[a : a + n], i), i)
    out = []
    for (i, *_), (k, b) in zip(rows, data):
        cover = bytearray(len(b))
        for a in range(len(b) - n + 1):
            if first[b[a : a + n]] < k:
                cover[a : a + n] = b"\1" * n
        out.append((i, len(b), sum(cover), len(re.findall(b"\1+", bytes(cover))), bytes(x for x, c in zip(b, cover) if not c)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [4096, 2])
def test_suffixes(docs, rows, hot):
    """``hot`` of 2 sends nearly every string singly."""
    found = suffixes.dedup_bytes(docs, hot=hot).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in found), key=repr) == brute_bytes(rows, 50)


def test_refine():
    data = np.frombuffer(b"abracadabra" * 30 + b"xabracadabra" * 20, np.uint8)
    ids = suffixes.refine(data, 21)
    places = {}
    for i in range(len(data) - 21):
        places.setdefault(data[i : i + 21].tobytes(), set()).add(int(ids[i]))
    assert all(len(v) == 1 for v in places.values()) and len({*map(tuple, places.values())}) == len(places)


def brute_groups(rows):
    prints = [int(simhash.majority(simhash.shingle_digests(t or "", 3))[0]) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                parent[find(a)] = find(b)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, f"{prints[i]:016x}", least.get(find(i))) for i, (d, *_) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("bucket", [1024, 2])
def test_simhash(docs, rows, bucket, monkeypatch):
    """A bucket of 2 sends most buckets through their refinement."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    assert got(simhash.near_groups(docs), "doc_id", "fingerprint", "component_id") == brute_groups(rows)


def brute_paragraphs(text):
    """Paragraphs of one text by the rule itself, a word at a time; only the hash of a word is the operator's."""
    out, now, words = [], b"", 0
    data = (text or "").encode()
    for w in re.findall(rb"[^ \n]*[ \n]|[^ \n]+", data):
        for i in range(0, len(w), fingerprint.WORD_BYTES):
            part = w[i : i + fingerprint.WORD_BYTES]
            x = np.frombuffer(part, np.uint8)
            h = int(fingerprint._hashes(x)(np.array([0]), np.array([len(x)]))[0])
            now, words = now + part, words + 1
            if h % fingerprint.WORDS == 0 or part.endswith(b"\n") or words == fingerprint.MOST_WORDS:
                out.append(now)
                now, words = b"", 0
    return out + [now] if now else out


def multiset(paragraphs):
    seen, out = {}, set()
    for p in paragraphs:
        seen[p] = seen.get(p, -1) + 1
        out.add((p, seen[p]))
    return out


def test_fingerprints(docs, rows):
    order = sorted(rows, key=lambda r: (-key(r[0]), r[1] is not None, r[1] or ""))
    want = []
    for i, (d, t, *_) in enumerate(order):
        t, after = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        e = t[: len(t) - k] + after[:k]
        a, b, c = (multiset(brute_paragraphs(x)) for x in (t, e, after))
        like = lambda x, y: round(len(x & y) / len(x | y), 9) if x | y else 1.0
        want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprint.fingerprint(t), fingerprint.fingerprint(e), like(a, b), like(a, c)))
    found = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in fingerprint.edited_versions(docs).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    for w, nxt in zip(want, want[1:]):  # from nothing but the emitted strings
        assert fingerprint.compare(w[3], w[4]) == pytest.approx(w[5])
        assert fingerprint.compare(w[3], nxt[3]) == pytest.approx(w[6])


def test_paragraphs_are_cut_by_one_rule_for_all_lengths():
    r = random.Random(6)
    text = " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(4000))
    alike = lambda a, b: fingerprint.compare(fingerprint.fingerprint(a), fingerprint.fingerprint(b))
    for n, m in ((1102, 800), (1001, 999), (1400, 950), (28000, 27000)):
        assert alike(text[:n], text[:m]) > 0.95 * m / n - 0.06
    assert alike(text, text[:9000] + "INSERTED " + text[9000:]) > 0.98  # what follows an edit stays the same
    assert alike("x" * 30000, "x" * 29000) > 0.8  # 19 whole paragraphs of 1536 characters, and 18
    offsets, a, b, _ = fingerprint.paragraphs([t.encode() for t in (text, "", "x" * 5000 + "\n\nz")])
    assert a[0] == 0 and (a[1:] == b[:-1]).all() and b[-1] == len(text) + 5003 and offsets[1] == offsets[2]
    assert offsets[-1] == len(a)


def test_a_check_that_fits_by_chance_does_not_peel_for_ever():
    k, size = np.array([12345], np.uint64), np.array([4])
    cells = np.zeros(12, np.uint64), np.zeros(12, np.int16), np.zeros(12, np.uint16)
    fingerprint._add(cells, fingerprint._places(k, np.zeros(1, int), size)[:1], k, np.ones(1, np.int16))  # in one row, not in three
    assert not fingerprint._peel(cells, np.zeros(1, int), size)[3][0]


def test_differing_paragraphs_are_recovered():
    r = random.Random(9)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(3000)]
    a, b = " ".join(words), " ".join(words[:1500] + ["new"] + words[1501:])
    x, y = (fingerprint.sketches(*fingerprint.digests([t.encode()])) for t in (a, b))
    one = np.zeros(1, int)
    assert fingerprint.differences(x, one, y, one)[0] == len(multiset(brute_paragraphs(a)) ^ multiset(brute_paragraphs(b)))
    got = fingerprint.load(fingerprint.fingerprint(a)).keys
    assert sorted(got.tolist()) == sorted(fingerprint.digests([a.encode()])[1].tolist())


def test_quality_counts(docs, rows):
    def one(d, t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        cover = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        return d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w)

    found = perplexity.quality(docs)
    assert got(found, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted((one(d, t) for d, t, *_ in rows), key=repr)
    assert all(not (r["base_failed"] and r["kept"]) for r in found.collect())


def brute_kneser_ney(texts, order, d=None):
    """p(byte | bytes before) by dictionaries, a count at a time; ``d``: discounts by order, else from these texts. Gives (p, d)."""
    raw = {}
    for t in texts:
        t = b"\0" * (order - 1) + t + b"\0"
        for i in range(order - 1, len(t)):
            raw[t[i - order + 1 : i + 1]] = raw.get(t[i - order + 1 : i + 1], 0) + 1
    value, values = raw, {order: raw}
    for k in range(order - 1, 0, -1):
        shorter = {}
        for g in value:
            shorter[g[1:]] = shorter.get(g[1:], 0) + 1
        value = values[k] = shorter
    d = d or {k: perplexity.discounts(*(sum(x == i for x in v.values()) for i in (1, 2, 3, 4))) for k, v in values.items()}

    def p(g):
        if not g:
            return 1 / 256
        v, k = values[len(g)], len(g)
        same = [x for h, x in v.items() if h[:-1] == g[:-1]]
        if not same:
            return p(g[1:])
        left = lambda x: max(0.0, x - d[k][min(x, 3)])
        return left(v.get(g, 0)) / sum(same) + max(1e-9, 1 - sum(map(left, same)) / sum(same)) * p(g[1:])

    return p, d


def mean_log(p, text, order):
    t = b"\0" * (order - 1) + text + b"\0"
    return -sum(np.log(p(t[i - order + 1 : i + 1])) for i in range(order - 1, len(t))) / (len(text) + 1)


def test_perplexity_against_a_brute_force_model(spark):
    r = random.Random(12)
    texts = ["".join(r.choice("abcd é") for _ in range(r.randint(0, 40))) for _ in range(14)] + ["abca", "abca", "", "zzz~"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    data, order = [t.encode() for t in texts], 3
    model = perplexity.fit(docs, order)
    p, d = brute_kneser_ney(data, order)
    for context in (b"\0\0", b"ab", b"a ", b"zz", b"\xc3\xa9", b"qq"):
        assert sum(p(context + bytes([c])) for c in range(256)) == pytest.approx(1)
    assert model.negative_logs(data) == pytest.approx([mean_log(p, t, order) for t in data])
    new = [b"abdc unseen", b"~~"]
    assert model.negative_logs(new) == pytest.approx([mean_log(p, t, order) for t in new])
    times = np.array([2 if t == b"abca" else 1 for t in data])  # without the text itself and its copies
    want = [mean_log(brute_kneser_ney([x for j, x in enumerate(data) if (x != t if t == b"abca" else j != i)], order, d)[0], t, order) for i, t in enumerate(data)]
    assert model.negative_logs(data, times) == pytest.approx(want)


def test_perplexity_counts_each_gram_by_itself(spark):
    texts = [b"x1yz" * 3, b"xqyw", b"x1yz xqyw", b"a qyz"]  # codes of x1yz and xqyw, and of 1yz and qyw, differ by 4,194,301
    docs = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id long, text string")
    model = perplexity.fit(docs)
    p, d = brute_kneser_ney(texts, 4)
    assert model.negative_logs(texts) == pytest.approx([mean_log(p, t, 4) for t in texts])
    want = [mean_log(brute_kneser_ney(texts[:i] + texts[i + 1 :], 4, d)[0], t, 4) for i, t in enumerate(texts)]
    assert model.negative_logs(texts, np.ones(4, np.int64)) == pytest.approx(want)


def test_perplexity_of_a_model_that_its_arrays_cannot_hold(spark, docs, monkeypatch):
    rows = lambda: sorted(perplexity.quality(docs).collect(), key=lambda r: repr(r[:-1]) + f"{r[-1] or 0:.6f}")
    whole = rows()
    carried = got(perplexity.keep_good(docs), *docs.columns)
    unseen = [b"abdc unseen", b"~~", b""]
    logs = perplexity.fit(docs).negative_logs(unseen)
    held = 9
    monkeypatch.setattr(perplexity, "HELD", held)
    model = perplexity.fit(docs)
    assert model.rest is not None and all(len(t.codes) <= held for x in model.levels for t in (x.grams, x.contexts))
    assert model.negative_logs(unseen) == pytest.approx(logs)
    assert got(perplexity.keep_good(docs), *docs.columns) == carried
    for r, want in zip(rows(), whole, strict=True):
        assert r[:-1] == want[:-1] and r["perplexity"] == (want["perplexity"] and pytest.approx(want["perplexity"], rel=1e-9))
    assert perplexity.quality(docs.limit(0), model).count() == 0 and perplexity.quality(docs.limit(20), model).count() == 20


def test_verdicts_follow_the_bands(docs):
    rows = perplexity.quality(docs).collect()
    assert {r["doc_id"] for r in rows if r["kept"]} <= {r["doc_id"] for r in rows if not r["base_failed"]}
    scored = perplexity.score(docs, perplexity.fit(docs)).collect()
    good = [r for r in scored if r["n_words"] >= 10 and 100 * r["n_repeat_words"] <= 20 * r["n_words"]]
    for lang in {r["lang"] for r in good}:
        part = sorted(r["log_perplexity"] for r in good if r["lang"] == lang)
        q1, q3 = part[-(-len(part) // 4) - 1], part[-(-3 * len(part) // 4) - 1]
        for r in good:
            if r["lang"] == lang:
                spread = max(q3 - q1, 0.02) * (1 + (perplexity.SHORT / r["n_words"]) ** 0.5)
                inside = q1 - perplexity.REACH * spread <= r["log_perplexity"] <= q3 + perplexity.REACH * spread
                assert {x["kept"] for x in rows if x["doc_id"] == r["doc_id"] and abs(x["perplexity"] - np.exp(r["log_perplexity"])) < 1e-9} == {inside}


def test_both_fences_reject(spark):
    r = random.Random(8)
    words = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(600)]
    prose = lambda n: r.choices(words, weights=[1 / (i + 3) for i in range(600)], k=n)
    stock = [prose(6) for _ in range(16)]
    rows = [(i, " ".join(prose(90) + [x for j, s in enumerate(stock) if r.random() < (0.9 if j % 4 else 0.2) for x in s][:48])) for i in range(300)]
    rows += [(1000, " ".join(f"junk{i}" for i in range(90)))]  # words that nothing else has
    rows += [(1001, " ".join(x for s in stock for x in s))]  # nothing but what the others repeat
    rows += [(1002, " ".join(r.choices(words[:6], k=110)))]  # nothing but the commonest words
    rows += [(2000 + i, rows[7][1] + f" end{i}") for i in range(20)]  # near copies of a good text
    out = {x["doc_id"]: x for x in perplexity.quality(spark.createDataFrame([(*x, "en") for x in rows], "doc_id long, text string, lang string")).collect()}
    assert not any(x["base_failed"] for x in out.values())
    good = [x["perplexity"] for i, x in out.items() if i < 300]
    assert not out[1000]["kept"] and out[1000]["perplexity"] > max(good)
    assert out[1001]["perplexity"] < sorted(good)[len(good) // 10]
    assert not out[1002]["kept"] and out[1002]["perplexity"] < min(good)
    assert all(out[2000 + i]["kept"] for i in range(20)) and sum(out[i]["kept"] for i in range(300)) > 290


def test_language_held_out(spark):
    r = random.Random(3)
    bits = {"aa": ["sch", "ung", "ein", "ich"], "bb": ["tion", "the", "ing", "and"], "cc": ["eau", "oux", "ette", "que"]}
    rows = [(i, " ".join("".join(r.choices(bits[k], k=3)) for _ in range(30)), k) for i in range(300) for k in [r.choice("abc") * 2]]
    rows += [(1000, None, "aa"), (1001, "12 34", "bb"), (None, "tionthe ingand", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {x["doc_id"]: x for x in langid.identify(docs, langid.fit(docs)).collect()}
    tested = [(i, k) for i, _, k in rows[:300] if out[i]["held_out"]]
    assert tested and sum(out[i]["lang_pred"] == k for i, k in tested) / len(tested) > 0.95
    assert out[1000]["lang_pred"] == out[1001]["lang_pred"] == "und" and out[None]["lang_pred"] == "bb"
    assert {x["lang_pred"] for x in langid.identify(docs, langid.fit(docs.limit(0))).collect()} == {"und"}


PAGE = '<html><head><title>T</title><script>if (a<b) "</p>"</script></head><body><header>Top</header><nav><ul><li><a>m</a></ul></nav><div class="cookie-notice">ok?</div>{}<div class="comments"><p>first!</p></div><aside>side</aside><form>f</form><footer>&copy;</footer>'


def test_main_text():
    page = PAGE.format("<article><h1>A &amp; B</h1><p>one <b>bold</b>\n two<br>three<p>x &lt; y</p><div class='ad'>buy</div></article>")
    assert html.main_text(page) == "A & B\none bold two three\nx < y"
    assert html.main_text(PAGE.format("<div><p>plain</p></div>")) == "plain"
    assert html.main_text(None) == "" and html.main_text("<p>cut <a hre") == "cut"


def test_style_tree_drops_what_a_site_repeats(spark):
    rows = [(i, f"http://h.example/{i}", f"<body><div class='zz'><p>same on every page</p></div><div class='body0'><p>own {i}</p><p>more {i * 7}</p></div>", "x") for i in range(12)]
    rows += [(50, None, None, "x"), (51, "http://other.example/", "<p>alone</p>", "x")]
    out = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string")).collect()}
    assert out[3] == "own 3\nmore 21" and out[50] == "" and out[51] == "alone"


def brute_importances(pages):
    """By the definition, a host's pages in one dictionary and nodes by recursion from the root."""
    m, looks, texts, children = {}, {}, {}, {}
    for page in pages:
        blocks, shape = html.parse(page)
        for path, (parent, _, steps) in shape.items():
            m[path] = m.get(path, 0) + 1
            looks.setdefault(path, {})[steps] = looks.get(path, {}).get(steps, 0) + 1
            children.setdefault(parent, set()).add(path)
        for path, text in {(b.path, b.text) for b in blocks if b.path in shape}:
            texts.setdefault(path, {})[text] = texts.get(path, {}).get(text, 0) + 1

    out = {}

    def visit(path):  # (importance, texts in the branch)
        below = [visit(c) for c in children.get(path, ())]
        n, doubt = m[path], (m[path] - 1) / (m[path] + html.DOUBT)
        entropy = sum(-x / n * np.log(x / n) for x in looks[path].values()) / np.log(n) if n > 1 else 0
        look = 1 - doubt * (1 - entropy) if n > 1 else 1.0
        own = texts.get(path, {})
        say = 1 - doubt * sum(np.log(c) / np.log(n) for c in own.values()) / len(own) if own and n > 1 else 1.0
        weight = sum(w for _, w in below)
        fade = html.DECAY ** len(looks[path])
        inner = (1 - fade) * look + fade * sum(i * w for i, w in below) / weight if weight else look
        value = (say * len(own) + inner * weight) / (weight + len(own)) if own else inner
        out[path] = value
        return value, weight + len(own)

    for top in children.get(0, ()):
        visit(top)
    return out


def test_style_tree_against_brute_force(spark):
    r = random.Random(2)
    pages = [f"<body><div class='top'><b>Site</b><ul><li>{r.choice('ab')}<li>c</ul></div><div id='m{i}'><h1>title {i}</h1>{''.join(f'<p>own {r.random()}</p>' for _ in range(r.randint(1, 4)))}{'<table><tr><td>x</table>' if i % 3 else ''}</div><div class='end'><div><p>same</p><p>{r.choice(['u', 'v'])}</p></div></div>" for i in range(9)]
    rows = [(i, "http://a.example/", p) for i, p in enumerate(pages)] + [(90, "http://b.example/", pages[0]), (91, "http://c.example/", None), (92, "http://d.example/", "plain"), (93, "http://a.example/x", pages[3])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {(x["host"], x["path"]): x["importance"] for x in html.importances(table).collect()}
    want = {("a.example", k): v for k, v in brute_importances([*pages, pages[3]]).items()} | {("b.example", k): v for k, v in brute_importances(pages[:1]).items()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)


def test_a_branch_goes_whose_text_lies_deep(spark):
    same = "<div class='x'><div class='y'><div class='z'><p>always the same</p></div></div></div>"
    rows = [(i, "http://deep.example/", f"<body>{same}<div class='t'><p>own words {i}</p><p>and {i * 31}</p></div>") for i in range(40)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {x["text"] for x in html.extract(table).collect()} == {f"own words {i}\nand {i * 31}" for i in range(40)}
    assert html.extract(table.limit(0)).count() == 0


@pytest.mark.parametrize("part", ["<a '", '<a ">" ', "<ul>", "<!x", "<div class='x'>", "<p>x</q>", "<script>", "<", "<li>a", "<p>a<i class=q>x"])
def test_bad_markup_takes_linear_time(part):
    import time

    began = time.process_time()
    html.main_text(part * (2_000_000 // len(part)))
    assert time.process_time() - began < 10


def test_empty_tables(docs):
    none = docs.limit(0)
    spec = tokenizer_spec()
    made = [bpe.encode_decode(none, spec), packing.pack_documents(none, spec, END_ID), token_files.read_token_files(token_files.write_token_files(none, spec, VOCABULARY, END_ID).df), substrings.dedup_windows(none), suffixes.dedup_bytes(none), simhash.near_groups(none), fingerprint.edited_versions(none), perplexity.quality(none), langid.identify(none, langid.fit(none)), bpe.encode_decode(none, spec)]
    assert [m.count() for m in made] == [0] * len(made)


def test_long_fragments_merge_like_the_library():
    from tokenizers import Tokenizer

    r = random.Random(1)
    mine, library = bpe.ForcedBoundaryBPE.of(tokenizer_spec()), Tokenizer.from_str(tokenizer_spec())
    for letters in ("a", "ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz", "!-=", "aé"):
        for n in (63, 64, 65, 66, 200, 30_000):
            text = "".join(r.choice(letters) for _ in range(n))
            assert mine.ids(text) == library.encode(text, add_special_tokens=False).ids
    began = time.process_time()
    mine.ids("b" * 300_000)
    assert time.process_time() - began < 20


def test_very_long_texts(spark):
    """Texts of a megabyte, of one character, of few words and of ordinary ones, one of them shared with a short text."""
    from tokenizers import Tokenizer

    r = random.Random(3)
    vocabulary = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(4000)]
    prose = " ".join(r.choice(vocabulary) for _ in range(150_000))
    part = " ".join(prose.split(" ")[90_000:90_060])
    texts = [prose, "a" * 1_000_000, "x y " * 250_000, "BEGIN " + part + " END", None]
    docs = spark.createDataFrame([(i, t, "en", "s", 0, 7, "k", "r") for i, t in enumerate(texts)], COLUMNS)
    library, spec = Tokenizer.from_str(tokenizer_spec()), tokenizer_spec()
    ids = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    encoded = got(bpe.encode_decode(docs, spec), "doc_id", "n_tokens", "ids_sha256")
    assert encoded == [(i, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest()) for i, x in enumerate(ids)]
    with_end = [np.array([*x, END_ID], "<u4") for x in ids]
    read = got(token_files.read_token_files(token_files.write_token_files(docs, spec, VOCABULARY, END_ID).df), "doc_id", "start", "n_tokens", "ids_crc32")
    assert read == [(i, sum(map(len, with_end[:i])), len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(with_end)]
    pieces = packing.pack_documents(docs, spec, END_ID).collect()
    for i, x in enumerate(with_end):
        mine = sorted((p["start"], p["length"], p["ids_crc32"]) for p in pieces if p["doc_id"] == i)
        assert [s for s, _, _ in mine] == [0, *np.cumsum([n for _, n, _ in mine])[:-1].tolist()] and sum(n for _, n, _ in mine) == len(x)
        assert all(zlib.crc32(x[s : s + n].tobytes()) == crc and n <= 2048 for s, n, crc in mine)
    cut = {x["doc_id"]: x for x in suffixes.dedup_bytes(docs).collect()}
    assert [cut[i]["n_removed"] for i in (0, 1, 2, 4)] == [0, 0, 0, 0]
    assert bytes(cut[3]["kept"]) == b"BEGIN" + b"END"  # the spaces on both sides are in the long text too
    words = {x["doc_id"]: x for x in substrings.dedup_windows(docs).collect()}
    assert words[3]["kept"] == "BEGIN END" and words[0]["n_removed"] == 0 and words[1]["n_words"] == 1
    assert words[2]["n_removed"] == 500_000 - 2  # all windows but the first two start with a sequence that was there
    near = got(simhash.near_groups(docs), "doc_id", "component_id")
    assert near == [(i, i) for i in range(5)]
    counts = {x["doc_id"]: x for x in perplexity.quality(docs).collect()}
    assert [counts[i]["n_words"] for i in range(5)] == [150_000, 1, 500_000, 62, 0]
    assert [counts[i]["base_failed"] for i in range(5)] == [False, True, True, False, True]
    made = {x["doc_id"]: x for x in fingerprint.edited_versions(docs).collect()}
    assert made[2]["n_chars"] == 1_000_000 and made[0]["near_edited"] > 0.2
    pages = spark.createDataFrame([(0, "http://a.b/c", "<body><p>" + prose + "</p></body>")], "page_id long, url string, html string")
    assert html.extract(pages).first()["text"] == prose
    assert html.extract(pages.limit(0)).count() == 0
