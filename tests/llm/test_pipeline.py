"""The pipeline's stages, each against brute force over what its operator says, with nulls, ties and empty tables."""

import importlib.util
import random
import re

import numpy as np
import pytest

if importlib.util.find_spec("tidewright.llm") is None or importlib.util.find_spec("corpus_pipeline") is None:
    pytest.skip("the subpackage is not there", allow_module_level=True)

import corpus_pipeline as pipeline
from tidewright.llm import langid, perplexity, simhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture():
    r = random.Random(11)
    bits = {"aa": ["sch", "ung", "ein", "ich"], "bb": ["tion", "the", "ing", "and"]}
    words = {k: ["".join(r.choices(v, k=r.randint(1, 3))) for _ in range(400)] for k, v in bits.items()}
    rows = []
    for i in range(120):
        lang = r.choice("ab") * 2
        rows.append((i, " ".join(r.choices(words[lang], k=r.choice([4, 60, 150, 300]))), lang if i % 5 else None, "s", 0))
    for i in range(200, 212):  # near copies: a word or two changed
        w = rows[i - 200][1].split()
        w[len(w) // 2] = "changed"
        rows.append((i, " ".join(w) + (" Straße" if i % 2 else ""), "aa", None, None))
    shared = " ".join(r.choices(words["bb"], k=70))
    rows += [(300 + i, rows[20 + i][1] + " \ufffd\n" + shared, "bb", "s", 0) for i in range(5)]
    rows += [rows[3], (400, None, "aa", "s", 0), (401, "", None, "s", 0), (402, "12 34 56", "bb", "s", 0), (403, "tionthe " * 500, "bb", "s", 0), (None, shared + " tion", None, None, None)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return fixture()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


def ordered(found):
    return sorted((tuple(r) for r in found), key=repr)


def test_stages_are_named_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["language_id", "quality_rules", "simhash_near_dedup", "suffix_array_dedup", "packing"]


def test_language_stage(spark, docs, rows):
    model = langid.fit(docs)
    said = [model.predict([t])[0] for _, t, *_ in rows]
    want = [(*r[:2], lang, *r[3:]) for r, (lang, p) in zip(rows, said) if lang != "und" and p >= pipeline.LEAST_SCORE]
    found = pipeline.language_id(spark, docs, "")
    assert found.columns == docs.columns and ordered(found.collect()) == ordered(want)
    assert not {400, 401, 402} & {r[0] for r in want} and len(want) > 100


def test_quality_stage(spark, docs, rows):
    verdicts = {}
    for v in perplexity.quality(docs).collect():
        verdicts.setdefault(v["doc_id"], v["kept"])
    want = [r for r in rows if verdicts[r[0]]]
    found = pipeline.quality_rules(spark, docs, "")
    assert found.columns == docs.columns and ordered(found.collect()) == ordered(want)
    assert len(want) > 50
    assert not {400, 401, 402, 403} & {r[0] for r in want}


def brute_keep(rows):
    """By distances of all pairs: no segments, no buckets."""
    n = simhash.NEAR
    prints = np.array([simhash.majority(simhash.shingle_digests(t or "", n["words"]), n["signatures"]) for _, t, *_ in rows], np.uint64)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in np.flatnonzero(np.bitwise_count(prints[:a] ^ prints[a]).sum(axis=1) <= n["distance"]).tolist():
            parent[find(a)] = find(b)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [r for i, r in enumerate(rows) if least.get(find(i)) == r[0]]


def test_near_dedup_stage(spark, docs, rows):
    want = {(r[0], r[1]): r for r in brute_keep(rows)}  # a repeated row counts once
    found = pipeline.simhash_near_dedup(spark, docs, "")
    assert found.columns == docs.columns and ordered(found.collect()) == ordered(want.values())
    long_copies = [i for i in range(200, 212) if len(rows[i - 200][1].split()) >= 150]
    assert long_copies and not set(long_copies) & {d for d, _ in want}


def bits_table(spark, prints):
    rows = [(i, i, *(x - (1 << 64) if x >> 63 else x for x in (b >> 64 * k & (1 << 64) - 1 for k in range(3)))) for i, b in prints]
    return spark.createDataFrame(rows, "doc_id long, h long, w0 long, w1 long, w2 long")


def test_near_dedup_finds_lone_pairs(spark, monkeypatch):
    r = random.Random(4)
    n, pairs = simhash.NEAR, 300
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *a: docs)
    for distance, least in ((19, 1.0), (29, 0.99), (33, 0.96), (n["distance"], 0.9)):
        prints = []
        for i in range(pairs):
            bits = r.getrandbits(192)
            prints += [(2 * i, bits), (2 * i + 1, bits ^ sum(1 << b for b in r.sample(range(192), distance)))]
        found = {x["doc_id"]: x["component_id"] for x in simhash.near_groups(bits_table(spark, prints), **n).collect()}
        linked = sum(found[2 * i + 1] == 2 * i for i in range(pairs))
        assert linked >= least * pairs and len(set(found.values())) == 2 * pairs - linked
        assert simhash.cut_recall(distance, *n["cuts"], 3, 4000) >= least


def test_full_buckets_are_split_without_loss(spark, monkeypatch):
    r = random.Random(5)
    base = r.getrandbits(192)
    prints = [(i, base ^ sum(1 << b for b in r.sample(range(192), r.randint(1, 9)))) for i in range(60)] + [(100 + i, r.getrandbits(192)) for i in range(20)]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *a: docs)
    monkeypatch.setattr(simhash, "BUCKET", 4)
    found = {x["doc_id"]: x["component_id"] for x in simhash.near_groups(bits_table(spark, prints), **simhash.NEAR).collect()}
    assert found == {i: 0 if i < 100 else i for i, _ in prints}


def test_stages_carry_clashing_and_odd_columns(spark, docs, rows):
    from pyspark.sql import functions as F

    wide = docs.withColumn("keep_id", F.lit(1)).withColumn("a.b", F.timestamp_micros(F.lit(1700000000123457))).withColumn("row", F.array(F.lit("x"))).withColumn("w0", F.lit(2)).withColumn("node", F.lit(None).cast("string"))
    seen = {r["a.b"] for r in wide.limit(1).collect()}
    for name, stage in pipeline.STAGES[:-1]:
        found = stage(spark, wide, "")
        assert found.schema.simpleString() == wide.schema.simpleString(), name
        assert ordered(found.select(docs.columns).collect()) == ordered(stage(spark, docs, "").collect()), name
        assert {(r["keep_id"], r["a.b"], *r["row"], r["w0"], r["node"]) for r in found.collect()} == {(1, *seen, "x", 2, None)}, name
    assert pipeline.pack(spark, wide, "").count() == pipeline.pack(spark, docs, "").count()


def test_rows_without_id_follow_the_group_they_are_in(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(7, text), (None, text), (None, text + " more"), (None, "alone " * 3 + "quite another text"), (None, "alone " * 3 + "quite another text"), (8, None), (9, "")]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], COLUMNS)
    assert sorted(((r["doc_id"], r["text"]) for r in pipeline.simhash_near_dedup(spark, docs, "").collect()), key=repr) == sorted([(7, text), (None, "alone " * 3 + "quite another text"), (8, None)], key=repr)


def test_suffix_stage(spark, docs, rows):
    first, key = {}, lambda i: -(2**63) if i is None else i
    for i, t, *_ in rows:
        b = (t or "").encode()
        for a in range(len(b) - 49):
            first[b[a : a + 50]] = min(first.get(b[a : a + 50], key(i)), key(i))
    want = []
    for i, t, lang, source, _ in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for a in range(len(b) - 49):
            if first[b[a : a + 50]] < key(i):
                gone[a : a + 50] = b"\1" * 50
        text = bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore")
        want.append((i, text, lang, source, len(text)))
    found = pipeline.suffix_array_dedup(spark, docs, "")
    assert found.columns == docs.columns and ordered(found.collect()) == ordered(want)
    assert sum(len(w[1]) for w in want) < sum(len(r[1] or "") for r in rows)


def test_packing_stage(spark, docs, rows):
    pieces = pipeline.pack(spark, docs, "").collect()
    assert {p["doc_id"] for p in pieces} == {r[0] for r in rows}
    total = {}
    for p in pieces:
        total.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in total.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]


def test_run_applies_each_stage_to_what_the_last_kept(spark, docs, rows, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {p["doc_id"] for p in pipeline.run(spark, str(tmp_path)).collect()}
    step = docs
    for _, stage in pipeline.STAGES[:-1]:
        step = spark.createDataFrame(stage(spark, step, str(tmp_path)).collect(), docs.schema)
    assert found == {r["doc_id"] for r in step.collect()} and 0 < len(found) < len(rows)


def test_empty_documents(spark, docs):
    none = docs.limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, "").count() == 0
