"""SimHash near-duplicate groups by deletion-variant signatures.

A fingerprint is cut into fewer segments than the distance allowed plus one, so that for two fingerprints
within it one segment differs by at most one bit. Each segment is indexed under its one-wildcard variants
(one bit masked), an equality shuffle on the variants brings candidates together, and the full distance is
verified. Equal fingerprints are one representative; a bucket passes on a spanning forest, never its pairs.

Distances whose segments would be too short to search by take several cuts, each of all bits in an order of its own, into
segments that are long enough. A cut is sure of distances below twice its segments; beyond, a pair is missed only if in every
cut every segment differs by two bits or more (cut_recall).
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staged, arrow_map, columns, cut, join_hot
from .components import components

#: A bucket of more fingerprints than this is split by variants of the rest of the fingerprint.
BUCKET = 1024
#: Hashes whose bits are counted at once.
SLICE = 1 << 15


def shingle_digests(text: str, words: int, seed: int = 42) -> bytes:
    """XXH64 digests (big-endian, end to end) of the lower-cased text's word shingles, repeats included."""
    import xxhash

    w = text.encode().lower().split()  # ASCII letters and ASCII white space, as bytes know them
    if not w:
        return b""
    joined = b" ".join(w)
    if len(w) <= words:
        return xxhash.xxh64_digest(joined, seed)
    ends = np.cumsum([len(x) + 1 for x in w]).tolist()
    digest = xxhash.xxh64_digest
    return b"".join([digest(joined[a : b - 1], seed) for a, b in zip([0, *ends], ends[words - 1 :])])


def majority(digests: bytes, signatures: int = 1) -> np.ndarray:
    """``signatures`` fingerprints of 64 bits: a bit is 1 if it is set in over half of the hashes; none: zero.

    The first fingerprint takes the hashes as they are, further ones a mix of them with their own constant.
    """
    n = len(digests) // 8
    out = np.zeros(signatures, np.uint64)
    if not n:
        return out
    hashes = np.frombuffer(digests, ">u8")
    for k in range(signatures):
        ones = np.zeros(64, np.int64)
        for i in range(0, n, SLICE):
            h = hashes[i : i + SLICE]
            if k:
                h = (h.astype(np.uint64) ^ np.uint64(0x9E3779B97F4A7C15 * k % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                h = (h ^ (h >> np.uint64(32))).astype(">u8")
            bits = np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8), axis=1)
            ones += np.add.reduce(bits, axis=0, dtype=np.uint16 if len(bits) < 65536 else np.int64)
        out[k] = np.packbits(ones * 2 > n).view(">u8")[0]
    return out


def fingerprints(docs: DataFrame, words: int = 3, signatures: int = 1) -> DataFrame:
    """(doc_id, h, w0, w1, ...) of every document's whole text, h a hash of doc_id and text; a null text has no words, and zeros."""
    names = [f"w{k}" for k in range(signatures)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in cut(whole, "text"):
                got = np.array([majority(shingle_digests(t or "", words), signatures) for t in b.column("text").to_pylist()], np.uint64).reshape(-1, signatures).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), *(pa.array(got[:, k]) for k in range(signatures))], names=["doc_id", "h", *names])

    return arrow_map(columns(docs, "doc_id", "text").select("*", F.xxhash64("doc_id", "text").alias("h")), run, "doc_id long, h long, " + ", ".join(f"{n} long" for n in names))


def _node(signatures: int) -> "F.Column":
    """One number for a fingerprint: its words, each turned by another third, xor-ed."""
    out = F.col("w0")
    for k in range(1, signatures):
        w, by = F.col(f"w{k}"), 21 * k % 64
        out = out.bitwiseXOR(F.shiftleft(w, by).bitwiseOR(F.shiftrightunsigned(w, 64 - by)))
    return out


def _nodes(m: np.ndarray) -> np.ndarray:
    out = m[:, 0].copy()
    for k in range(1, m.shape[1]):
        by = 21 * k % 64
        out ^= (m[:, k] << np.uint64(by)) | (m[:, k] >> np.uint64(64 - by))
    return out.view(np.int64)


def segments_for(distance: int, signatures: int = 1) -> list[tuple[int, int, int]]:
    """(word, shift, bits): the fewest segments of which one differs by at most one bit within ``distance``."""
    n = distance // 2 + 1
    per = -(-n // signatures)
    edges = [64 * i // per for i in range(per + 1)]
    return [(k, a, b - a) for k in range(signatures) for a, b in zip(edges, edges[1:])]


def _variants(df: DataFrame, segments: list[tuple[int, int, int]], key: str) -> DataFrame:
    """A row for each segment and masked bit: segment, bit and the masked value in one long."""
    lists = []
    for i, (word, shift, bits) in enumerate(segments):
        value = F.shiftrightunsigned(F.col(f"w{word}"), shift).bitwiseAND(F.lit((1 << bits) - 1))
        lists.append(F.array(*(F.lit((i << 48) | (p << 40)).cast("long") + value.bitwiseAND(F.lit(((1 << bits) - 1) ^ (1 << p))) for p in range(bits))))
    return df.select("*", F.explode(F.concat(*lists)).alias(key))


def cut_segments(cuts: int, segments: int, signatures: int) -> list[list[list[int]]]:
    """For each cut its segments, lists of bits: all bits in an order that is the same in every run, dealt out evenly."""
    total = 64 * signatures
    orders = [random.Random(1000 * signatures + c).sample(range(total), total) for c in range(cuts)]
    return [[sorted(order[total * i // segments : total * (i + 1) // segments]) for i in range(segments)] for order in orders]


def cut_recall(distance: int, cuts: int, segments: int, signatures: int, trials: int = 20_000) -> float:
    """Share of pairs at this distance of which some segment of some cut differs by at most one bit: measured on random pairs."""
    total, g = 64 * signatures, np.random.default_rng(1)
    where = np.argsort(g.random((trials, total)), axis=1)[:, :distance]
    met = np.zeros(trials, bool)
    for segs in cut_segments(cuts, segments, signatures):
        owner = np.zeros(total, int)
        for i, bits in enumerate(segs):
            owner[bits] = i
        counts = np.stack([(owner[where] == i).sum(axis=1) for i in range(len(segs))], axis=1)
        met |= (counts <= 1).any(axis=1)
    return float(met.mean())


def _mask(bits: list[int], signatures: int) -> list[int]:
    masks = [0] * signatures
    for b in bits:
        masks[b // 64] |= 1 << b % 64
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _masked(df: DataFrame, masks: list[tuple[int, list[int]]], signatures: int, *keep: str) -> DataFrame:
    """``keep``, the number of the mask, and the words under it, for every mask."""
    table = F.array(*(F.struct(F.lit(i).alias("i"), *(F.lit(x).cast("long").alias(f"m{k}") for k, x in enumerate(m))) for i, m in masks))
    rows = df.select(*keep, *(f"w{k}" for k in range(signatures) if f"w{k}" not in keep), F.explode(table).alias("m"))
    return rows.select(*keep, F.col("m.i").alias("i"), *(F.col(f"w{k}").bitwiseAND(F.col(f"m.m{k}")).alias(f"v{k}") for k in range(signatures)))


def cut_links(reps: DataFrame, distance: int, segs: list[list[int]], signatures: int) -> DataFrame:
    """Links (u, v) between fingerprints that meet under a one-wildcard variant of one of the segments of a cut.

    Buckets that may hold more than BUCKET fingerprints, by the counts of whole segments, are split in blocks, and every pair of
    blocks is compared: no link is lost, and a task never holds more than two blocks of a bucket.
    """
    names = [f"w{k}" for k in range(signatures)]
    values = [f"v{k}" for k in range(signatures)]
    variants = [(i << 8 | p, _mask([b for b in bits if b != bits[p]], signatures)) for i, bits in enumerate(segs) for p in range(len(bits))]
    key = F.xxhash64("i", *values).alias("k0")
    rows = _masked(reps, variants, signatures, *names).select(*names, key)
    counted = _masked(reps, [(i, _mask(bits, signatures)) for i, bits in enumerate(segs)], signatures).groupBy("i", *values).agg(F.count("*").alias("n"))
    heavy = Staged(counted.where(F.col("n") > BUCKET // 2), "heavy")
    if heavy.df.isEmpty():
        return bucket_links(rows, ["k0"], distance, signatures)
    again = heavy.df.select(F.col("i").alias("s"), "n", *(F.col(v).alias(w) for v, w in zip(values, names)))
    full = _masked(again, variants, signatures, "s", "n", *names).where(F.shiftright("i", 8) == F.col("s")).select(key, "n")
    blocks = full.groupBy("k0").agg(F.sum("n").alias("n")).where(F.col("n") > BUCKET).select("k0", F.ceil(F.col("n") / BUCKET).cast("int").alias("g"))
    mine = F.pmod(F.xxhash64(*names, F.lit(1)), F.col("g")).cast("int")
    split = rows.join(blocks, "k0", "left").withColumn("other", F.explode(F.when(F.col("g").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("g") - 1))))
    pair = F.when(F.col("g").isNull(), F.lit(0).cast("long")).otherwise(F.least(mine, "other").cast("long") * F.col("g") + F.greatest(mine, "other"))
    return bucket_links(split.select(*names, "k0", pair.alias("k1")), ["k0", "k1"], distance, signatures)


def _halves(segment: tuple[int, int, int]) -> list[tuple[int, int, int]]:
    word, shift, bits = segment
    return [(word, shift, bits // 2), (word, shift + bits // 2, bits - bits // 2)]


def links(reps: DataFrame, distance: int, segments: list[tuple[int, int, int]], signatures: int) -> DataFrame:
    """Links (u, v) between fingerprints that meet under a one-wildcard variant of one of the segments, a set that is sure of the distance.

    Two segments of one word: buckets that may hold more than BUCKET fingerprints are refined. Two members also agree up to
    one bit in a half of the rest, so the bucket is keyed again by variants of those halves; the bits left free then bound its
    size, and no link is lost. Other sets of segments are not refined.
    """
    names = [f"w{k}" for k in range(signatures)]
    total = sum(b for _, _, b in segments)
    parts, rest, keys = [], _variants(reps, segments, "k0"), ["k0"]
    # a bucket is heavy only if a segment value is: two small counts, not the variants, are grouped
    if len(segments) == 2 and total == 64 and signatures == 1:
        def heavy_of(rows: DataFrame, segs: list[tuple[int, int, int]], by: list[str], key: str, size: int) -> DataFrame:
            values = [F.struct(F.lit(i).alias("i"), F.shiftrightunsigned(F.col(f"w{w}"), s).bitwiseAND(F.lit((1 << b) - 1)).alias("x")) for i, (w, s, b) in enumerate(segs)]
            counted = rows.select(*by, F.explode(F.array(*values)).alias("s")).groupBy(*by, "s").agg(F.count("*").alias("n")).where(F.col("n") > size // 2)
            masks = F.concat(*(F.when(F.col("s.i") == i, F.array(*(F.lit((i << 48) | (p << 40)).cast("long") + F.col("s.x").bitwiseAND(F.lit(((1 << b) - 1) ^ (1 << p))) for p in range(b)))).otherwise(F.array().cast("array<bigint>")) for i, (_, _, b) in enumerate(segs)))
            return counted.select(*by, F.explode(masks).alias(key)).distinct()

        heavy = Staged(heavy_of(reps, segments, [], "k0", BUCKET), "heavy")
        if not heavy.df.isEmpty():
            big = rest.join(heavy.df, "k0", "left_semi")
            parts.append(rest.join(heavy.df, "k0", "left_anti"))
            for i, seg in enumerate(segments):  # members of a bucket of segment i: halves of the other segment
                level = _variants(big.where(F.shiftright("k0", 48) == i), _halves(segments[1 - i]), "k1")
                parts.append(level)
            keys, rest = ["k0", "k1"], None
    if rest is not None:
        parts.append(rest)
    rows = None
    for p in parts:
        p = p.select(*names, "k0", (F.col("k1") if "k1" in p.columns else F.lit(-1).cast("long")).alias("k1")) if len(keys) > 1 else p.select(*names, "k0")
        rows = p if rows is None else rows.unionByName(p)
    return bucket_links(rows, keys, distance, signatures)


def bucket_links(rows: DataFrame, keys: list[str], distance: int, signatures: int) -> DataFrame:
    """Links (u, v) that span every group of near fingerprints among the rows of equal keys: never all its pairs."""
    names = [f"w{k}" for k in range(signatures)]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, *keys).sortWithinPartitions(*keys)

    def bucket(m: np.ndarray) -> list[tuple[int, int]]:
        """Links from where each member was first reached to the start of its group: each member is compared with those not yet reached."""
        first, out = _nodes(m).tolist(), []
        left = np.arange(len(m))
        while len(left):
            root, queue, left = int(left[0]), [int(left[0])], left[1:]
            while queue and len(left):
                near = np.bitwise_count(m[left] ^ m[queue.pop()]).sum(axis=1, dtype=np.int32) <= distance
                if near.any():
                    got = left[near].tolist()
                    out += [(first[i], first[root]) for i in got]
                    queue += got
                    left = left[~near]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

        def found(k: np.ndarray, m: np.ndarray) -> Iterator[pa.RecordBatch]:
            edge = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
            starts, ends = np.concatenate([[0], edge]), np.concatenate([edge, [len(k)]])
            out: list[tuple[int, int]] = []
            pair = starts[ends - starts == 2]
            if len(pair):  # most buckets with company are pairs
                a, b = m[pair], m[pair + 1]
                near = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int32) <= distance
                out += zip(_nodes(a[near]).tolist(), _nodes(b[near]).tolist())
            for s, e in zip(starts.tolist(), ends.tolist()):
                if e - s > 2:
                    out += bucket(m[s:e])
            if out:
                out = list(set(out))
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], schema=schema)

        for b in batches:
            k = np.stack([b.column(c).to_numpy() for c in keys], axis=1)
            m = np.stack([b.column(c).to_numpy() for c in names], axis=1).view(np.uint64)
            if held is not None:
                k, m = np.concatenate([held[0], k]), np.concatenate([held[1], m])
            if not len(k):
                continue
            last = np.flatnonzero((k != k[-1]).any(axis=1))
            split = int(last[-1]) + 1 if len(last) else 0
            if split:
                yield from found(k[:split], m[:split])
            held = k[split:], m[split:]
        if held is not None and len(held[0]):
            yield from found(*held)

    return dealt.mapInArrow(run, "u long, v long")


def near_groups(docs: DataFrame, words: int = 3, distance: int = 3, signatures: int = 1, cuts: tuple[int, int] | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id): component_id is the smallest doc_id reachable over links of fingerprints.

    Null and word-less texts have fingerprint zero and link like any other; texts of any length are taken whole. Repeated rows stay
    rows of their own; a null doc_id keeps its row and never names a component unless no other id is there. Extra columns are
    ignored. An empty table gives no row. With ``cuts``, (number, segments of each), the search is by cut_links().
    """
    prints, named = _grouped(docs, words, distance, signatures, cuts)
    out = join_hot(prints.select("doc_id", "w0", _node(signatures).alias("node")), named.select("node", "component_id", "n"), "node", "n")
    return out.select("doc_id", F.lower(F.lpad(F.hex("w0"), 16, "0")).alias("fingerprint"), "component_id")


def _grouped(docs: DataFrame, words: int, distance: int, signatures: int, cuts: tuple[int, int] | None) -> tuple[DataFrame, DataFrame]:
    """The staged fingerprints, and (node, component_id, n) of every distinct one, n its documents."""
    names = [f"w{k}" for k in range(signatures)]
    spark = docs.sparkSession
    prints = Staged(fingerprints(docs, words, signatures), "fingerprints").df
    # exact copies meet here, after a map-side minimum
    reps = Staged(prints.groupBy(*names).agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).select(_node(signatures).alias("node"), *names, "least", "n"), "representatives").df
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16384")
    only = reps.select(*names).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *names)  # each row becomes hundreds
    if cuts:
        found = [Staged(cut_links(only, distance, segs, signatures).distinct(), "near").df for segs in cut_segments(*cuts, signatures)]
    else:
        found = [Staged(links(only, distance, segments_for(distance, signatures), signatures).distinct(), "near").df]
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    tree = components(edges)
    rooted = reps.join(tree, "node", "left").select("node", "least", "n", F.coalesce("root", "node").alias("root"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    named = join_hot(rooted, of_root, "root", "members").select("node", "component_id", "n")
    return prints, Staged(named, "groups").df


#: Near-duplicate documents: three fingerprints of five-word shingles. Two texts whose shingle sets have a Jaccard similarity of 0.8
#: differ in about 15 % of the bits, 29 of 192, with a deviation of 5; the distance allows for one and a half more. Three cuts in ten
#: segments are sure of 19 bits, and find all but 1 % of the pairs at 29 bits (cut_recall).
NEAR = {"words": 5, "signatures": 3, "distance": 37, "cuts": (3, 10)}


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with one of each group of near copies (NEAR): that of the smallest doc_id.

    Rows with one doc_id and text count once. Of a group without ids, rows without id stay, once for each text. Texts of any length
    are taken whole; other columns pass as they are; an empty table stays empty.
    """
    prints, named = _grouped(docs, **NEAR)
    found = join_hot(prints.select("doc_id", "h", _node(NEAR["signatures"]).alias("node")), named, "node", "n")
    keep = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "h").agg(F.count("*").alias("n"))
    keep = Staged(keep, "kept").df.select(F.col("doc_id").alias("keep_id"), F.col("h").alias("keep_h"), "n")
    doc_id, text = F.col("`doc_id`").cast("long"), F.col("`text`").cast("string")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("h"))
    kept = rows.join(keep.select("keep_id", "keep_h"), (F.col("h") == F.col("keep_h")) & F.col("doc_id").eqNullSafe(F.col("keep_id")), "left_semi")
    if not keep.where("n > 1").isEmpty():  # repeated rows
        kept = kept.dropDuplicates(["doc_id", "h"])
    return kept.select("row.*")
