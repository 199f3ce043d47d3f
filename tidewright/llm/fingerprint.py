"""Document fingerprints by invertible Bloom lookup sketches.

A text's paragraphs are hashed to digests, and each digest is added to one cell in each of three rows: a count, the xor of
digests and the xor of their checks. Cells of two versions subtract; peeling cells that hold a single digest recovers the
digests that differ, with the side they are on. If peeling stops short, the same is retried with longer rows. A sketch is kept
at the least size from which all its own digests peel, so that two fingerprints alone suffice to compare: the digests that
they give back are laid out anew where rows of their size are too short or differ.

Paragraphs are cut by content, by one rule for texts of any length: a line's words follow each other until one whose hash is
0 modulo WORDS, or until MOST_WORDS. An edit thus changes the paragraphs that it touches, and those after it stay the same.
"""

from __future__ import annotations

import base64
import hashlib
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, by_block, columns, slices
from .passes import distinct

ROWS = 3
#: Words of a paragraph on average and at most, and bytes after which a word is cut.
WORDS, MOST_WORDS, WORD_BYTES = 6, 24, 64
#: Rounds of peeling after which a table counts as stuck.
ROUNDS = 400
_HEAD = struct.Struct("<BII")
_CELL = np.dtype([("key", "<u8"), ("count", "<i2"), ("check", "<u2")])
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE, _LETTERS = 0x9E3779B97F4A7C15, np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64)] * 2


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _hashes(data: np.ndarray):
    """A function of (start, end) that hashes these stretches of the bytes, by prefix sums modulo 2**64."""
    n = len(data) + 1
    if len(_powers[0]) < n:
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(1 << max(16, int(n - 1).bit_length()), b, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    sums = np.zeros(n, np.uint64)
    np.cumsum(_LETTERS[data] * _powers[0][: n - 1], out=sums[1:])
    return lambda a, b: _mix((sums[b] - sums[a]) * _powers[1][a] + (b - a).astype(np.uint64))


def paragraphs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first paragraph of each text and one past the last, start and end of each paragraph in the joined texts, its hash)."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    edges = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    if not len(data):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    close = (data == 32) | (data == 10)
    close[edges[1:][np.diff(edges) > 0] - 1] = True
    ends = np.flatnonzero(close) + 1
    size = np.diff(ends, prepend=0)
    if size.max() > WORD_BYTES:  # long words, in parts
        many = -(-size // WORD_BYTES)
        part = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        ends = np.minimum(np.repeat(ends - size, many) + (part + 1) * WORD_BYTES, np.repeat(ends, many))
    starts = np.concatenate([[0], ends[:-1]])
    hashed = _hashes(data)
    last = np.zeros(len(data) + 1, bool)
    last[edges] = True
    stop = (hashed(starts, ends) % np.uint64(WORDS) == 0) | (data[ends - 1] == 10) | last[ends]
    place = np.arange(len(ends))
    after = np.concatenate([[-1], np.where(stop, place, -1)[:-1]])
    since = place - np.maximum.accumulate(after) - 1  # words since the paragraph began
    stop |= since % MOST_WORDS == MOST_WORDS - 1
    close = ends[stop]
    open_ = np.concatenate([[0], close[:-1]])
    return np.searchsorted(open_, edges), open_, close, hashed(open_, close)


def digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, digests) of the texts' paragraphs; a repeated paragraph of a text is told apart by how often it came before."""
    offsets, _, _, h = paragraphs(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    order = np.lexsort((np.arange(len(h)), h, owner))
    new = np.ones(len(h), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    first = np.flatnonzero(new)
    again = np.arange(len(h)) - np.repeat(first, np.diff(np.concatenate([first, [len(h)]])))
    out = h.copy()
    more = order[again > 0]
    out[more] = _mix(h[more] + again[again > 0].astype(np.uint64) * _M1)
    return offsets, out


def _stretches(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... of ``size[i]`` numbers each, end to end."""
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def sizes(n: np.ndarray) -> np.ndarray:
    """The least of 4, 6, 8, 12, 16, ... cells in a row that may hold n digests: rows together have a quarter more cells."""
    need = np.maximum(4.0, np.asarray(n, float) * 0.42)
    two = np.exp2(np.ceil(np.log2(need)))
    return np.where(need <= 0.75 * two, 0.75 * two, two).astype(np.int64).clip(4)


@dataclass
class Sketches:
    """Many sketches: cells of sketch i from base[i], rows of size[i] cells; its digests are keys[offsets[i]:offsets[i + 1]]."""

    size: np.ndarray
    base: np.ndarray
    key: np.ndarray
    count: np.ndarray
    check: np.ndarray
    offsets: np.ndarray
    keys: np.ndarray

    def bytes_of(self, i: int) -> bytes:
        a, n = int(self.base[i]), ROWS * int(self.size[i])
        cells = np.zeros(n, _CELL)
        cells["key"], cells["count"], cells["check"] = self.key[a : a + n], self.count[a : a + n], self.check[a : a + n]
        return _HEAD.pack(2, n // ROWS, int(self.offsets[i + 1] - self.offsets[i])) + cells.tobytes()


def _places(keys: np.ndarray, base: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Cells (ROWS, n) of keys in tables that begin at ``base`` and have rows of ``size`` cells."""
    h, n, low = _mix(keys), size.astype(np.uint64), np.uint64(0xFFFFFFFF)
    parts = (h & low, h >> np.uint64(32), _mix(h) & low)
    return np.stack([base + j * size + ((p * n) >> np.uint64(32)).astype(np.int64) for j, p in enumerate(parts)])


def _check(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys ^ np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.uint16)


def _add(cells: tuple, places: np.ndarray, keys: np.ndarray, signs: np.ndarray) -> None:
    checks = _check(keys)
    for row in places:
        np.bitwise_xor.at(cells[0], row, keys)
        np.add.at(cells[1], row, signs)
        np.bitwise_xor.at(cells[2], row, checks)


def _fill(owner: np.ndarray, keys: np.ndarray, signs: np.ndarray, size: np.ndarray) -> tuple[tuple, np.ndarray]:
    """Tables (cells, first cell of each) of keys with their table and sign."""
    base = np.concatenate([[0], np.cumsum(ROWS * size)])
    n = int(base[-1])
    cells = np.zeros(n, np.uint64), np.zeros(n, np.int16), np.zeros(n, np.uint16)
    _add(cells, _places(keys, base[owner], size[owner]), keys, signs)
    return cells, base[:-1]


def _peel(cells: tuple, base: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Peel many tables at once: (table, key, sign) of what comes out, and whether each table was emptied. Cells are used up.

    A cell whose check fits by chance may put back what it took, again and again: rounds are bounded, and such a table is not empty.
    """
    table = np.repeat(np.arange(len(size)), ROWS * size)
    key, count, check = cells
    found: list[tuple] = []
    look = np.flatnonzero(np.abs(count) == 1)
    for _ in range(ROUNDS):
        pure = look[np.abs(count[look]) == 1]
        pure = pure[_check(key[pure]) == check[pure]]
        k, t, s = key[pure], table[pure], count[pure]
        own = _places(k, base[t], size[t])
        right = np.flatnonzero((own == pure).any(axis=0))  # a chance match of the check lies in another cell
        if not len(right):
            break
        both = k[right] ^ _mix(t[right].astype(np.uint64))
        order = np.argsort(both)
        both = both[order]
        right = right[order[np.concatenate([[True], both[1:] != both[:-1]])]]
        k, t, s, own = k[right], t[right], s[right], own[:, right]
        _add(cells, own, k, -s)
        found.append((t, k, s))
        look = distinct(own.ravel())
    empty = np.ones(len(size), bool)
    empty[table[(count != 0) | (key != 0)]] = False
    t, k, s = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int16))
    return t, k, s, empty


def sketches(offsets: np.ndarray, keys: np.ndarray) -> Sketches:
    """Sketches of lists of digests, each at the least size that gives all of them back."""
    n = np.diff(offsets)
    size = sizes(n)
    left = np.arange(len(n))
    while len(left):  # find the sizes
        rows = _stretches(offsets[:-1][left], n[left])
        cells, base = _fill(np.repeat(np.arange(len(left)), n[left]), keys[rows], np.ones(len(rows), np.int16), size[left])
        left = left[~_peel(cells, base, size[left])[3]]
        size[left] = sizes(size[left] / 0.42 * 1.2)
    (key, count, check), base = _fill(np.repeat(np.arange(len(n)), n), keys, np.ones(len(keys), np.int16), size)
    return Sketches(size, base, key, count, check, offsets, keys)


def differences(x: Sketches, a: np.ndarray, y: Sketches, b: np.ndarray) -> np.ndarray:
    """For each pair of sketches (a[i] of x, b[i] of y) how many digests are on one side only, by subtracting and peeling.

    Cells of equal size subtract as they are. Sketches of unequal size, and those whose difference does not peel, are laid out
    again in longer rows from the digests that they give back.
    """
    out = np.zeros(len(a), np.int64)
    size = np.maximum(x.size[a], y.size[b])
    same = x.size[a] == y.size[b]
    left = np.flatnonzero(same)
    if len(left):
        i, j = (_stretches(s.base[k[left]], ROWS * size[left]) for s, k in ((x, a), (y, b)))
        cells = x.key[i] ^ y.key[j], x.count[i] - y.count[j], x.check[i] ^ y.check[j]
        table, _, _, empty = _peel(cells, np.cumsum(ROWS * size[left]) - ROWS * size[left], size[left])
        out[left] = np.bincount(table, minlength=len(left))
        size[left[~empty]] = sizes(size[left[~empty]] / 0.42 * 1.9)
        left = np.concatenate([left[~empty], np.flatnonzero(~same)])
    else:
        left = np.arange(len(a))
    n, m = np.diff(x.offsets)[a], np.diff(y.offsets)[b]
    while len(left):
        i, j = _stretches(x.offsets[:-1][a[left]], n[left]), _stretches(y.offsets[:-1][b[left]], m[left])
        owner = np.concatenate([np.repeat(np.arange(len(left)), n[left]), np.repeat(np.arange(len(left)), m[left])])
        signs = np.concatenate([np.ones(len(i), np.int16), -np.ones(len(j), np.int16)])
        cells, base = _fill(owner, np.concatenate([x.keys[i], y.keys[j]]), signs, size[left])
        table, _, _, empty = _peel(cells, base, size[left])
        out[left] = np.bincount(table, minlength=len(left))
        left = left[~empty]
        size[left] = sizes(size[left] / 0.42 * 1.9)
    return out


def likeness(x: Sketches, a: np.ndarray, y: Sketches, b: np.ndarray) -> np.ndarray:
    """Shared digests over all digests of each pair; 1 for two texts without paragraphs."""
    apart = differences(x, a, y, b)
    total = np.diff(x.offsets)[a] + np.diff(y.offsets)[b]
    return np.where(total > 0, (total - apart) / np.maximum(1, total + apart), 1.0)


def load(fingerprint: str) -> Sketches:
    """The sketch of a fingerprint, with the digests that it gives back."""
    data = base64.b64decode(fingerprint)
    _, size, n = _HEAD.unpack_from(data)
    cells = np.frombuffer(data, _CELL, ROWS * size, _HEAD.size)
    key, count, check = (np.ascontiguousarray(cells[c]) for c in ("key", "count", "check"))
    _, keys, _, empty = _peel((key.copy(), count.copy(), check.copy()), np.zeros(1, np.int64), np.array([size]))
    if not empty[0] or len(keys) != n:
        raise ValueError("not a whole fingerprint")
    return Sketches(np.array([size]), np.zeros(1, np.int64), key, count, check, np.array([0, n]), keys)


def compare(a: str, b: str) -> float:
    """Likeness of two fingerprints, from nothing but them."""
    return float(likeness(load(a), np.zeros(1, int), load(b), np.zeros(1, int))[0])


def fingerprints_of(s: Sketches) -> list[str]:
    return [base64.b64encode(s.bytes_of(i)).decode() for i in range(len(s.size))]


def fingerprint(text: str | None) -> str:
    """The fingerprint of one text; a null text is empty."""
    return fingerprints_of(sketches(*digests([(text or "").encode()])))[0]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _bucket(bounds: list[int]) -> "F.Column":
    """How many of the descending bounds lie above doc_id: found in two short lists, not one long one; null ids come last."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    coarse = bounds[step - 1 :: step]
    key = F.col("doc_id")
    above = lambda xs: F.size(F.filter(xs, lambda x: x > key))
    lit = F.array(*map(F.lit, bounds))
    first = above(F.array(*map(F.lit, coarse))) if coarse else F.lit(0)
    fine = above(F.slice(lit, first * step + 1, F.lit(step)))
    return F.when(key.isNull(), F.lit(len(bounds))).otherwise((first * step + fine).cast("int"))


def edited_versions(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited version, whose last third comes from the next document's start.

    The next document has the next smaller doc_id; after the last comes the first. Rows with equal ids follow each other
    by text, null ids come last, null texts are empty, a single document follows itself, and an empty table gives no row. Texts of
    any length are taken whole; extra columns are ignored.
    Texts move once, to ranges of ids; each range borrows the first row of the one that follows it.
    """
    spark = docs.sparkSession
    rows = columns(docs, "doc_id", "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n).alias("q")).first()["q"] if n > 1 else []
    bounds = sorted(set(cuts or []), reverse=True)
    dealt = rows.withColumn("block", _bucket([int(x) for x in bounds]).cast("int"))
    heads = {r["block"]: r["head"] for r in dealt.groupBy("block").agg(F.max("doc_id").alias("head")).collect()}  # a row for a range
    order = sorted(heads)
    follows = {b: order[i - 1] for i, b in enumerate(order)}  # the range before, whose last row the head follows
    small = spark.createDataFrame([(heads[b], b, follows[b]) for b in order], "head long, block int, before int")
    first = dealt.join(F.broadcast(small), "block").where(F.col("doc_id").eqNullSafe(F.col("head")))
    first = first.groupBy("before", "head").agg(F.min(F.struct(F.col("text").isNotNull().alias("known"), "text")).alias("t"))
    borrowed = first.select(F.col("head").alias("doc_id"), F.col("t.text").alias("text"), F.col("before").alias("block"), F.lit(1).alias("borrowed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int | None, str] | None = None  # a row that still waits for the next one

        def emit(rows: list[tuple[int | None, str]]) -> pa.RecordBatch:
            texts = [t for _, t in rows]
            m = len(rows) - 1
            edited = [(t[: len(t) - len(t) // 3] + after[: len(t) // 3]).encode() for t, after in zip(texts, texts[1:])]
            own, new = sketches(*digests([t.encode() for t in texts])), sketches(*digests(edited))
            each = np.arange(m)
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows[:m]], pa.int64()), pa.array([len(t) for t in texts[:m]], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()), pa.array(fingerprints_of(own)[:m], pa.string()), pa.array(fingerprints_of(new), pa.string()), pa.array(likeness(own, each, new, each)), pa.array(likeness(own, each, own, each + 1))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

        done = False
        for b in slices(batches, "text", 2 << 20):  # sketches and their digests are several times the text
            if done:
                continue
            rows = [held] if held else []
            for key, text, lent in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("borrowed").to_pylist()):
                rows.append((key, text or ""))
                if lent:
                    done = True
                    break
            if len(rows) > 1:
                yield emit(rows)
            held = rows[-1]

    parts = [dealt.select("doc_id", "text", "block", F.lit(0).alias("borrowed")), borrowed]
    return arrow_map(by_block(parts, len(bounds) + 1, ["borrowed", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()]), run, SCHEMA)
