"""Suffix-array dedup of byte strings by bucket-pointer refinement.

Every string of LENGTH bytes holds an anchor: the least hash among its q-grams of ANCHOR bytes. Equal strings have equal
anchors, so consecutive strings with one anchor travel as one run of bytes, and all that may be equal meet in one shard.

1. Blocks of documents send the cells of their anchors, with how many different runs each has; shards of cells sum them up and
   answer whether an anchor has more than one run anywhere, or so many (HOT) that its strings must be dealt out singly.
2. Blocks settle runs that are equal within the block (the smallest doc_id keeps them) and send one entry for each different
   run of a shared anchor. A shard sorts the suffixes of its entries to LENGTH bytes: initial q-gram buckets are refined by
   sorting on the bucket identifiers of later offsets, and the refined identifiers are used again for twice the depth. Suffixes
   that end in one bucket start with the same string; the least doc_id of a bucket goes back as a bit for every string.
3. Blocks read the bits beside the texts and remove the covered bytes.

Cells only spare anchors that cannot repeat; the result is exact up to 128-bit hashes of runs. Entries of a hot passage are one
a block for each different run, and a hot anchor with ever different runs is split by the strings themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from .common import Staged, arrow_map, block_count, by_block
from .passes import DOC, doc_key, groups, mixed_order, pack_schema, pack_sorted, packs_of, ranked, runs, small_rows, squeezed, unpack_sorted, unpacked
from .substrings import _BLOB, _blobs

LENGTH, ANCHOR = 50, 20
#: Cells for each block of documents, strings of a run at most, and different runs from which an anchor is split.
CELLS_PER_BLOCK, RUN, HOT = 1 << 25, 64, 4096
#: Suffixes that a shard sorts at once, and bytes that a block hashes at once.
SORTED, SLICE = 1 << 20, 1 << 19
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_LETTER = tuple(np.random.default_rng(s).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for s in (5, 6))
_powers: dict = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(k: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending powers of a base and of its inverse, modulo 2**64."""
    if len(_powers.get(k, ((),))[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        both = []
        for b in (_BASES[k], pow(_BASES[k], -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.cumprod(p))
        _powers[k] = tuple(both)
    return _powers[k]


class _Sums:
    """Hashes of any stretch of some bytes, by prefix sums."""

    def __init__(self, data: np.ndarray, k: int):
        self.k, n = k, len(data)
        up, _ = _power(k, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTER[k][data] * up[:n], out=self.sums[1:])

    def every(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * _power(self.k, len(self.sums))[1][:n]

    def stretch(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * _power(self.k, len(self.sums))[1][a] + (b - a).astype(np.uint64) * np.uint64(_BASES[1 - self.k])


def _least_of(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every n consecutive values, by doubling."""
    width = 1
    while 2 * width <= n:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[: len(h) - (n - width)], h[n - width :]) if width < n else h


class _Block:
    """Bytes of a block's documents, and its runs: document, place in it, place in the bytes, strings, anchor, hashes."""

    def __init__(self, length: int, anchor: int):
        self.length, self.anchor = length, anchor
        self.keys: list[int] = []
        self.bytes: list[np.ndarray] = []
        self.size = 0
        self.parts: list[tuple] = []

    def add(self, ids: list, texts: pa.Array) -> None:
        data = [t or b"" for t in pc.cast(texts, pa.large_binary()).to_pylist()]
        held: list[bytes] = []
        first, n = 0, 0
        for i, d in enumerate(data):
            held.append(d)
            n += len(d)
            if n >= SLICE or i == len(data) - 1:
                self._slice(held, len(self.keys) + first)
                first, held, n = i + 1, [], 0
        self.keys += [doc_key(x) for x in ids]

    def _slice(self, data: list[bytes], first: int) -> None:
        x = np.frombuffer(b"".join(data), np.uint8)
        base, self.size = self.size, self.size + len(x)
        self.bytes.append(x)
        n = len(x) - self.length + 1
        if n <= 0:
            return
        ends = np.cumsum([len(d) for d in data])
        sums = _Sums(x, 0)
        least = _least_of(_mix(sums.every(self.anchor)), self.length - self.anchor + 1)
        # strings inside one document
        inside = np.ones(n, bool)
        for e in ends[:-1].tolist():
            inside[max(0, e - self.length + 1) : e] = False
        start = np.ones(n, bool)
        start[1:] = (least[1:] != least[:-1]) | ~inside[:-1]
        start &= inside
        at = np.flatnonzero(start)
        if not len(at):
            return
        stop = np.minimum(np.concatenate([at[1:], [n]]), _next_false(inside, at))
        many = -(-(stop - at) // RUN)  # a long run in parts
        if (many > 1).any():
            part = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            at, stop = np.repeat(at, many) + part * RUN, np.repeat(stop, many)
            stop = np.minimum(stop, at + RUN)
        doc = np.searchsorted(ends, at, side="right")
        tail = stop + self.length - 1
        other = _Sums(x, 1)
        self.parts.append(((doc + first).astype(np.int32), (at - (ends - [len(d) for d in data])[doc]).astype(np.int32), at + base, (stop - at).astype(np.int16), _mix(least[at] + np.uint64(1)), sums.stretch(at, tail), other.stretch(at, tail)))

    def runs(self) -> tuple[np.ndarray, ...]:
        kinds = (np.int32, np.int32, np.int64, np.int16, np.uint64, np.uint64, np.uint64)
        return tuple(np.concatenate(p) for p in zip(*self.parts)) if self.parts else tuple(np.zeros(0, k) for k in kinds)


def _next_false(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    false = np.concatenate([np.flatnonzero(~mask), [len(mask)]])
    return false[np.searchsorted(false, at)]


def _cells(route: np.ndarray, bits: int) -> np.ndarray:
    return (route >> np.uint64(64 - bits)).astype(np.int64)


def _stretches(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... of ``size[i]`` numbers each, end to end."""
    size = size.astype(np.int64)
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def refine(data: np.ndarray, length: int) -> np.ndarray:
    """Bucket identifiers of the suffixes of ``data`` by their first ``length`` bytes (at least 8): equal if and only if these are.

    Identifiers start from 8-byte buckets. A step sorts the suffixes of buckets that are not single yet by (own bucket, bucket at
    a later offset), and what it found is used at double depth; suffixes too near the end get buckets of their own.
    """
    n = len(data)
    depth = min(8, length)
    padded = np.concatenate([data, np.zeros(depth, np.uint8)])
    key = np.zeros(n, np.uint64)
    for j in range(depth):
        key = (key << np.uint64(8)) | padded[j : j + n]
    bucket = ranked(key)[1]
    while depth < length:
        step = min(depth, length - depth)
        later = np.full(n, -1, np.int64)
        later[: n - step] = bucket[step:]
        count = np.bincount(bucket)
        active = np.flatnonzero(count[bucket] > 1)  # single buckets stay as they are
        pair = (bucket[active].astype(np.uint64) << np.uint64(32)) | (later[active] + 1).astype(np.uint64)
        found, inverse = ranked(pair)
        base = int(bucket.max()) + 1 if n else 0
        bucket = bucket.copy()
        bucket[active] = base + inverse
        bucket = ranked(bucket)[1] if base + len(found) > 1 << 31 else bucket
        depth += step
    return bucket


def _refined(route: np.ndarray, key: np.ndarray, size: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """For every string of entries in order of ``route`` whether it also starts in an entry of smaller key."""
    strings = size - length + 1
    first = np.cumsum(size) - size
    out_at = np.cumsum(strings) - strings
    out = np.zeros(int(strings.sum()), bool)
    edges = np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]])) if len(route) else np.zeros(0, np.int64)
    ends = np.concatenate([edges[1:], [len(route)]])
    total = np.concatenate([[0], np.cumsum(size)])
    i = 0
    while i < len(edges):  # whole anchors, some MB at a time
        j = max(i + 1, int(np.searchsorted(total[ends], total[edges[i]] + SORTED)))
        part = slice(int(edges[i]), int(ends[j - 1]))
        x = data[total[part.start] : total[part.stop]]
        bucket = refine(x, length)
        at = _stretches(first[part] - first[part.start], strings[part])
        owner = np.repeat(key[part], strings[part])
        least = np.full(int(bucket.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, bucket[at], owner)
        out[out_at[part.start] : out_at[part.start] + len(at)] = owner > least[bucket[at]]
        i = j
    return out


def repeated(route: np.ndarray, key: np.ndarray, size: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """For every string of the entries (in order) whether it also starts in an entry with a smaller key.

    Entries equal as a whole are one, that of the least key; the suffixes of what is left of an anchor are sorted if it has
    more than one.
    """
    size = size.astype(np.int64)
    strings, first = size - length + 1, np.cumsum(size) - size
    out = np.zeros(int(strings.sum()), bool)
    if not len(size):
        return out
    c1, c2 = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
    i = 0
    while i < len(size):  # whole entries, a slice of bytes at a time
        j = max(i + 1, int(np.searchsorted(first, first[i] + SLICE)))
        base, x = first[i], data[first[i] : first[j - 1] + size[j - 1]]
        for k, c in ((0, c1), (1, c2)):
            c[i:j] = _Sums(x, k).stretch(first[i:j] - base, first[i:j] - base + size[i:j])
        i = j
    order = np.lexsort((key, c2, c1, route))
    r, a, b = route[order], c1[order], c2[order]
    new = np.concatenate([[True], (r[1:] != r[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    content = np.empty(len(size), np.int64)
    content[order] = np.cumsum(new) - 1
    one = order[new]
    whole = key > key[one][content]
    mark = np.repeat(whole, strings)
    anchors = route[one]
    many = np.zeros(len(one), bool)
    many[1:] = anchors[1:] == anchors[:-1]
    many[:-1] |= anchors[1:] == anchors[:-1]
    sub = one[many]
    if len(sub):
        x = data[_stretches(first[sub], size[sub])]
        bits = _refined(route[sub], key[sub], size[sub], x, length)
        bit_at = np.zeros(len(one), np.int64)
        bit_at[many] = np.cumsum(strings[sub]) - strings[sub]
        ask = np.flatnonzero(~whole & many[content])
        at = np.cumsum(strings) - strings
        mark[_stretches(at[ask], strings[ask])] = bits[_stretches(bit_at[content[ask]], strings[ask])]
    return mark


def removals(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT) -> tuple[DataFrame, int]:
    """Rows (block, a, b, data) of what to remove, as part of a mixed pass, and the number of blocks."""
    n = block_count(docs)
    bits = max(10, (n * CELLS_PER_BLOCK - 1).bit_length())
    width = -(-(1 << bits) // n)
    texts, layout = packs_of(docs, n), pack_schema(docs)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block,), rows in groups(batches, 1):
            cells, kinds = [], []
            for d in unpacked((r[4] for r in rows), layout):
                held = _Block(length, anchor)
                held.add(d.column("doc_id").to_pylist(), d.column("text"))
                got = held.runs()
                cells.append(_cells(got[4], bits))
                kinds.append(got[5])
            if not cells:
                continue
            cell, kind = np.concatenate(cells), np.concatenate(kinds)
            order = np.lexsort((kind, cell))
            cell, kind = cell[order], kind[order]
            new = np.concatenate([[True], cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, bool)
            other = new | np.concatenate([[True], kind[1:] != kind[:-1]]) if len(cell) else new
            first = np.flatnonzero(new)
            count = np.minimum(255, np.add.reduceat(other.astype(np.int64), first)).astype(np.uint8) if len(first) else np.zeros(0, np.uint8)
            cell = cell[first]
            at = np.searchsorted(cell, np.arange(n + 1, dtype=np.int64) * width)
            out = [(s, len(cell[at[s] : at[s + 1]]), block, count[at[s] : at[s + 1]].tobytes() + pack_sorted(cell[at[s] : at[s + 1]] - s * width)) for s in np.flatnonzero(np.diff(at)).tolist()]
            for i in range(0, len(out), 64):
                yield _blobs(out[i : i + 64])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard,), rows in groups(batches, 1):
            parts = [(r[2], np.frombuffer(r[3], np.uint8, r[1]), r[3][r[1] :]) for r in rows]
            cells = [unpack_sorted(p[2]) for p in parts]
            _, inverse = ranked(np.concatenate(cells))
            total = np.bincount(inverse, weights=np.concatenate([p[1] for p in parts]))[inverse]
            at = 0
            for (block, count, _), c in zip(parts, cells):
                t = total[at : at + len(c)]
                at += len(c)
                yield _blobs([(block, 0, shard, np.packbits(t > 1).tobytes() + np.packbits(t >= hot).tobytes())])

    sent = arrow_map(by_block([texts], n, mixed_order()), sketch, _BLOB)
    shared = Staged(arrow_map(by_block([sent], n, ["b"]), merge, _BLOB), "anchors")

    def settled(doc: np.ndarray, start: np.ndarray, count: np.ndarray, entry: np.ndarray) -> bytes:
        return squeezed(np.stack([doc, start, count, entry]).astype("<i4").tobytes())

    def unlike(a: np.ndarray, b: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(group of each, one member of each group with the least key, least key of each group) by two hashes."""
        order = np.lexsort((keys, b, a))
        new = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])]) if len(a) else np.zeros(0, bool)
        group = np.zeros(len(a), np.int64)
        group[order] = np.cumsum(new) - 1
        one = order[np.flatnonzero(new)]
        return group, one, keys[one]

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block,), rows in groups(batches, 1):
            answers: list = []
            held = _Block(length, anchor)

            def documents():
                for r in rows:
                    if r[1] == DOC:
                        yield r[4]
                    else:
                        answers.append((r[3], r[4]))

            for d in unpacked(documents(), layout):
                held.add(d.column("doc_id").to_pylist(), d.column("text"))
            doc, start, place, count, route, c1, c2 = held.runs()
            held.parts.clear()
            data = np.concatenate(held.bytes) if held.bytes else np.zeros(0, np.uint8)
            held.bytes.clear()
            keys = np.array(held.keys, np.int64)[doc]
            cell = _cells(route, bits)
            known, own = ranked(cell)
            at = np.searchsorted(known, np.arange(n + 1, dtype=np.int64) * width)
            many, split = np.zeros(len(known), bool), np.zeros(len(known), bool)
            for shard, flags in answers:
                size = int(at[shard + 1] - at[shard])
                half = -(-size // 8)
                many[at[shard] : at[shard + 1]] = np.unpackbits(np.frombuffer(flags[:half], np.uint8), count=size).view(bool)
                split[at[shard] : at[shard + 1]] = np.unpackbits(np.frombuffer(flags[half:], np.uint8), count=size).view(bool)
            go, apart = many[own], split[own]
            sure: list[np.ndarray] = []
            wait: list[tuple] = []  # document, start, strings, entry's hashes ...
            made: list[tuple] = []  # route, key, size, place
            for hot_ones in (False, True):
                pick = np.flatnonzero(apart == hot_ones)
                if not len(pick):
                    continue
                d, s, p, k, r, h1, h2, key, g = (v[pick] for v in (doc, start, place, count, route, c1, c2, keys, go))
                if hot_ones:  # strings one by one
                    d, key, g = (np.repeat(v, k) for v in (d, key, g))
                    s, p = _stretches(s.astype(np.int64), k), _stretches(p, k)
                    h1, h2 = np.zeros(len(p), np.uint64), np.zeros(len(p), np.uint64)
                    for j in range(length):
                        x = data[p + j]
                        h1 = h1 * np.uint64(_BASES[0]) + _LETTER[0][x]
                        h2 = h2 * np.uint64(_BASES[1]) + _LETTER[1][x]
                    r, k = _mix(h1), np.ones(len(p), np.int16)
                group, one, least = unlike(h1, h2, key)
                later = key > least[group]
                sure.append(np.stack([d[later], s[later], k[later], np.full(int(later.sum()), -1)]))
                send = g[one]
                number = np.cumsum(send) - 1 + sum(len(m[0]) for m in made)
                w = ~later & send[group]
                wait.append((d[w], s[w], k[w], number[group[w]]))
                made.append((r[one][send], least[send], k[one][send].astype(np.int64) + length - 1, p[one][send]))
            if made:
                r, key, size, p = (np.concatenate(v) for v in zip(*made))
                order = np.argsort(r, kind="stable")
                rank = np.zeros(len(order), np.int64)
                rank[order] = np.arange(len(order))
                r, key, size, p = r[order], key[order], size[order], p[order]
                at = np.searchsorted(((r >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32), np.arange(n + 1, dtype=np.uint64))
                for s in np.flatnonzero(np.diff(at)).tolist():
                    i, j = at[s], at[s + 1]
                    yield _blobs([(s, 0, block, squeezed(np.uint32(j - i).tobytes() + r[i:j].tobytes() + key[i:j].tobytes() + size[i:j].astype("<u2").tobytes() + data[_stretches(p[i:j], size[i:j])].tobytes()))])
                d, s, k, e = (np.concatenate(v) for v in zip(*wait))
                yield _blobs([(block, 1, 0, settled(*np.concatenate(sure, axis=1))), (block, 2, 0, settled(d, s, k, rank[e])), (block, 3, 0, squeezed((size - length + 1).astype("<u2").tobytes()))])

    found = arrow_map(by_block([texts, small_rows(shared.df, 0)], n, mixed_order()), entries, _BLOB)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries of a shard become bits for their blocks; what else is dealt here goes through."""
        for (shard, kind), rows in groups(batches, 2):
            if kind:
                for r in rows:
                    yield _blobs([r])
                continue
            parts = []
            for r in rows:
                data = zstandard.decompress(r[3])
                m = int(np.frombuffer(data, "<u4", 1)[0])
                parts.append((r[2], np.frombuffer(data, "<u8", m, 4), np.frombuffer(data, "<i8", m, 4 + 8 * m), np.frombuffer(data, "<u2", m, 4 + 16 * m), np.frombuffer(data, np.uint8, offset=4 + 18 * m)))
            route, key, size, data = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3, 4))
            bits_ = repeated(route, key, size, data, length)
            at = 0
            for p in parts:
                m = int((p[3].astype(np.int64) - length + 1).sum())
                yield _blobs([(p[0], 4, shard, np.uint32(m).tobytes() + np.packbits(bits_[at : at + m]).tobytes())])
                at += m

    out = Staged(arrow_map(by_block([found], n, ["a", "b"]), exact, _BLOB), "runs")
    shared.drop()
    return small_rows(out.df, 0), n


def dedup_bytes(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT, carry: list[str] | None = None, whole: bool = False) -> DataFrame:
    """Per document doc_id, n_bytes, spans (byte ranges removed: start, end), n_removed, kept (remaining bytes), and ``row``: a
    struct of the columns ``carry``, as they are, under the names c0, c1, ...

    A byte goes if a string of ``length`` bytes over it also starts in a document with a smaller doc_id; overlaps count, and
    strings are judged on the input. Rows with equal doc_ids do not remove each other's bytes; a null doc_id counts as smaller than
    any other; null texts are empty; texts shorter than ``length`` keep all, and a text of any length is taken whole. Kept bytes may
    cut a character in two; with ``whole``, what is left of such a character goes from ``kept`` too. Columns that are not carried are
    ignored; an empty table gives no row.
    """
    if not 8 <= anchor <= length:
        raise ValueError("an anchor has 8 bytes at least, and no more than a string")
    small, n = removals(docs, length, anchor, hot)
    layout = pack_schema(docs, carry)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_,), rows in groups(batches, 1):
            known = {1: np.zeros((4, 0), np.int32), 2: np.zeros((4, 0), np.int32), 3: np.zeros(0, np.int64)}
            bits: list[np.ndarray] = []

            def documents():
                for r in rows:
                    if r[1] == DOC:
                        yield r[4]
                    elif r[2] == 4:
                        m = int(np.frombuffer(r[4], "<u4", 1)[0])
                        bits.append(np.unpackbits(np.frombuffer(r[4], np.uint8, offset=4), count=m).view(bool))
                    else:
                        data = zstandard.decompress(r[4])
                        known[r[2]] = np.frombuffer(data, "<u2").astype(np.int64) if r[2] == 3 else np.frombuffer(data, "<i4").reshape(4, -1)

            gone: dict[int, np.ndarray] | None = None
            place = 0
            for b in unpacked(documents(), layout):
                if gone is None:
                    sure, wait, strings = known[1], known[2], known[3]
                    later = np.concatenate(bits) if bits else np.zeros(0, bool)
                    of_entry = np.cumsum(strings) - strings
                    where = _stretches(of_entry[wait[3]], wait[2]) if wait.shape[1] else np.zeros(0, np.int64)
                    hit = later[where]
                    d = np.concatenate([np.repeat(sure[0], sure[2]), np.repeat(wait[0], wait[2])[hit]])
                    s = np.concatenate([_stretches(sure[1].astype(np.int64), sure[2]), _stretches(wait[1].astype(np.int64), wait[2])[hit]])
                    order = np.argsort(d, kind="stable")
                    names, at = np.unique(d[order], return_index=True)
                    gone = dict(zip(names.tolist(), np.split(s[order], at[1:]))) if len(names) else {}
                out: list[list] = [[], [], [], []]
                for text in pc.cast(b.column("text"), pa.large_binary()).to_pylist():
                    data = text or b""
                    starts = gone.get(place)
                    place += 1
                    spans: list[dict] = []
                    kept, left = data, len(data)
                    if starts is not None:
                        cover = np.zeros(len(data) + 1, np.int32)
                        np.add.at(cover, starts, 1)
                        np.add.at(cover, starts + length, -1)
                        covered = np.cumsum(cover[:-1]) > 0
                        spans = [{"start": a, "end": b} for a, b in zip(*(x.tolist() for x in runs(covered)))]
                        kept = np.frombuffer(data, np.uint8)[~covered].tobytes()
                        left = len(kept)
                        if whole:
                            kept = kept.decode("utf-8", "ignore").encode()
                    for column, value in zip(out, (len(data), spans, len(data) - left, kept)):
                        column.append(value)
                yield _kept(b, out)

    span = StructType([StructField("start", LongType()), StructField("end", LongType())])
    schema = StructType([StructField("doc_id", LongType()), StructField("n_bytes", LongType()), StructField("spans", ArrayType(span)), StructField("n_removed", LongType()), StructField("kept", BinaryType())])
    if carry:
        schema.add("row", StructType([StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carry)]))
    return arrow_map(by_block([packs_of(docs, n, carry), small], n, mixed_order()), remove, schema)


def _kept(b: pa.RecordBatch, out: list[list]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = (pa.int64(), span, pa.int64(), pa.binary())
    found = [b.column("doc_id"), *(pa.array(c, t) for c, t in zip(out, kinds))]
    row = [b.column("row")] if "row" in b.schema.names else []
    return pa.RecordBatch.from_arrays(found + row, names=["doc_id", "n_bytes", "spans", "n_removed", "kept", *["row"] * len(row)])
