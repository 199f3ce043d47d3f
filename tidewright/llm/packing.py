"""Packing of tokenised documents into fixed windows by non-negative least squares.

Whole windows of a document are sequences by themselves. What is left of each document is counted in a histogram of
lengths in units, a 32nd of the window. Shallow combinations of up to DEPTH lengths that fill a window are enumerated,
their repeat counts are solved against the histogram under x >= 0 and rounded, and each combination is filled with
documents as often. A solution has no more combinations than the histogram has lengths, so rounding leaves little.
What no combination took is packed greedily, longest first: it fills the part of a unit that each sequence has left, then
windows of its own, and is cut where a window is full, so only the last window of a batch can be short; it is cut into
sequences whose lengths are powers of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import arrow_map, columns, slices
from .tokens import LibraryEncoder

#: Tokens that a task holds and packs at once.
BATCH_TOKENS = 1 << 22
#: Units in a window, and lengths in a combination.
UNITS, DEPTH = 32, 4

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

Piece = tuple[int, int, int]  # document, start in it, tokens


def combinations(have: list[int], total: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Every choice of at most ``depth`` of the ascending lengths ``have``, repeats allowed, whose sum is ``total``."""
    if depth == 0 or not total:
        return [()] if not total else []
    return [(a, *rest) for i, a in enumerate(have) if a <= total for rest in combinations(have[i:], total - a, depth - 1)]


def solve_counts(a: np.ndarray, h: np.ndarray) -> np.ndarray:
    """x >= 0 with the least |a x - h|, by active sets: columns enter by their gradient, and leave where they would fall below 0."""
    x = np.zeros(a.shape[1])
    active = np.zeros(len(x), bool)
    for _ in range(3 * len(x)):
        slope = a.T @ (h - a @ x)
        slope[active] = -np.inf
        if not (slope > 1e-7 * max(1.0, float(np.abs(h).max(initial=0)))).any():
            break
        active[int(slope.argmax())] = True
        while active.any():
            best = np.zeros(len(x))
            best[active] = np.linalg.lstsq(a[:, active], h, rcond=None)[0]
            low = active & (best <= 1e-9)
            if not low.any():
                x = best
                break
            step = float((x[low] / np.maximum(x[low] - best[low], 1e-300)).min())
            x = np.maximum(0.0, x + min(1.0, max(0.0, step)) * (best - x))
            active &= x > 1e-9
    return x


def placed(lengths: list[int], window: int) -> tuple[list[list[Piece]], list[Piece]]:
    """(sequences that solved combinations make, pieces that none took); each is at most a window, and holds remainders whole."""
    unit = max(1, window // UNITS)
    total = window // unit
    waiting: list[list[Piece]] = [[] for _ in range(total + 2)]
    for i, n in enumerate(lengths):
        left = n % window
        if left:
            waiting[min(total + 1, -(-left // unit))].append((i, n - left, left))
    rest = waiting.pop()  # longer than the whole units of a window
    histogram = np.array([len(w) for w in waiting], float)
    rows = combinations([k for k in range(1, total + 1) if histogram[k]], total)
    sequences: list[list[Piece]] = []
    if rows:
        a = np.zeros((total + 1, len(rows)))
        for j, row in enumerate(rows):
            np.add.at(a[:, j], list(row), 1.0)
        counts = np.rint(solve_counts(a, histogram)).astype(int)
        for j in np.argsort(-counts, kind="stable").tolist():
            for _ in range(int(counts[j])):
                if any(len(waiting[k]) < rows[j].count(k) for k in rows[j]):
                    break  # rounding asked for more than there is
                sequences.append([waiting[k].pop() for k in rows[j]])
    return sequences, rest + [p for w in waiting for p in w]


def pack_lengths(lengths: list[int], window: int) -> list[list[Piece]]:
    """Sequences of pieces (document, start, length) that hold each token once; every sequence is full or a power of two long."""
    whole = [[(i, start, window)] for i, n in enumerate(lengths) for start in range(0, n - n % window, window)]
    sequences, rest = placed(lengths, window)
    room = [window - sum(p[2] for p in s) for s in sequences]
    need, there = sum(room), sum(p[2] for p in rest)
    while need > there:  # not enough to fill them all: the last ones are given up
        gone = sequences.pop()
        need -= room.pop()
        there += sum(p[2] for p in gone)
        rest += gone
    rest.sort(key=lambda p: p[2])  # longest at the end

    def take(size: int) -> list[Piece]:
        out: list[Piece] = []
        while size:
            i, start, n = rest.pop()
            k = min(n, size)
            out.append((i, start, k))
            size -= k
            if k < n:
                rest.append((i, start + k, n - k))
        return out

    for s, n in zip(sequences, room):
        s += take(n)
    left = there - need
    made = [take(window) for _ in range(left // window)]
    left %= window
    while left:  # the short end, in powers of two
        size = 1 << (left.bit_length() - 1)
        made.append(take(size))
        left -= size
    return whole + sequences + made


def pack_documents(docs: DataFrame, spec: str, end_id: int, window: int = 2048) -> DataFrame:
    """One row for each piece of each document: where it lies in the document and in its sequence, and the CRC of its ids.

    Each task packs its documents in batches of about BATCH_TOKENS, with a histogram of each, so memory is bounded, nothing is
    shuffled and a retried task repeats its own sequences; sequence ids are unique by task. A null or empty text has the end
    id only; a text of any length is cut into whole windows and what is left; rows with equal or null doc_ids are packed as
    documents of their own; extra columns are ignored; an empty table gives no row.
    """
    if window < 2:
        raise ValueError("a window holds two tokens at least")
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sequence = LibraryEncoder.of(shared.value), TaskContext.get().partitionId() << 32
        keys: list = []  # of the batch that is being filled: documents, their lengths, ids
        lengths: list[int] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence, size
            view = memoryview(np.ascontiguousarray(np.concatenate(held), "<u4")).cast("B")
            first = (4 * (np.cumsum(lengths) - lengths)).tolist()
            out: list[list] = [[], [], [], [], [], [], []]
            for pieces in pack_lengths(lengths, window):
                offset = 0
                for i, start, n in pieces:
                    at = first[i] + 4 * start
                    for column, value in zip(out, (keys[i], start, n, zlib.crc32(view[at : at + 4 * n]), lengths[i], sequence, offset)):
                        column.append(value)
                    offset += n
                sequence += 1
            size = 0
            for part in (keys, lengths, held):
                part.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for b in slices(batches, "text"):
            offsets, ids = encoder.ids(b.column("text"), end_id)
            keys += b.column("doc_id").to_pylist()
            lengths += np.diff(offsets).tolist()
            held.append(ids)
            size += len(ids)
            if size >= BATCH_TOKENS:
                yield flush()
        if size:
            yield flush()

    return arrow_map(columns(docs, "doc_id", "text"), run, SCHEMA)
