"""Plumbing of passes over blocks: sorted runs of numbers in blobs, and streams of groups."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import NULL_ID, arrow_map, block_of, slices

#: Rows of a mixed pass: small ones (kind below DOC, a, b, data) come before the packs of documents of their block.
MIXED = "block int, kind int, a long, b long, data binary"
DOC = 9
_MIXED = pa.schema([("block", pa.int32()), ("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("data", pa.binary())])
#: Bytes of text that a task deals out at once.
DEALT = 8 << 20


def packs_of(docs: DataFrame, n: int, carry: list[str] | None = None) -> DataFrame:
    """The documents as packs of a mixed pass: what a slice of the input has for a block, compressed.

    The columns ``carry`` go along as they are, as c0, c1, ... of a struct ``row``.
    """
    rows = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").cast("string").alias("text"), *([F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carry))).alias("row")] if carry else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in slices(batches, "text", DEALT):
            block = b.column("block").to_numpy()
            order = np.argsort(block, kind="stable")
            at = np.flatnonzero(np.concatenate([[True], np.diff(block[order]) != 0]))
            rest = b.select([c for c in b.schema.names if c != "block"])
            out = [squeeze.compress(rest.take(pa.array(part)).serialize()) for part in np.split(order, at[1:])]
            for i in range(0, len(out), 64):
                part = pa.array(out[i : i + 64], pa.binary())
                zero = pa.array(np.zeros(len(part), np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(block[order][at[i : i + 64]], pa.int32()), pa.array(np.full(len(part), DOC, np.int32)), zero, zero, part], schema=_MIXED)

    return arrow_map(rows.select(block_of(n, "doc_id", "text").alias("block"), "*"), run, MIXED)


def pack_schema(docs: DataFrame, carry: list[str] | None = None) -> pa.Schema:
    """The Arrow schema of the documents in a pack."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = StructType([StructField("doc_id", LongType()), StructField("text", StringType())])
    if carry:
        kinds.add("row", StructType([StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(carry)]))
    return to_arrow_schema(kinds)


def unpacked(packs: Iterable[bytes], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The documents of a block in order of doc_id and text, nulls first, a few MB at a time."""
    table = pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(zstandard.decompress(p)), schema) for p in packs], schema=schema)
    table = table.set_column(1, "text", pc.cast(table.column("text"), pa.large_string()))
    order = pc.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start")
    i, sizes = 0, np.cumsum(pc.fill_null(pc.binary_length(table.column("text")), 0).to_numpy()[order.to_numpy()])
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(sizes, (sizes[i - 1] if i else 0) + (4 << 20))))
        yield from table.take(order.slice(i, j - i)).combine_chunks().to_batches()
        i = j


def squeezed(data: bytes) -> bytes:
    return zstandard.compress(data, 1)


def small_rows(df: DataFrame, kind: int) -> DataFrame:
    """Rows (block, a, b, data) as rows of a mixed pass."""
    return df.select("block", F.lit(kind).alias("kind"), "a", "b", "data")


def mixed_order() -> list:
    return ["kind", "a", "b"]


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows that agree in their first ``keys`` columns."""
    return itertools.groupby(rows_of(batches), key=lambda r: r[:keys])


def pack_sorted(x: np.ndarray) -> bytes:
    """An ascending run of integers as differences of the least width that holds them."""
    d = np.diff(x.astype(np.int64), prepend=0)
    for code, kind in ((b"1", "<u1"), (b"2", "<u2"), (b"4", "<u4")):
        if not len(d) or int(d.max()) <= np.iinfo(kind).max:
            return code + d.astype(kind).tobytes()
    return b"8" + d.astype("<i8").tobytes()


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, {b"1": "<u1", b"2": "<u2", b"4": "<u4", b"8": "<i8"}[data[:1]], offset=1), dtype=np.int64)


def distinct(x: np.ndarray) -> np.ndarray:
    """Distinct values in ascending order, by sorting."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x


def ranked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order, and the place of each value among them."""
    order = np.argsort(x)
    y = x[order]
    new = np.concatenate([[True], y[1:] != y[:-1]]) if len(y) else np.zeros(0, bool)
    place = np.empty(len(x), np.int64)
    place[order] = np.cumsum(new) - 1
    return y[new], place


def doc_key(doc_id: int | None) -> int:
    return NULL_ID if doc_id is None else doc_id


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and one past the last place of each run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def rolling(values: np.ndarray, window: int, base: int, powers: dict[tuple[int, str], np.ndarray]) -> np.ndarray:
    """Polynomial hash modulo 2**64 of every ``window`` values of one long run, by prefix sums; ``base`` is odd."""
    n = len(values)
    if n < window:
        return np.zeros(0, np.uint64)
    if len(powers.get((base, "up"), ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for key, b in (((base, "up"), base), ((base, "down"), pow(base, -1, 1 << 64))):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            powers[key] = np.cumprod(p)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[base, "up"][:n])])
    return (sums[window:] - sums[: n - window + 1]) * powers[base, "down"][: n - window + 1]
