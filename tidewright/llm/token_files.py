"""Token-ID files by fixed-width bit packing.

A file set is a table of *segments* in ascending document order; a segment holds whole documents and is
self-contained: ``payload`` is a header (magic, bits for an id, ids in a block, ids, blocks), the byte
offset of each block, and the blocks, in which every id takes exactly the bits that the vocabulary needs.
A reader unpacks any block alone, from its offset. Spark's writer commits segments, so a lost executor
costs a retry of its tasks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Staged, arrow_map, columns, slices
from .tokens import LibraryEncoder

MAGIC = b"TWP1"
HEAD = struct.Struct("<4sBIQQ")
#: Ids in a block, and ids after which a segment ends at the next document.
BLOCK_IDS, SEGMENT_IDS = 4096, 1 << 16

SEGMENT = "shard int, seg int, seg_start long, doc_ids array<long>, lengths array<long>, payload binary"


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids at ``bits`` each, least significant bit first, in whole bytes."""
    ids = np.ascontiguousarray(ids, "<u4")
    if bits % 8 == 0:
        return ids.view(np.uint8).reshape(-1, 4)[:, : bits // 8].tobytes()
    return np.packbits(np.unpackbits(ids.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack_ids(data: bytes, n: int, bits: int) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    if bits % 8 == 0:
        out[:, : bits // 8] = np.frombuffer(data, np.uint8, n * bits // 8).reshape(n, -1)
    else:
        wide = np.zeros((n, 32), np.uint8)
        wide[:, :bits] = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * bits).reshape(n, bits)
        out = np.packbits(wide, axis=1, bitorder="little")
    return out.reshape(-1).view("<u4")


def pack_segment(ids: np.ndarray, bits: int, block: int = BLOCK_IDS) -> bytes:
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    blocks = [pack_ids(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, blocks)], dtype="<u8")
    return HEAD.pack(MAGIC, bits, block, len(ids), len(blocks)) + offsets.tobytes() + b"".join(blocks)


def unpack_segment(payload: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """ids[start:stop] of a segment; only the blocks that hold them are touched."""
    magic, bits, block, n, blocks = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a segment of packed ids")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, "<u4")
    offsets, base = np.frombuffer(payload, "<u8", blocks + 1, HEAD.size), HEAD.size + 8 * (blocks + 1)
    first, last = start // block, (stop - 1) // block
    if bits % 8 == 0 or block * bits % 8 == 0:  # blocks adjoin without slack: one vectorised run
        got = unpack_ids(payload[base + int(offsets[first]) : base + int(offsets[last + 1])], min(n, (last + 1) * block) - first * block, bits)
    else:
        got = np.concatenate([unpack_ids(payload[base + int(offsets[b]) : base + int(offsets[b + 1])], min(block, n - b * block), bits) for b in range(first, last + 1)])
    return got[start - first * block : stop - first * block]


def write_token_files(docs: DataFrame, spec: str, vocabulary: int, end_id: int, bits: int | None = None) -> Staged:
    """Encode texts, append ``end_id`` to each, and write segments in ascending doc_id order.

    One range shuffle of the texts orders the documents; encoding follows it, so nothing else moves. Null texts
    are empty; null doc_ids come first; rows with equal doc_ids are all written, ordered by text; an empty table
    gives no segment; a very long text makes a segment of its own.
    """
    bits = bits or bits_for(vocabulary)
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(spec)  # a tokenizer file has a fixed size

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, seg, start = LibraryEncoder.of(shared.value), TaskContext.get().partitionId(), 0, 0
        keys: list[pa.Array] = []  # of the segment that is being filled: documents, their lengths, ids
        lengths: list[np.ndarray] = []
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal seg, start, size
            doc_ids, n, ids = pa.concat_arrays(keys), np.concatenate(lengths), np.concatenate(held)
            whole = [pa.array([0, len(n)], pa.int32())]
            row = pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([seg], pa.int32()), pa.array([start], pa.int64()), pa.ListArray.from_arrays(*whole, doc_ids), pa.ListArray.from_arrays(*whole, pa.array(n, pa.int64())), pa.array([pack_segment(ids, bits)], pa.binary())],
                schema=_SEGMENT,
            )
            seg, start, size = seg + 1, start + len(ids), 0
            for part in (keys, lengths, held):
                part.clear()
            return row

        for b in slices(batches, "text"):
            offsets, ids = encoder.ids(b.column("text"), end_id)
            i, n = 0, b.num_rows
            while i < n:  # whole documents until the segment is full
                j = min(n, int(np.searchsorted(offsets, offsets[i] + SEGMENT_IDS - size)))
                keys.append(b.column("doc_id").slice(i, j - i))
                lengths.append(np.diff(offsets[i : j + 1]))
                held.append(ids[offsets[i] : offsets[j]])
                size += int(offsets[j] - offsets[i])
                if size >= SEGMENT_IDS:
                    yield flush()
                i = j
        if size:
            yield flush()

    ordered = columns(docs, "doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    return Staged(arrow_map(ordered, segments, SEGMENT), "token-files")


_SEGMENT = pa.schema([("shard", pa.int32()), ("seg", pa.int32()), ("seg_start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())])


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document of the written segments: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    Each row that was written comes back as one, null and repeated doc_ids too. A segment is unpacked at a time, and a very long text
    is a segment of its own; no segment gives no row.
    """

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                lengths = b.column("lengths")[i].values
                n = lengths.to_numpy()
                ids = unpack_segment(b.column("payload")[i].as_buffer())
                ends = np.cumsum(n, dtype=np.int64)
                starts = ends - n
                view = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
                crc = [zlib.crc32(view[s:e]) for s, e in zip((4 * starts).tolist(), (4 * ends).tolist())]
                yield pa.RecordBatch.from_arrays([b.column("doc_ids")[i].values, pa.array(starts + b.column("seg_start")[i].as_py() + b.column("base")[i].as_py()), lengths, pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spark = files.sparkSession
    # one row for a written shard: as many as there were range partitions
    totals = files.groupBy("shard").agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("ids"))
    base = totals.select("shard", F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    joined = files.join(F.broadcast(base), "shard")
    return joined.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")
