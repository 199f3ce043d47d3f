"""Substring dedup of word windows behind a count-min prefilter.

Three passes over blocks of documents:

1. Each block hashes its windows and sends its part of a count-min sketch: for each of two rows the cells that its windows
   fall into. The sketch lives in shards (ranges of cells), where the blocks' parts are summed. A cell's count never falls
   below the number of blocks that hold a window, so a window with a count of one in either row is in one block only.
   Each block gets one bit back for each cell it sent: shared or not.
2. Blocks hash their windows again. What repeats within a block is settled there; of the windows that both rows estimate to
   be shared, one entry for each distinct one (128-bit hash, least doc_id) goes to a shard, which finds the least doc_id of all
   and answers with a bit. Copies in one block thus count once, and a hot passage sends a row a block at most.
3. Blocks read the answers beside the texts and remove the covered words.

Nothing is estimated in the result: the sketch only spares windows that cannot repeat elsewhere. Cells grow with the number
of blocks, as do shards, so a task's share stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame

from .common import Staged, arrow_map, block_count, by_block
from .passes import DOC, distinct, doc_key, groups, mixed_order, pack_schema, pack_sorted, packs_of, rolling, runs, small_rows, squeezed, unpack_sorted, unpacked
from .perplexity import _words

#: Words of a window, and cells of a sketch row for each block of documents (twice the windows a block is expected to have).
WINDOW, CELLS_PER_BLOCK = 20, 1 << 23
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_BLOB = "block int, a long, b long, data binary"
_BLOB_SCHEMA = pa.schema([("block", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("data", pa.binary())])
_powers: dict = {}


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, _BLOB_SCHEMA)], schema=_BLOB_SCHEMA)


class _Block:
    """The window hashes of the documents of a block, with the document (its place in the block) and start of each."""

    def __init__(self, window: int):
        self.window, self.keys = window, []
        self.h: tuple[list, list] = ([], [])
        self.doc: list = []
        self.start: list = []

    def add(self, doc_ids: list, texts: pa.Array) -> None:
        import xxhash

        offsets, index, distinct = _words(texts)
        word = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in distinct]), ">u8").astype(np.uint64).reshape(-1, 2)
        place = np.repeat(np.arange(len(doc_ids)), np.diff(offsets))
        n = len(index) - self.window + 1
        if n > 0:
            whole = place[:n] == place[self.window - 1 :]  # windows inside one document
            for k in range(2):
                self.h[k].append(rolling(word[index, k], self.window, _BASES[k], _powers)[whole])
            self.doc.append((place[:n][whole] + len(self.keys)).astype(np.int32))
            self.start.append((np.arange(n) - offsets[place[:n]])[whole].astype(np.int32))
        self.keys += [doc_key(x) for x in doc_ids]

    def arrays(self) -> tuple[np.ndarray, ...]:
        kinds = (np.uint64, np.uint64, np.int32, np.int32)
        return tuple(np.concatenate(x) if x else np.zeros(0, t) for x, t in zip((*self.h, self.doc, self.start), kinds))


def _cells(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def removals(docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, int]:
    """Staged rows (block, a, b, data) of what to remove, and the number of blocks; see dedup_windows()."""
    n = block_count(docs)
    bits = max(10, (n * CELLS_PER_BLOCK - 1).bit_length())
    width = -(-(1 << bits) // n)  # cells in a shard
    texts, layout = packs_of(docs, n), pack_schema(docs)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (block,), rows in groups(batches, 1):
            parts: tuple[list, list] = ([], [])
            for d in unpacked((r[4] for r in rows), layout):
                held = _Block(window)
                held.add(d.column("doc_id").to_pylist(), d.column("text"))
                for k, h in enumerate(held.arrays()[:2]):
                    parts[k].append(_cells(h, bits))
            for k in range(2):
                cells = distinct(np.concatenate(parts[k])) if parts[k] else np.zeros(0, np.int64)
                at = np.searchsorted(cells, np.arange(n + 1, dtype=np.int64) * width)
                out = [(s, k, block, pack_sorted(cells[at[s] : at[s + 1]] - s * width)) for s in np.flatnonzero(np.diff(at)).tolist()]
                for i in range(0, len(out), 64):
                    yield _blobs(out[i : i + 64])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard, k), rows in groups(batches, 2):
            parts = [(r[2], r[3]) for r in rows]
            counts = np.zeros(width, np.uint8)
            for _, data in parts:
                cells = unpack_sorted(data)
                counts[cells] = np.minimum(counts[cells], 1) + 1
            out = [(block, k, shard, np.packbits(counts[unpack_sorted(data)] > 1).tobytes()) for block, data in parts]
            for i in range(0, len(out), 256):
                yield _blobs(out[i : i + 256])

    sent = arrow_map(by_block([texts], n, mixed_order()), sketch, _BLOB)
    shared = Staged(arrow_map(by_block([sent], n, ["a", "b"]), merge, _BLOB), "sketch")

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Kind by a: below n a shard's entries (b: block); n: what is settled in the block, with a place for each entry."""
        for (block,), rows in groups(batches, 1):
            answers: tuple[list, list] = ([], [])
            held = _Block(window)

            def documents():
                for r in rows:
                    if r[1] == DOC:
                        yield r[4]
                    else:
                        answers[r[2]].append((r[3], r[4]))

            for d in unpacked(documents(), layout):
                held.add(d.column("doc_id").to_pylist(), d.column("text"))
            h1, h2, doc, start = held.arrays()
            order = np.argsort(h1, kind="stable")
            a = h1[order]

            def flagged(known: np.ndarray, k: int) -> np.ndarray:
                """Whether a sketch row has the cells (distinct, ascending) as shared."""
                at = np.searchsorted(known, np.arange(n + 1, dtype=np.int64) * width)
                flags = np.zeros(len(known), bool)
                for shard, data in answers[k]:
                    size = at[shard + 1] - at[shard]
                    flags[at[shard] : at[shard + 1]] = np.unpackbits(np.frombuffer(data, np.uint8), count=size).view(bool)
                return flags

            # most windows are alone in the block and in the first sketch row: the rest is looked at closely
            alone = np.ones(len(a), bool)
            same = a[1:] == a[:-1]
            alone[1:] &= ~same
            alone[:-1] &= ~same
            cell = _cells(a, bits)
            new = np.concatenate([[True], cell[1:] != cell[:-1]]) if len(a) else np.zeros(0, bool)
            shared0 = flagged(cell[new], 0)[np.cumsum(new) - 1] if len(a) else alone
            pick = np.flatnonzero(~alone | shared0)
            order, a, go0 = order[pick], a[pick], shared0[pick]
            b = h2[order]
            if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
                again = np.lexsort((np.arange(len(a)), b, a))
                order, a, b, go0 = order[again], a[again], b[again], go0[again]
            doc, start = doc[order], start[order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
            group = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            keys = np.array(held.keys, np.int64)[doc]
            least = np.minimum.reduceat(keys, first) if len(first) else np.zeros(0, np.int64)
            # within the block: a smaller doc_id has it, or the same row earlier (rows of a group are in order of row and start)
            again = np.concatenate([[False], (doc[1:] == doc[:-1]) & ~new[1:]]) if len(a) else np.zeros(0, bool)
            here = again | (keys > least[group]) if len(a) else np.zeros(0, bool)
            known = distinct(_cells(h2, bits))
            go = go0[first]
            if go.any():
                shared1 = known[flagged(known, 1)]
                cell = _cells(b[first][go], bits)
                at = np.minimum(np.searchsorted(shared1, cell), max(0, len(shared1) - 1))
                go[go] = shared1[at] == cell if len(shared1) else False
            e1, e2, e_doc = a[first][go], b[first][go], least[go]
            at = np.searchsorted(((e1 >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32), np.arange(n + 1, dtype=np.uint64))
            for s in np.flatnonzero(np.diff(at)).tolist():
                i, j = at[s], at[s + 1]
                yield _blobs([(s, 0, block, e1[i:j].tobytes() + e2[i:j].tobytes() + e_doc[i:j].tobytes())])
            number = np.cumsum(go) - 1  # of the entry
            wait = ~here & go[group] if len(a) else here
            yield _blobs([(block, 1, 0, _settled(doc[here], start[here], np.full(int(here.sum()), -1))), (block, 2, 0, _settled(doc[wait], start[wait], number[group[wait]]))])

    def _settled(doc: np.ndarray, start: np.ndarray, entry: np.ndarray) -> bytes:
        order = np.lexsort((start, doc))
        return squeezed(np.stack([doc[order], start[order], entry[order]]).astype("<i4").tobytes())

    mixed = by_block([texts, small_rows(shared.df, 0)], n, mixed_order())
    found = Staged(arrow_map(mixed, entries, _BLOB), "windows")
    shared.drop()

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A bit for each entry: some block has the window in a smaller doc_id."""
        for (shard,), rows in groups(batches, 1):
            parts = [(r[2], np.frombuffer(r[3], "<u8").reshape(3, -1)) for r in rows]
            h1, h2, key = (np.concatenate([p[i] for _, p in parts]) for i in range(3))
            key = key.view(np.int64)
            order = np.lexsort((h2, h1))
            a, b = h1[order], h2[order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            least = np.minimum.reduceat(key[order], np.flatnonzero(new))
            later = np.zeros(len(key), bool)
            later[order] = key[order] > least[np.cumsum(new) - 1]
            ends = np.cumsum([p.shape[1] for _, p in parts])
            for (block, p), e in zip(parts, ends.tolist()):
                yield _blobs([(block, 3, shard, np.packbits(later[e - p.shape[1] : e]).tobytes() + np.uint32(p.shape[1]).tobytes())])

    answers = Staged(arrow_map(by_block([found.df.where("a = 0")], n, ["b"]), exact, _BLOB), "answers")
    rows = found.df.where("a > 0").unionByName(answers.df)
    return small_rows(rows, 0), n


def dedup_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document doc_id, n_words, spans (word ranges removed: start, end), n_removed, and kept (remaining words, one space between).

    A word goes if a window over it has a word sequence that also starts earlier: in a smaller doc_id, or before it in the same
    row; windows are judged on the input. Rows with equal doc_ids are documents of their own, neither earlier than the other; a
    null doc_id counts as smaller than any other; null texts have no words. Texts shorter than a window keep all; a text of any
    length is taken whole. Extra columns are ignored; an empty table gives no row.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    small, n = removals(docs, window)

    layout = pack_schema(docs)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_,), rows in groups(batches, 1):
            settled = {1: np.zeros((3, 0), np.int32), 2: np.zeros((3, 0), np.int32)}
            bits: list = []

            def documents():
                for r in rows:
                    if r[1] == DOC:
                        yield r[4]
                    elif r[2] == 3:
                        count = int(np.frombuffer(r[4][-4:], "<u4")[0])
                        bits.append(np.unpackbits(np.frombuffer(r[4][:-4], np.uint8), count=count).view(bool))
                    else:
                        settled[r[2]] = np.frombuffer(zstandard.decompress(r[4]), "<i4").reshape(3, -1)

            gone: dict[int, np.ndarray] | None = None
            place = 0
            for d in unpacked(documents(), layout):
                if gone is None:  # entries are numbered in order of their hash, as shards are
                    later = np.concatenate(bits) if bits else np.zeros(0, bool)
                    all_ = np.concatenate([settled[1][:2], settled[2][:2, later[settled[2][2]]]], axis=1)
                    all_ = all_[:, np.argsort(all_[0], kind="stable")]
                    docs_, at = np.unique(all_[0], return_index=True)
                    gone = dict(zip(docs_.tolist(), np.split(all_[1], at[1:]))) if len(docs_) else {}
                out: list[list] = [[], [], [], []]
                for text in pc.cast(d.column("text"), pa.large_binary()).to_pylist():
                    words = (text or b"").split()
                    starts = gone.get(place)
                    place += 1
                    spans: list[dict] = []
                    kept = words
                    if starts is not None:
                        cover = np.zeros(len(words) + 1, np.int32)
                        np.add.at(cover, starts, 1)
                        np.add.at(cover, starts + window, -1)
                        covered = np.cumsum(cover[:-1]) > 0
                        spans = [{"start": s, "end": e} for s, e in zip(*(x.tolist() for x in runs(covered)))]
                        kept = [w for w, c in zip(words, covered.tolist()) if not c]
                    for column, value in zip(out, (len(words), spans, len(words) - len(kept), b" ".join(kept).decode())):
                        column.append(value)
                yield _kept(d.column("doc_id"), out)

    schema = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, n_removed long, kept string"
    return arrow_map(by_block([packs_of(docs, n), small], n, mixed_order()), remove, schema)


def _kept(doc_ids: pa.Array, out: list[list]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kinds = (pa.int64(), span, pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([doc_ids, *(pa.array(c, t) for c, t in zip(out, kinds))], names=["doc_id", "n_words", "spans", "n_removed", "kept"])
