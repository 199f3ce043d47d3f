"""BPE encoding and decoding with forced boundaries.

A byte pair that occurs inside no vocabulary token can never be joined, so the place between its bytes is
a certain cut: no merge crosses it, and the fragments on either side encode independently. White space
occurs inside no token of a word-level vocabulary, which gives the first cuts (chunks); within a word the
table of inner byte pairs gives the rest. Each distinct fragment is merged once and remembered.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import arrow_map, columns, cut
from .tokens import chunked

#: Entries that a worker keeps of each memo; a full one is emptied, which costs time only.
MEMO = 400_000

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from U+0100."""
    spare = iter(range(256, 512))
    return [chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else chr(next(spare)) for b in range(256)]


#: Ids of a fragment from which pairs are kept in a heap; the result is the same.
LONG = 64


class ForcedBoundaryBPE:
    """Encoder and decoder for a word-level byte BPE file: NFC, white space dropped, lower case, a mark at word ends."""

    _by_spec: dict[int, "ForcedBoundaryBPE"] = {}

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merge = {(self.vocab[a], self.vocab[b]): (rank, self.vocab[a + b]) for rank, (a, b) in reversed([*enumerate(pairs)])}
        self.letters = byte_letters()
        byte = {c: b for b, c in enumerate(self.letters)}
        self.inner = np.zeros((256, 256), bool)  # byte pairs that some token holds
        for token in self.vocab:
            b = [byte[c] for c in (token[: -len(self.end)] if token.endswith(self.end) else token) if c in byte]
            self.inner[b[:-1], b[1:]] = True
        self.joins = {(a, b) for a, b in zip(*(x.tolist() for x in np.nonzero(self.inner)))}
        self.first = [self.vocab.get(c) for c in self.letters]
        self.last = [self.vocab.get(c + self.end) for c in self.letters]
        self.token = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        split = next(p["pattern"]["Regex"] for p in data["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split.replace(r"[^\s", r"[^\p{White_Space}"))
        self.space = regex.compile(r"\p{White_Space}+")
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.fragments: dict[bytes, tuple[int, ...]] = {}
        self.known: dict[bytes, tuple[int, ...]] = {}
        self.memo: dict[str, tuple[int, str, str]] = {}

    @classmethod
    def of(cls, spec: str) -> "ForcedBoundaryBPE":
        key = hash(spec)
        if key not in cls._by_spec:
            cls._by_spec[key] = cls(spec)
        return cls._by_spec[key]

    def normal(self, text: str) -> str:
        text = self.space.sub(" ", unicodedata.normalize("NFC", text))
        # a capital sigma alone: the letter by letter mapping knows no final form
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def _merge(self, data: bytes, ends: bool) -> tuple[int, ...]:
        """ids of one fragment: join the pair of lowest rank, leftmost first, until none is left."""
        ids = [self.first[b] for b in data]
        if ends:
            ids[-1] = self.last[data[-1]]
        if len(ids) > LONG:
            return self._merge_long(ids)
        get = self.merge.get
        found = [get(p) for p in zip(ids, ids[1:])]
        while True:
            best = None
            for i, f in enumerate(found):
                if f is not None and (best is None or f < best):
                    best, at = f, i
            if best is None:
                return tuple(ids)
            ids[at : at + 2] = [best[1]]
            del found[at]
            if at:
                found[at - 1] = get((ids[at - 1], ids[at]))
            if at < len(found):
                found[at] = get((ids[at], ids[at + 1]))

    def _merge_long(self, ids: list[int | None]) -> tuple[int, ...]:
        """The same for many ids, by a heap of pairs over a linked list: time grows little faster than their number."""
        get, n = self.merge.get, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(f, i) for i, f in enumerate(map(get, zip(ids, ids[1:]))) if f is not None]
        heapq.heapify(heap)
        while heap:
            f, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] is None or j == n or get((ids[i], ids[j])) != f:  # one of the two has been joined since
                continue
            ids[i], ids[j], after[i] = f[1], None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                g = get((ids[a], ids[b])) if a >= 0 and b < n else None
                if g is not None:
                    heapq.heappush(heap, (g, a))
        return tuple(x for x in ids if x is not None)

    def word(self, data: bytes) -> tuple[int, ...]:
        """ids of one pre-token: cut at every byte pair that no token holds, encode the fragments, concatenate."""
        got = self.known.get(data)
        if got is None:
            joins, start, out = self.joins, 0, []
            for i in range(1, len(data) + 1):
                last = i == len(data)
                if last or (data[i - 1], data[i]) not in joins:
                    key = data[start:i] + b"\n" if last else data[start:i]  # white space is in no fragment
                    piece = self.fragments.get(key)
                    if piece is None:
                        piece = self.fragments[key] = self._merge(data[start:i], last)
                    out += piece
                    start = i
            got = self.known[data] = tuple(out)
        return got

    def ids(self, text: str) -> list[int]:
        """ids of any text, special tokens in it included."""
        out: list[int] = []
        at = 0
        for m in self.specials.finditer(text) if self.specials else ():
            out += self._ordinary(text[at : m.start()])
            out.append(self.special[m[0]])
            at = m.end()
        return out + self._ordinary(text[at:])

    def _ordinary(self, text: str) -> list[int]:
        return [i for w in self.words.findall(self.normal(text)) for i in self.word(w.encode())]

    def decode(self, ids: list[int]) -> str:
        """What the library gives for a file without a decoder: the tokens, joined by spaces."""
        return " ".join([self.token[i] for i in ids])

    def chunks(self, chunks: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, decimal ids, tokens), each joined by spaces, of chunks without ASCII white space."""
        memo, out = self.memo, []
        for part in (self.memo, self.known, self.fragments):
            if len(part) > MEMO:
                part.clear()
        for c in chunks:
            got = memo.get(c)
            if got is None:
                ids = self.ids(c)
                got = memo[c] = (len(ids), " ".join(map(str, ids)), self.decode(ids))
            out.append(got)
        return out


def encode_decode(docs: DataFrame, spec: str) -> DataFrame:
    """Per document: number of ids, SHA-256 of the decimal ids joined by a space, SHA-256 of the decoded text.

    Null texts are empty: no ids, and digests of the empty string. Repeated rows, null doc_ids and extra columns
    pass without effect on others; there is no shuffle, and memory is bounded by a batch of texts and the memo. A text of
    any length is taken whole; an empty table gives no row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ForcedBoundaryBPE.of(shared.value)
        for whole in batches:
            for b in cut(whole, "text"):
                offsets, index, distinct = chunked(b.column("text"))
                coded = bpe.chunks(distinct)
                size = np.fromiter((n for n, _, _ in coded), np.int64, len(coded))
                full = size[index] > 0  # a chunk of other white space only has no ids
                at = np.concatenate([[0], np.cumsum(full)])[offsets]
                total = np.concatenate([[0], np.cumsum(size[index])])[offsets]
                take = pa.array(index[full])
                sums = []
                for k in (1, 2):
                    texts = pc.take(pa.array([x[k] for x in coded], pa.large_string()), take)
                    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(at), texts), pa.scalar(" ", pa.large_string()))
                    sums.append([hashlib.sha256(x.as_buffer()).hexdigest() for x in joined])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.diff(total)), pa.array(sums[0]), pa.array(sums[1])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return arrow_map(columns(docs, "doc_id", "text"), run, SCHEMA)
