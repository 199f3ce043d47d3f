"""Tokens of whole texts for the public word-level BPE file, by way of distinct units.

Texts are cut at ASCII white space, which the tokenizer drops and no token crosses. Chunks of plain characters are
lower-cased and cut further where the tokenizer's pre-tokenizer cuts; all of it on arrays of bytes. Each distinct unit
of a slice is encoded once and the ids of the texts are gathered with vectorised takes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Entries that a worker keeps of encoded units; a full memo is emptied, which costs time only.
MEMO = 400_000
#: Bytes of text that are cut at once.
SLICE = 4 << 20

# Kinds of bytes: white space, letter, digit, other printable, and what sends its chunk to the library as a whole.
_SPACE, _LETTER, _DIGIT, _OTHER, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[[32, *range(9, 14)]] = _SPACE
_KIND[33:127] = _OTHER
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[39] = _ODD  # an apostrophe may begin a contraction
#: What a byte after 0xC3 makes: letters À to ÿ, without the signs of multiplication and division; NFC does not change them.
_TAIL = np.full(256, _ODD, np.uint8)
_TAIL[0x80:0xC0] = _LETTER
_TAIL[[0x97, 0xB7]] = _ODD


class LibraryEncoder:
    """ids of units by the tokenizers library, memoised.

    Plain units, each one word to the tokenizer, are encoded many at a time, and told apart by the mark of word ends that their
    last tokens have; a tokenizer without such a mark gets every unit by itself.
    """

    _by_spec: dict[int, "LibraryEncoder"] = {}

    def __init__(self, spec: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        #: Bytes with which an added token begins: a chunk with one of them is not cut further.
        self.marks = sorted({b for t in self.tokenizer.get_added_tokens_decoder().values() for b in t.content.encode()[:1]})
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.plain = re.compile("(?:[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\\[-`{-~]+)") if suffix else re.compile("(?!)")
        self.known: dict[str, bytes] = {}

    @classmethod
    def of(cls, spec: str) -> "LibraryEncoder":
        """One for a worker process and tokenizer, so that the memo outlives a task."""
        key = hash(spec)
        if key not in cls._by_spec:
            cls._by_spec[key] = cls(spec)
        return cls._by_spec[key]

    def _singly(self, new: list[str]) -> None:
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            self.known.update(zip(part, [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]))

    def _together(self, new: list[str]) -> None:
        parts = [new[i : i + 256] for i in range(0, len(new), 256)]
        for part, e in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            stop = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stop) != len(part) or stop[-1] != 4 * len(ids):
                self._singly(part)
                continue
            data = ids.tobytes()
            self.known.update(zip(part, [data[a:b] for a, b in zip([0, *stop], stop)]))

    def encode(self, units: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each unit."""
        known = self.known
        new = [u for u in units if u not in known]
        if new:
            if len(known) + len(new) > MEMO:
                known.clear()
                new = units
            plain = self.plain.fullmatch
            whole = [bool(plain(u)) and "'" not in u for u in new]
            self._together([u for u, w in zip(new, whole) if w])
            self._singly([u for u, w in zip(new, whole) if not w])
        return [known[u] for u in units]

    def ids(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(offsets of each text in ids, ids as uint32) of a batch of texts, each with ``end_id`` at its end; null is empty."""
        offsets, ids = ids_of(texts, self.encode, self.marks)
        if end_id is not None:
            ids, offsets = np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(len(offsets))
        return offsets, ids


def units(texts: list[bytes], marks: Iterable[int] = ()) -> tuple[np.ndarray, pa.Array]:
    """(first unit of each text and one past the last, units of all texts in order).

    A unit is a run of letters, a digit, or a run of other characters of a plain chunk, in lower case; or a whole chunk that
    holds an apostrophe, a character outside ASCII and À to ÿ, a control character or one of ``marks``.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    table = _KIND.copy()
    table[list(marks)] = _ODD
    kind = table[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    tail = _TAIL[data[lead + 1]]
    good = lead[tail == _LETTER]
    kind[good] = kind[good + 1] = _LETTER
    space = kind == _SPACE
    start = np.ones(len(data), bool)  # of a chunk, or of white space
    start[1:] = space[1:] != space[:-1]
    odd = kind == _ODD
    if odd.any():
        at = np.flatnonzero(start)
        size = np.diff(np.concatenate([at, [len(data)]]))
        odd = np.repeat(np.logical_or.reduceat(odd, at), size)
    low = data.copy()
    upper = (data >= 65) & (data <= 90) & ~odd
    low[upper] += 32
    second = good + 1
    capital = second[(data[second] <= 0x9E) & ~odd[second]]
    low[capital] += 32
    cut = start.copy()  # of a unit
    cut[1:] |= ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & ~odd[1:]
    keep = ~space
    bounds = np.concatenate([[0], np.cumsum(keep)])
    starts = np.flatnonzero(cut & keep)
    offsets = np.concatenate([bounds[starts], bounds[-1:]])
    wide = int(offsets[-1]) >= 1 << 31
    made = (pa.LargeStringArray if wide else pa.StringArray).from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64 if wide else np.int32)), pa.py_buffer(low[keep]))
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return np.searchsorted(starts, np.concatenate([[0], ends])), made


def ids_of(texts: pa.Array, encode: Callable[[list[str]], Iterable[bytes]], marks: Iterable[int] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of each text in ids, ids as uint32) for a batch of texts; null is empty."""
    data = [x or b"" for x in pc.cast(texts, pa.binary()).to_pylist()]
    sizes, parts = [np.zeros(1, np.int64)], []
    i = 0
    while i < len(data):
        n, j = 0, i
        while j < len(data) and (j == i or n + len(data[j]) <= SLICE):
            n += len(data[j])
            j += 1
        offsets, made = units(data[i:j], marks)
        i = j
        coded = made.dictionary_encode()
        index = coded.indices.to_numpy().astype(np.int64)
        ids = list(encode(coded.dictionary.to_pylist()))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        flat = np.frombuffer(b"".join(ids), "<u4")
        first, count = (np.cumsum(size) - size)[index], size[index]
        ends = np.concatenate([[0], np.cumsum(count)])
        sizes.append(np.diff(ends[offsets]))
        if len(flat) and len(index):
            if int(size.max()) == 1 and int(size.min()) == 1:
                parts.append(flat[index])
            else:
                parts.append(flat[np.repeat(first - ends[:-1], count) + np.arange(int(ends[-1]))])
    return np.cumsum(np.concatenate(sizes)), np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def chunked(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(first chunk of each text and one past the last, index of each chunk in the distinct chunks, distinct chunks)."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = parts.values.slice(parts.offsets[0].as_py(), parts.offsets[-1].as_py() - parts.offsets[0].as_py()).dictionary_encode()
    offsets = parts.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
