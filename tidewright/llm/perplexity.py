"""Quality rules by n-gram perplexity under a modified Kneser-Ney model counted with Spark.

The n-grams are of ORDER bytes. Tasks count those of every document in sorted arrays, a shuffle of (code, count) adds them up,
and all of them stay: nothing is dropped, whatever the size of the corpus. Lower orders, their counts of distinct
continuations, totals of contexts and discounts are aggregations of that table. Each n-gram has counts of its own. The commonest of
an order, at most HELD, are broadcast in sorted arrays; where there are more, the others stay in a staged table, and documents
ask it by a join for what the arrays do not have, a pack of texts at a time. So scores are exact for a model of any size.

A document is scored without its own counts: n-grams that nothing else has are unknown, in every order. A text with many
exact copies is scored without these too. It is rejected if its mean negative log-probability lies outside a band of its
language, above or below: Tukey fences, the quartiles over all documents of the language that pass the base rules, widened
by REACH times their distance, and more for short texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import Staged, arrow_map, block_count, block_of, by_block, columns, cut, folded, refolded, slices, unfolded
from .tokens import chunked

#: Bytes of an n-gram (codes are whole numbers of as many bytes), and entries that the broadcast arrays of an order may have.
ORDER, HELD = 4, 4_194_301
#: Bits of a code in a key of the rest of the model; the table it is of lies above them.
CODE_BITS = 56
#: Fences: quartile distances beyond the quartiles, and words at which a short text's band is twice as wide.
REACH, SHORT = 2.0, 20.0
#: Texts with more exact copies than a COPIED-th of all documents are scored without their copies; there are fewer than COPIED.
COPIED = 1000
#: Words in a window of repeats, least words, and most percent of repeated words.
REPEAT_WORDS, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
SYMBOLS = "[#*$%&|<>]"


def word_hashes(words: list[str]) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_digest
    return np.frombuffer(b"".join([digest(w) for w in words]), ">u8").astype(np.uint64)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Like chunked(), without the empty chunks at a text's ends."""
    offsets, index, distinct = chunked(texts)
    if "" in distinct:
        full = index != distinct.index("")
        offsets, index = np.concatenate([[0], np.cumsum(full)])[offsets], index[full]
    return offsets, index, distinct


def _counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(counts[order], first) if len(k) else counts


class _Tally:
    """Counts of 64-bit keys in sorted arrays; hands over what it has when it grows beyond ``most`` entries."""

    def __init__(self, most: int = 4 << 20):
        self.most, self.parts, self.size, self.merged_size = most, [], 0, 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        got = _counts(*(np.concatenate(x) for x in zip(*self.parts)))
        self.parts, self.size = [got], len(got[0])
        return got

    def full(self) -> bool:
        if self.size > 2 * self.merged_size + (1 << 19):  # repeats of many slices
            self.merged_size = len(self.merged()[0])
        return self.size > self.most

    def rows(self) -> Iterator[pa.RecordBatch]:
        keys, counts = self.merged()
        self.parts, self.size, self.merged_size = [], 0, 0
        for i in range(0, len(keys), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + (1 << 16)].view(np.int64)), pa.array(counts[i : i + (1 << 16)].astype(np.int64))], names=["k", "n"])


def gram_codes(texts: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """(code of every n-gram, its text): each byte of a text, and the NUL after its last, with the bytes before it, NUL before the first."""
    data = np.frombuffer(b"".join([b"\0" * (order - 1) + t + b"\0" for t in texts]), np.uint8).astype(np.uint64)
    size = np.array([len(t) + order for t in texts], np.int64)
    codes = np.zeros(len(data), np.uint64)
    for j in range(order):
        codes[order - 1 :] |= data[order - 1 - j : len(data) - j] << np.uint64(8 * j)
    whole = np.ones(len(data), bool)
    starts = np.cumsum(size) - size
    for j in range(order - 1):
        whole[starts + j] = False
    return codes[whole], np.repeat(np.arange(len(texts)), size)[whole]


def _bytes(texts: pa.Array) -> list[bytes]:
    return [t or b"" for t in pc.cast(texts, pa.binary()).to_pylist()]


def count_grams(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(k, n): how often the texts of all documents have each n-gram; null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for b in slices(batches, "text", 2 << 20):
            tally.add(*np.unique(gram_codes(_bytes(b.column("text")), order)[0], return_counts=True))
            if tally.full():
                yield from tally.rows()
        yield from tally.rows()

    return arrow_map(columns(docs, "text"), run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more; halves where a count of counts is missing."""
    if not (n1 and n2 and n3 and n4):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = [0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.clip(d, 0.0, [0, 1, 2, 3])


@dataclass
class Table:
    """Two numbers for each of some codes, which ascend; without ``whole`` the rest of the model may have others."""

    codes: np.ndarray
    one: np.ndarray
    two: np.ndarray
    whole: bool = True

    def at(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each code, whether it is there)."""
        if not len(self.codes):
            return np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
        codes = codes.astype(self.codes.dtype)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return at, self.codes[at] == codes

    def find(self, codes: np.ndarray, more: Table | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Both numbers of each code, by the table or else by ``more``; zeros for a code that neither has."""
        at, known = self.at(codes)
        if not len(self.codes):
            one, two = np.zeros(len(codes), self.one.dtype), np.zeros(len(codes), self.two.dtype)
        else:
            one, two = np.where(known, self.one[at], 0), np.where(known, self.two[at], 0)
        if more is not None and not known.all():
            one[~known], two[~known] = more.find(codes[~known])
        return one, two


@dataclass
class Level:
    """One order: n-grams with their value (a count at the highest order, else of distinct bytes before) and raw count; contexts
    with the sum of values and of what discounts leave of them; discounts."""

    grams: Table
    contexts: Table
    d: np.ndarray

    def left(self, values: np.ndarray) -> np.ndarray:
        return np.maximum(0.0, values - self.d[np.minimum(values, 3)])


def _grouped(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, the sum of their weights, and the place of each key among them."""
    order = np.argsort(keys)
    k = keys[order]
    new = np.concatenate([[True], k[1:] != k[:-1]]) if len(k) else np.zeros(0, bool)
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    return k[first], np.add.reduceat(weights[order], first) if len(k) else weights, place


@dataclass
class KneserNey:
    """levels[k - 1] has the n-grams of k bytes. ``rest`` (key, one, two) has what their tables could not hold, if there is any: a
    key is a code and, above CODE_BITS, the number of its table: those of the n-grams of k bytes and their contexts are 2k - 2, 2k - 1.
    """

    levels: list[Level]
    rest: DataFrame | None = None

    def asked(self, texts: list[bytes]) -> np.ndarray:
        """Ascending keys of all that the texts need and that only the rest can have."""
        codes, out = np.unique(gram_codes(texts, len(self.levels))[0]), []
        for k in range(len(self.levels), 0, -1):
            level = self.levels[k - 1]
            for number, table, some in ((2 * k - 2, level.grams, codes), (2 * k - 1, level.contexts, np.unique(codes >> np.uint64(8)))):
                if not table.whole:
                    out.append((number << CODE_BITS) + some[~table.at(some)[1]].astype(np.int64))
            codes = np.unique(codes & np.uint64((1 << 8 * (k - 1)) - 1))
        return np.sort(np.concatenate([np.zeros(0, np.int64), *out]))

    def answers(self, found: pa.Table) -> list[Table]:
        """Rows (key, one, two) of the rest as tables, by number."""
        key, one, two = (found.column(c).to_numpy() for c in ("key", "one", "two"))
        order = np.argsort(key)
        key, one, two = key[order], one[order], two[order]
        ends = np.searchsorted(key, np.arange(2 * len(self.levels) + 1, dtype=np.int64) << CODE_BITS)
        kinds = (np.int64, np.float64)  # raw counts of n-grams are whole, masses of contexts are not
        return [Table((key[i:j] - (n << CODE_BITS)).astype(np.uint64), one[i:j], two[i:j].astype(kinds[n % 2])) for n, (i, j) in enumerate(zip(ends[:-1], ends[1:]))]

    def negative_logs(self, texts: list[bytes], own: np.ndarray | None = None, more: list[Table] | None = None) -> np.ndarray:
        """Mean negative log-probability of the bytes of each text, its end included.

        ``more`` has what the rest answered to asked(texts); without it, the rest is asked here.

        With ``own``, text i is ``own[i]`` times in the counts, and is scored without these: its n-grams count less, those that
        nothing else has are no continuations of shorter ones, and contexts lose what their n-grams lose.
        """
        order = len(self.levels)
        if self.rest is not None and more is None:
            keys = self.rest.sparkSession.createDataFrame(pa.table({"key": self.asked(texts)}))
            more = self.answers(self.rest.join(keys, "key").toArrow())
        wide = np.uint64(8 * order)
        codes, text = gram_codes(texts, order)
        keys, times, _ = _grouped((text.astype(np.uint64) << wide) | codes, np.ones(len(codes), np.int64))
        top, shift = (keys, times), np.uint64(8)
        copies = np.zeros(len(texts), np.int64) if own is None else own
        parts: list[tuple] = []
        lost = None
        for k in range(order, 0, -1):
            level, code = self.levels[k - 1], keys & np.uint64((1 << 8 * order) - 1)
            out = times * copies[(keys >> wide).astype(np.int64)]
            value, raw = level.grams.find(code, more and more[2 * k - 2])
            rest = np.maximum(0, value - (out if lost is None else lost))
            context = ((keys >> wide) << wide) | (code >> shift)
            first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
            group = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(context)]])))
            total, mass = level.contexts.find(code[first] >> shift, more and more[2 * k - 1])
            kept = level.left(rest)
            total = total - np.add.reduceat(value - rest, first)
            mass = mass - np.add.reduceat(level.left(value) - kept, first)
            shorter, shorter_times, place = _grouped(((keys >> wide) << wide) | (code & np.uint64((1 << 8 * (k - 1)) - 1)), times)
            parts.append((kept, total[group], mass[group], place))
            lost = np.bincount(place, weights=(out > 0) & (raw <= out), minlength=len(shorter)).astype(np.int64)
            keys, times = shorter, shorter_times
        p = np.full(len(keys), 1 / 256)
        for kept, total, mass, place in reversed(parts):
            some = np.maximum(1, total)
            p = np.where(total > 0, kept / some + np.clip(1.0 - mass / some, 1e-9, 1.0) * p[place], p[place])
        sums = np.bincount((top[0] >> wide).astype(np.int64), weights=-top[1] * np.log(np.minimum(1.0, p)), minlength=len(texts))
        return sums / np.array([len(t) + 1 for t in texts])


def fit(docs: DataFrame, order: int = ORDER) -> KneserNey:
    """Count the n-grams of all documents and build the model; what the driver gets is at most HELD entries an array.

    Null texts have no n-grams; a text of any length is counted whole, and repeated rows as often as they stand. A model of an empty
    table knows nothing, and gives every byte one probability.
    """
    counted = Staged(count_grams(docs, order), "grams")
    table = counted.df.select("k", F.col("n").alias("raw"), F.col("n").alias("value"))
    kind = np.uint32 if order <= 4 else np.uint64
    bits = F.length(F.bin("raw"))
    levels: list[Level] = []
    rest: list[DataFrame] = []

    def held(rows: DataFrame, sizes: dict[int, int], number: int) -> Table:
        """The commonest rows (k, raw, one, two) of as many as ``sizes`` has by the bits of raw, as far as HELD goes; others go to the rest."""
        least = next((b for b in range(64) if sum(n for x, n in sizes.items() if x >= b) <= HELD), 64)
        whole = least <= min(sizes, default=64)
        if not whole:
            rest.append(rows.where(bits < least).select((F.col("k") + F.lit(number << CODE_BITS)).alias("key"), F.col("one").cast("long").alias("one"), F.col("two").cast("double").alias("two")))
            rows = rows.where(bits >= least)
        got = rows.select("k", "one", "two").toArrow()
        k = got.column("k").to_numpy()
        at = np.argsort(k)
        return Table(k[at].astype(kind), got.column("one").to_numpy()[at], got.column("two").to_numpy()[at], whole)

    def by_size(rows: DataFrame) -> dict[int, int]:
        return {r["b"]: r["m"] for r in rows.groupBy(bits.alias("b")).agg(F.count("*").alias("m")).collect()}

    for k in range(order, 0, -1):
        sizes: dict[int, int] = {}
        of_counts: dict[int, int] = {}
        for r in table.groupBy(bits.alias("b"), F.least("value", F.lit(5)).alias("v")).agg(F.count("*").alias("m")).collect():
            sizes[r["b"]] = sizes.get(r["b"], 0) + r["m"]
            of_counts[r["v"]] = of_counts.get(r["v"], 0) + r["m"]
        d = discounts(*(of_counts.get(i, 0) for i in (1, 2, 3, 4)))
        left = F.greatest(F.lit(0.0), F.col("value") - F.element_at(F.array(*map(F.lit, d.tolist())), F.least("value", F.lit(3)).cast("int") + 1))
        contexts = table.groupBy(F.shiftrightunsigned("k", 8).alias("k")).agg(F.sum("raw").alias("raw"), F.sum("value").alias("one"), F.sum(left).alias("two"))
        grams = held(table.select("k", "raw", F.col("value").alias("one"), F.col("raw").alias("two")), sizes, 2 * k - 2)
        levels.append(Level(grams, held(contexts, by_size(contexts) if sum(sizes.values()) > HELD else sizes, 2 * k - 1), d))  # no more contexts than n-grams
        if k > 1:
            short = F.col("k").bitwiseAND(F.lit((1 << 8 * (k - 1)) - 1))
            table = table.groupBy(short.alias("k")).agg(F.sum("raw").alias("raw"), F.count("*").alias("value"))
    others = Staged(reduce(DataFrame.unionByName, rest), "rest").df if rest else None
    counted.drop()
    return KneserNey(levels[::-1], others)


def copied_texts(docs: DataFrame) -> dict[int, int]:
    """How often all documents have each text, by its hash, of those with more than a COPIED-th of all rows."""
    by_text = docs.groupBy(F.xxhash64(F.col("`text`").cast("string")).alias("h")).agg(F.count("*").alias("n"))
    total = docs.count()
    return {r["h"]: r["n"] for r in by_text.where(F.col("n") > total // COPIED + 1).collect()}  # fewer than COPIED


def repeated_words(codes: np.ndarray, window: int = REPEAT_WORDS) -> int:
    """Words in windows found twice or more in a text; codes name its words."""
    n = len(codes) - window + 1
    if n < 2:
        return 0
    h = np.zeros(n, np.uint64)
    for j in range(window):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[j : j + n]
    order = np.argsort(h, kind="stable")
    s = h[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, np.flatnonzero(twice), 1)
    np.add.at(cover, np.flatnonzero(twice) + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


_MIX = np.uint64(0xBF58476D1CE4E5B9)
_HASH = "\thash of the text"  # no name that a document's column has
SCORED = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_perplexity double"


def score(docs: DataFrame, model: KneserNey, carry: bool = False, own: bool = True) -> DataFrame:
    """Counts and mean negative log-probability of every whole text; of no words: null log-perplexity.

    With ``carry``, a struct ``row`` has all columns of the document too. ``own``: the model has counted these documents,
    and each is scored without itself and what copies of it are many.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.levels, copied_texts(docs) if own else {}))  # bounded by HELD and COPIED

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield unfolded(b.select(["row"])).append_column(_HASH, b.column(_HASH)) if carry else b

    def rows_of(whole: pa.RecordBatch, kn: KneserNey, copied: dict[int, int], more: list[Table] | None = None) -> Iterator[pa.RecordBatch]:
        for b in cut(whole, "text", 1 << 20):  # arrays of a slice are many times its text
            texts = b.column("text")
            offsets, index, distinct = _words(texts)
            words = pa.array(distinct, pa.string())
            hashes = word_hashes(distinct)

            def total(x: pa.Array) -> np.ndarray:
                return np.diff(np.concatenate([[0], np.cumsum(x.to_numpy()[index], dtype=np.int64)])[offsets])

            data = _bytes(texts)
            times = np.array([copied.get(h, 1) for h in b.column(_HASH).to_pylist()], np.int64) if own else None
            n = np.diff(offsets)
            mixed = ((hashes ^ (hashes >> np.uint64(31))) * _MIX)[index]
            repeats = [repeated_words(mixed[s:e]) for s, e in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            perplexity = pa.array(kn.negative_logs(data, times, more), mask=n == 0)
            extra = [refolded(b.select([c for c in b.schema.names if c != _HASH]))] if carry else []
            yield pa.RecordBatch.from_arrays(
                [pc.cast(b.column("doc_id"), pa.int64()), b.column("lang"), pa.array(n), pa.array(total(pc.utf8_length(words))), pa.array(total(pc.count_substring_regex(words, SYMBOLS))), pa.array([duplicate_lines(t or "") for t in texts.to_pylist()], pa.int64()), pa.array(repeats, pa.int64()), perplexity, *extra],
                names=["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_perplexity", *["row"] * carry],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, copied = shared.value
        for b in opened(batches):
            yield from rows_of(b, KneserNey(levels), copied)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kn, task = KneserNey(shared.value[0]), TaskContext.get().partitionId() << 32
        for i, b in enumerate(slices(opened(batches), "text")):
            keys = np.unique(np.concatenate([kn.asked(_bytes(c.column("text"))) for c in cut(b, "text", 1 << 20)]))
            with pa.BufferOutputStream() as out:
                with pa.ipc.new_stream(out, b.schema) as file:
                    file.write_batch(b)
                data = zstandard.compress(out.getvalue(), 3)
            yield pa.RecordBatch.from_arrays([pa.array([task + i]), pa.array([keys]), pa.array([data], pa.binary())], names=["pack", "asks", "data"])

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, copied = shared.value
        kn = KneserNey(levels)
        found: list[pa.RecordBatch] = []
        for b in batches:
            at = 0
            for i in np.flatnonzero(pc.is_valid(b.column("data")).to_numpy(zero_copy_only=False)).tolist():  # answers come before their pack
                more = kn.answers(pa.Table.from_batches([*found, b.slice(at, i - at)]))
                with pa.ipc.open_stream(zstandard.decompress(b.column("data")[i].as_py())) as file:
                    for whole in file:
                        yield from rows_of(whole, kn, copied, more)
                found, at = [], i + 1
            found.append(b.slice(at))

    if carry:
        rows, out = folded(docs).select("row", F.xxhash64(F.col("row")["text"].cast("string")).alias(_HASH)), StructType([*_scored(), StructField("row", docs.schema)])
    else:
        rows, out = columns(docs, "doc_id", "text", "lang").select("*", F.xxhash64("text").alias(_HASH)), SCORED
    if model.rest is None:
        return arrow_map(rows, run, out)
    n = block_count(docs)
    packs = Staged(arrow_map(rows, ask, "pack long, asks array<long>, data binary"), "packs").df.withColumn("block", block_of(n, "pack"))
    answers = packs.select("block", "pack", F.explode("asks").alias("key")).join(model.rest, "key")
    none = {"key": F.lit(None).cast("long"), "one": F.lit(None).cast("long"), "two": F.lit(None).cast("double")}
    parts = [answers.withColumn("data", F.lit(None).cast("binary")), packs.drop("asks").withColumns(none)]
    return arrow_map(by_block(parts, n, ["pack", F.col("data").isNotNull()]), answered, out)


def _scored() -> list[StructField]:
    return list(StructType.fromDDL(SCORED))


def judge(scored: DataFrame, reach: float = REACH) -> DataFrame:
    """Scored rows with base_failed and kept; ``scored`` is read twice, for the bands and for the verdicts."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = scored.withColumn("base_failed", failed)
    quartile = F.percentile_approx("log_perplexity", F.array(F.lit(0.25), F.lit(0.75)), 10_000)
    bands = rows.where(~F.col("base_failed")).groupBy("lang").agg(quartile.alias("q")).select(F.col("lang").alias("band_lang"), F.col("q")[0].alias("low"), F.col("q")[1].alias("high"))
    spread = F.greatest(F.col("high") - F.col("low"), F.lit(0.02)) * (1 + F.sqrt(F.lit(SHORT) / F.greatest("n_words", F.lit(1))))
    inside = F.col("log_perplexity").between(F.col("low") - reach * spread, F.col("high") + reach * spread)
    joined = rows.join(F.broadcast(bands), F.col("lang").eqNullSafe(F.col("band_lang")), "left")  # a row for a language
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(True)))


def quality(docs: DataFrame, model: KneserNey | None = None) -> DataFrame:
    """Per document its counts, base_failed and kept: not failed, and log-perplexity inside its language's band.

    A null text has no words and fails the base rules. Documents without a language share a band of their own; a band is
    set by documents that pass the base rules, and a language without one keeps what passes. Repeated rows and null ids
    stay; a text of any length is taken whole; an empty table gives no row; extra columns are ignored.
    """
    judged = judge(Staged(score(docs, model or fit(docs), own=model is None), "scored").df)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.exp("log_perplexity").alias("perplexity"))


def keep_good(docs: DataFrame, model: KneserNey | None = None) -> DataFrame:
    """The documents, all columns as they are under any names, that quality() keeps: each row judged as there, an empty table empty."""
    judged = judge(Staged(score(docs, model or fit(docs), carry=True, own=model is None), "scored").df)
    return judged.where("kept").select("row.*")
