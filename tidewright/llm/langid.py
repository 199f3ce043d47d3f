"""Language identification by a byte convolutional network.

Filters of several widths run over the bytes of fixed-length windows, each filter's largest response in a
window is kept, and a softmax layer names the language. Training is plain numpy on a bounded sample of
labelled windows; a text's prediction averages the log-probabilities of all its windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import arrow_map, columns, cut, folded, refolded, unfolded

#: Bytes of a window, filter widths, filters of each width.
WINDOW, WIDTHS, FILTERS = 256, (2, 3, 4), 12
#: Bounds of the training sample: documents of a language (expected) and windows of a document.
DOCS_PER_LANG, WINDOWS_PER_DOC = 1500, 3
EPOCHS, BATCH, RATE, SEED = 12, 128, 0.01, 11
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_STRIDE = WINDOW - max(WIDTHS) + 1


def windows_of(text: str) -> np.ndarray:
    """Rows of WINDOW bytes that cover the whole text (ASCII letters lower-cased), so that no n-gram is missed; spaces pad."""
    data = np.frombuffer(text.encode().lower(), np.uint8)
    n = max(1, -(-(len(data) - WINDOW) // _STRIDE) + 1) if len(data) > WINDOW else 1
    padded = np.full((n - 1) * _STRIDE + WINDOW, 32, np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::_STRIDE]


@dataclass
class ByteCNN:
    """filters[w] has the weights (w, 256, FILTERS) of width w; dense and bias make the logits."""

    labels: list[str]
    filters: dict[int, np.ndarray]
    offsets: np.ndarray
    dense: np.ndarray
    bias: np.ndarray
    _tables: tuple | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"_tables": None}

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses by byte pairs: what bytes 0 and 1 give to all filters, and bytes 2 and 3 to those that reach them."""
        if self._tables is None:
            f2, f3, f4 = (self.filters[w] for w in WIDTHS)
            first = np.concatenate([(f[0][:, None, :] + f[1][None, :, :]).reshape(65536, -1) for f in (f2, f3, f4)], axis=1)
            second = np.concatenate([np.repeat(f3[2], 256, axis=0), (f4[2][:, None, :] + f4[3][None, :, :]).reshape(65536, -1)], axis=1)
            self._tables = np.ascontiguousarray(first, np.float32), np.ascontiguousarray(second, np.float32)
        return self._tables

    def pooled(self, windows: np.ndarray, where: bool = False):
        """Largest response of each filter in each window (n, filters), and its position if asked."""
        first, second = self.tables()
        pairs = (windows[:, :-1].astype(np.int32) << 8) | windows[:, 1:]
        steps = WINDOW - max(WIDTHS) + 1
        r = first[pairs[:, :steps]]
        r[:, :, FILTERS:] += second[pairs[:, 2 : 2 + steps]]
        if where:
            at = r.argmax(axis=1)
            return np.take_along_axis(r, at[:, None, :], axis=1)[:, 0] + self.offsets, at
        return r.max(axis=1) + self.offsets

    def log_probs(self, windows: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(windows), 64):
            z = np.maximum(self.pooled(windows[i : i + 64]), 0) @ self.dense + self.bias
            z -= z.max(axis=1, keepdims=True)
            out.append(z - np.log(np.exp(z).sum(axis=1, keepdims=True)))
        return np.concatenate(out)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        for a in range(0, len(known), 256):
            part = known[a : a + 256]
            rows = [windows_of(texts[i]) for i in part]
            starts = np.cumsum([0, *map(len, rows)])[:-1]
            mean = np.add.reduceat(self.log_probs(np.concatenate(rows)), starts, axis=0) / np.array([len(r) for r in rows])[:, None]
            p = np.exp(mean - mean.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            for i, b, q in zip(part, best.tolist(), p.max(axis=1).tolist()):
                out[i] = (self.labels[b], min(1.0, float(q)))
        return out


def train(windows: np.ndarray, y: np.ndarray, labels: list[str]) -> ByteCNN:
    """Adam on cross-entropy; classes weigh alike. The gradient of a maximum reaches only the bytes under it."""
    rng = np.random.default_rng(SEED)
    n_filters, n_labels = FILTERS * len(WIDTHS), len(labels)
    p = {f"f{w}": rng.normal(0, 0.3, (w, 256, FILTERS)) for w in WIDTHS}
    p |= {"offsets": np.zeros(n_filters), "dense": rng.normal(0, 0.3, (n_filters, n_labels)), "bias": np.zeros(n_labels)}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    weight = len(y) / (n_labels * np.maximum(1, np.bincount(y, minlength=n_labels)))

    def model() -> ByteCNN:
        return ByteCNN(labels, {w: p[f"f{w}"] for w in WIDTHS}, p["offsets"].astype(np.float32), p["dense"].astype(np.float32), p["bias"].astype(np.float32))

    def responses(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        steps, best, at = WINDOW - max(WIDTHS) + 1, [], []
        for w in WIDTHS:
            f = p[f"f{w}"].astype(np.float32)
            r = sum(f[k][x[:, k : k + steps]] for k in range(w))
            i = r.argmax(axis=1)
            best.append(np.take_along_axis(r, i[:, None, :], axis=1)[:, 0])
            at.append(i)
        return np.concatenate(best, axis=1) + p["offsets"], np.concatenate(at, axis=1)

    t = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            rows = order[i : i + BATCH]
            x, target = windows[rows], y[rows]
            h, at = responses(x)
            a = np.maximum(h, 0)
            z = a @ p["dense"] + p["bias"]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            d = z
            d[np.arange(len(rows)), target] -= 1
            d *= (weight[target] / len(rows))[:, None]
            g = {"dense": a.T @ d + 1e-4 * p["dense"], "bias": d.sum(axis=0)}
            dh = (d @ p["dense"].T) * (h > 0)
            g["offsets"] = dh.sum(axis=0)
            for j, w in enumerate(WIDTHS):
                s = slice(j * FILTERS, (j + 1) * FILTERS)
                gw = np.zeros_like(p[f"f{w}"])
                for k in range(w):
                    under = np.take_along_axis(x, at[:, s] + k, axis=1)
                    np.add.at(gw[k], (under, np.arange(FILTERS)[None, :]), dh[:, s])
                g[f"f{w}"] = gw
            t += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - RATE * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return model()


def held_out() -> "F.Column":
    """True where crc32 of doc_id as text leaves 1 modulo 3; a null doc_id counts as empty text, which does not."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, windows_per_doc: int = WINDOWS_PER_DOC) -> ByteCNN | None:
    """A network from documents with a language that are not held out; None if there is none.

    The sample is bounded: a hash of doc_id and text picks an expected ``docs_per_lang`` documents of each language (at most
    four thirds of it are used), from each of which at most ``windows_per_doc`` windows spread over the text reach the driver.
    Null texts and languages teach nothing; repeated rows are picked together; an empty table gives None; other columns are ignored.
    """
    rows = columns(docs, "doc_id", "text", "lang").where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for a language
    if not counts:
        return None
    labels = sorted(counts)
    share = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, docs_per_lang / n))))
    picked = rows.where(F.pmod(F.xxhash64("doc_id", F.substring("text", 1, 64)), F.lit(1_000_003)) < share[F.col("lang")] * 1_000_003)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in cut(whole, "text"):
                out: tuple[list, list, list] = ([], [], [])
                for key, lang, text in zip(b.column("doc_id").to_pylist(), b.column("lang").to_pylist(), b.column("text").to_pylist()):
                    if _LETTER.search(text):
                        w = windows_of(text)
                        for i in sorted({(2 * k + 1) * len(w) // (2 * windows_per_doc) for k in range(windows_per_doc)}):
                            out[0].append(key)
                            out[1].append(lang)
                            out[2].append(w[i].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.binary())], names=["doc_id", "lang", "window"])

    most = 4 * docs_per_lang * windows_per_doc * max(1, len(labels)) // 3
    spreads = arrow_map(picked, spread, "doc_id long, lang string, window binary").select("lang", "window")
    sample = sorted(spreads.orderBy(F.xxhash64("lang", "window"), "window").limit(most).collect(), key=lambda r: (r["lang"], r["window"]))  # the same in every run
    if not sample:
        return None
    windows = np.frombuffer(b"".join(r["window"] for r in sample), np.uint8).reshape(-1, WINDOW)
    index = {lang: i for i, lang in enumerate(labels)}
    return train(windows, np.array([index[r["lang"]] for r in sample]), labels)


def identify(docs: DataFrame, model: ByteCNN | None) -> DataFrame:
    """Per document doc_id, held_out, lang_pred and score over its whole text, whatever its length.

    ``und`` with score 0 stands for null texts, texts without a letter, and every text where there was nothing to learn
    from. Only the text is read. Repeated rows and null ids stay rows of their own; an empty table gives no row; there is no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a few hundred kB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in cut(whole, "text"):
                texts = b.column("text").to_pylist()
                got = shared.value.predict(texts) if shared.value is not None else [(UNKNOWN, 0.0)] * len(texts)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return arrow_map(columns(docs, "doc_id", "text").withColumn("held_out", held_out()), run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: ByteCNN | None, least: float) -> DataFrame:
    """The documents, all columns, whose language is known with a score of ``least`` or more, and in ``lang`` the language predicted.

    Without a model all documents stay as they are. Null texts and texts without a letter go; texts of any length are taken whole;
    repeated rows and null ids are rows like others, and an empty table stays empty.
    """
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in cut(unfolded(whole), "text"):
                got = shared.value.predict(b.column("text").to_pylist())
                if "lang" in b.schema.names:
                    b = b.set_column(b.schema.names.index("lang"), "lang", pa.array([lang for lang, _ in got], pa.string()))
                b = b.filter(pa.array([lang != UNKNOWN and p >= least for lang, p in got], pa.bool_()))
                yield pa.RecordBatch.from_arrays([refolded(b)], names=["row"])

    return arrow_map(folded(docs), run, StructType([StructField("row", docs.schema)])).select("row.*")
