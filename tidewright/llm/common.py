"""What the training-data operators share: input columns, staged tables, and passes over blocks of documents.

A *block* is a set of whole documents chosen by a hash of ``doc_id`` and text, so that several passes over the
same input agree on it without keeping anything between them. A pass deals rows to block ``b`` in
partition ``b`` (texts travel in compressed packs), sorts them so that small answer rows come before the
texts, and takes a block at a time through Python. Memory is bounded by the block, whose size is fixed
while their number grows.
"""

from __future__ import annotations

import atexit
import ctypes
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of text that one block of documents should hold, unless the session sets BLOCK_CONF. Messages between blocks grow with the
#: square of their number, as segments of a shuffle do: executors with more memory should be given larger blocks.
BLOCK_BYTES, BLOCK_CONF = 24 << 20, "spark.tidewright.blockBytes"
#: Hot keys for each shuffle partition that a join may broadcast.
SHARE = 8
#: Rows of text in an Arrow batch; batches are further cut by bytes in Python.
TEXT_ROWS = 512
#: A null doc_id sorts before every other.
NULL_ID = -(2**63)
WORD = rb"[^\x20\x09-\x0d]+"

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; on one machine, where that is unset, a folder of it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidewright-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table."""
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def _discard_all() -> None:
    while _made:
        spark, path = _made.pop()
        try:
            discard(spark, path)
        except Exception:  # the session may have ended already; the folder is a scratch one
            return


atexit.register(_discard_all)


class Staged:
    """A table written to the shared folder, which cuts lineage and survives lost executors."""

    def __init__(self, df: DataFrame, tag: str):
        self.spark = df.sparkSession
        self.path = f"{shared_dir(self.spark)}/tidewright/{tag}-{uuid.uuid4().hex}"
        _made.append((self.spark, self.path))
        clean = "spark.sql.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(clean, "false")
        self.spark.conf.set(clean, "true")  # what was shuffled for this table is of no further use
        try:
            df.write.option("compression", "zstd").parquet(self.path)
        finally:
            self.spark.conf.set(clean, before)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        discard(self.spark, self.path)
        _made.remove((self.spark, self.path))


def text_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small; the setting belongs to the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))


def cut(table: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of the string column, one row at least."""
    size, start, total = table.num_rows, 0, 0
    lengths = pc.fill_null(pc.binary_length(table.column(column)), 0).to_pylist()
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield table.slice(start, i - start)
            start, total = i, 0
        total += n
    if size > start:
        yield table.slice(start)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices of about ``limit`` bytes of the string column: small batches are joined, long ones cut."""

    def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]

    held: list[pa.RecordBatch] = []
    size = 0
    for whole in batches:
        for b in cut(whole, column, limit):
            n = b.column(column).nbytes
            if held and size + n > limit:
                yield joined(held)
                held, size = [], 0
            held.append(b)
            size += n
    if held:
        yield joined(held)


def block_count(docs: DataFrame) -> int:
    """Blocks for a table: by the bytes of its texts, which are summed up, and no fewer than the shuffle partitions."""
    spark = docs.sparkSession
    size = docs.select(F.sum(F.octet_length(F.col("`text`").cast("string")))).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / int(spark.conf.get(BLOCK_CONF, str(BLOCK_BYTES)))))


def block_of(n: int, *keys: str) -> Column:
    return F.pmod(F.xxhash64(*(F.col(k) for k in keys)), F.lit(n)).cast("int")


def by_block(parts: list[DataFrame], n: int, order: list[str]) -> DataFrame:
    """Union of parts (equal schemas with an int column ``block``), block b in partition b, sorted within it."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.repartitionById(n, F.col("block")).sortWithinPartitions("block", *order)


def give_back() -> None:
    """Return to the system what a Python worker has freed: it lives on, and runs tasks of other kinds."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    text_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        give_back()

    return df.mapInArrow(run, schema)


def join_hot(left: DataFrame, right: DataFrame, key: str, n: str) -> DataFrame:
    """left joined to right, which has one row for each key and in ``n`` how many rows of left have it; without ``n``.

    Keys with more than a small share of all rows go by broadcast: at most SHARE for each shuffle partition can have so many. The
    others are joined by a shuffle, in which no key fills a task.
    """
    spark = left.sparkSession
    total, most = right.agg(F.sum(n), F.max(n)).first()
    limit = (total or 0) // (SHARE * int(spark.conf.get("spark.sql.shuffle.partitions"))) + 1
    if (most or 0) <= limit:
        return left.join(right.drop(n), key)
    hot, rest = F.broadcast(right.where(F.col(n) > limit).drop(n)), right.where(F.col(n) <= limit).drop(n)
    return left.join(hot, key).unionByName(left.join(hot.select(key), key, "left_anti").join(rest, key))


def folded(docs: DataFrame) -> DataFrame:
    """All columns in one struct ``row``, whatever their names."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def unfolded(batch: pa.RecordBatch) -> pa.RecordBatch:
    row = batch.column("row")
    return pa.RecordBatch.from_arrays(row.flatten(), names=[f.name for f in row.type])


def refolded(batch: pa.RecordBatch) -> pa.StructArray:
    return pa.StructArray.from_arrays(batch.columns, fields=list(batch.schema))


def columns(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns only, so that extra columns of any name cannot clash with ours."""
    kinds = {"doc_id": "long", "n_chars": "long", "page_id": "long"}
    return docs.select(*(F.col(f"`{c}`").cast(kinds.get(c, "string")).alias(c) for c in names))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
