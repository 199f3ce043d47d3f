"""Tabular inputs as text columns with _line_number: CSV, SQLite, and what a run left behind."""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .. import values
from ..operators.clean import LINE
from ..operators.infer import bad_header, header_row, normal_header, unique_names


class InputError(Exception):
    """The input cannot be read as a table."""


def with_lines(df: DataFrame, start: int = 1) -> DataFrame:
    """Rows numbered in input order without a global sort: rows of each partition are counted, then numbered from where the last ended."""
    spark = df.sparkSession
    part = df.select("*", F.spark_partition_id().alias("__p"), F.monotonically_increasing_id().alias("__m"))
    counts = sorted((r["__p"], r["n"]) for r in part.groupBy("__p").agg(F.count("*").alias("n")).collect())  # a row for a partition
    at, base = start, []
    for p, n in counts:
        base.append((p, at))
        at += n
    if not base:
        return df.withColumn(LINE, F.lit(0).cast("long"))
    small = spark.createDataFrame(base, "__b int, __at long")
    numbered = part.join(F.broadcast(small), part["__p"] == small["__b"])
    return numbered.withColumn(LINE, F.col("__at") + F.col("__m").bitwiseAND((1 << 33) - 1)).drop("__p", "__m", "__b", "__at")


def _raw_csv(spark: SparkSession, path: str, width: int) -> DataFrame:
    schema = ", ".join(f"c{i} string" for i in range(width))
    return spark.read.schema(schema).option("multiLine", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def read_csv(spark: SparkSession, path: str, nulls: bool = True) -> DataFrame:
    """All columns as text, headers trimmed, lower-cased and made unique. A bad header line gives way to the first of the next ten
    lines that is one. ``nulls``: the usual null words of CSV readers become null."""
    try:
        probe = spark.read.option("multiLine", True).option("escape", '"').csv(path)
        width = len(probe.columns)
        raw = _raw_csv(spark, path, width)
        head = [[r[i] for i in range(width)] for r in raw.head(11)]  # in the order of partitions, as lines are numbered
    except Exception as e:
        raise InputError(f"cannot read {path}: {e}") from e
    if not head:
        raise InputError(f"{path} is empty")
    first, names = 0, [x or "" for x in head[0]]
    if bad_header(names):
        found = header_row(head[1:])
        if found is not None:
            first, names = found + 1, [x or "" for x in head[found + 1]]
    names = unique_names([normal_header(n) or f"unnamed:_{i}" for i, n in enumerate(names)])
    # one file is one task's work, and needs no count to be numbered
    lined = raw.withColumn(LINE, F.monotonically_increasing_id() + 1) if raw.rdd.getNumPartitions() == 1 else with_lines(raw)
    rows = lined.where(F.col(LINE) > first + 1)
    value = lambda c: F.when(F.col(c).isin(values.CSV_NULLS), None).otherwise(F.col(c)) if nulls else F.col(c)
    return rows.select(*(value(f"c{i}").alias(n) for i, n in enumerate(names)), (F.col(LINE) - (first + 1)).alias(LINE))


class _SqliteRange(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _SqliteReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema, self.path, self.table = schema, options["path"], options["table"]
        self.parts = int(options.get("partitions", "4"))

    def partitions(self):
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            try:
                low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_quoted(self.table)}").fetchone()
            except sqlite3.OperationalError:  # a table WITHOUT ROWID: one range, in the order of its key
                return [_SqliteRange(None, None)]
        if low is None:
            return [_SqliteRange(0, 0)]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_SqliteRange(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, partition) -> Iterator[tuple]:
        names = [f.name for f in self.schema.fields if f.name != LINE]
        columns = ", ".join(_quoted(n) for n in names)
        with sqlite3.connect(f"file:{self.path}?mode=ro", uri=True) as db:
            if partition.low is None:
                found = ((i, *row) for i, row in enumerate(db.execute(f"SELECT {columns} FROM {_quoted(self.table)}"), 1))
            else:
                found = db.execute(f"SELECT rowid, {columns} FROM {_quoted(self.table)} WHERE rowid >= ? AND rowid < ? ORDER BY rowid", (partition.low, partition.high))
            for row in found:
                yield (*(None if x is None else str(x) for x in row[1:]), row[0])


class SqliteSource(DataSource):
    """A table of a SQLite file in rowid ranges; options path, table and partitions. The file must be readable where tasks run."""

    @classmethod
    def name(cls):
        return "sqlite_table"

    def schema(self):
        with sqlite3.connect(f"file:{self.options['path']}?mode=ro", uri=True) as db:
            info = db.execute(f"PRAGMA table_info({_quoted(self.options['table'])})").fetchall()
        return ", ".join([f"`{r[1]}` string" for r in info] + [f"{LINE} long"])

    def reader(self, schema):
        return _SqliteReader(schema, self.options)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def sqlite_tables(path: str) -> list[str]:
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        return [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' AND name NOT LIKE 'sqlite_%' ORDER BY name")]


def read_sqlite(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """The only user table, or the named one."""
    try:
        tables = sqlite_tables(path)
    except sqlite3.DatabaseError as e:
        raise InputError(f"cannot read {path}: {e}") from e
    if not tables:
        raise InputError(f"{path} has no table")
    if table is None and len(tables) > 1:
        raise InputError(f"{path} has several tables, name one: {', '.join(tables)}")
    table = table or tables[0]
    if table not in tables:
        raise InputError(f"{path} has no table {table}")
    spark.dataSource.register(SqliteSource)
    df = spark.read.format("sqlite_table").option("path", path).option("table", table).load()
    names = unique_names([normal_header(c) for c in df.columns if c != LINE])
    return df.toDF(*names, LINE)


def read_table(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """By extension: .csv, .db or .sqlite."""
    ext = os.path.splitext(path)[1].lower()
    if ext not in (".csv", ".db", ".sqlite"):
        raise InputError(f"no reader for {ext or 'files without extension'}")
    if "://" not in path and not os.path.exists(path):
        raise InputError(f"no file {path}")
    return read_csv(spark, path) if ext == ".csv" else read_sqlite(spark, path, table)


def latest_run(spark: SparkSession, folder: str) -> str | None:
    """The run id of the newest final output in a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "final_output_*.csv").load(folder).select("path", "modificationTime")
    got = files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("p")).first()["p"]
    return None if got is None else got.rsplit("/", 1)[1][len("final_output_") : -len(".csv")]
