"""Output files. A single CSV is one task's work by nature; everything before it stays distributed."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as files
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..operators.clean import LINE


def write_csv(df: DataFrame, path: str, single: bool = True) -> str:
    """Header and rows, in input order where _line_number is there (and left out). ``single``: one file of that name, by way of a
    staging folder and a rename; else a folder of part files, each in order."""
    if LINE in df.columns:
        df = df.orderBy(F.col(LINE).asc_nulls_last()).drop(LINE)
    plain = df.select(*(F.col(f"`{c}`").cast("string").alias(c) if t not in ("string",) else F.col(f"`{c}`") for c, t in df.dtypes))
    writer = lambda d, to: d.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(to)
    if not single:
        writer(plain, path)
        return path
    stage = f"{path}.{uuid.uuid4().hex}"
    writer(plain.coalesce(1), stage)
    sc = df.sparkSession.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(stage).getFileSystem(sc._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(hadoop.Path(stage)) if s.getPath().getName().startswith("part-"))
    target = hadoop.Path(path)
    fs.delete(target, True)
    fs.rename(part, target)
    fs.delete(hadoop.Path(stage), True)
    return path


@dataclass
class _Written(WriterCommitMessage):
    pairs: list[tuple[str, str]]


class _FileWriter(DataSourceWriter):
    """Tasks write under a staging folder; files get their names once all tasks are done, so that a lost task leaves nothing."""

    def __init__(self, folder: str):
        self.folder, self.stage = folder, f"_stage-{uuid.uuid4().hex}"

    def _open(self) -> tuple[files.FileSystem, str]:
        return files.FileSystem.from_uri(self.folder)

    def write(self, iterator: Iterator) -> _Written:
        store, root = self._open()
        store.create_dir(f"{root}/{self.stage}")
        pairs = []
        for row in iterator:
            name = row["path"].rstrip("/").rsplit("/", 1)[-1]
            temp = f"{root}/{self.stage}/{uuid.uuid4().hex}"
            with store.open_output_stream(temp) as to:
                to.write(bytes(row["content"] or b""))
            pairs.append((temp, f"{root}/{name}"))
        return _Written(pairs)

    def commit(self, messages: list) -> None:
        store, root = self._open()
        for m in messages:
            for temp, path in m.pairs if m else []:
                store.move(temp, path)
        self.abort(messages)

    def abort(self, messages: list) -> None:
        store, root = self._open()
        if store.get_file_info(f"{root}/{self.stage}").type == files.FileType.Directory:
            store.delete_dir(f"{root}/{self.stage}")


class FilesSink(DataSource):
    """Rows (path, content) as files of a folder that driver and executors share; option path names it, a path or an URI."""

    @classmethod
    def name(cls):
        return "tidewright_files"

    def writer(self, schema, overwrite):
        return _FileWriter(self.options["path"])


def write_files(df: DataFrame, folder: str) -> None:
    """Each row's content under the last part of its path; files of that name are replaced, and two rows of one name are an error."""
    name = F.element_at(F.split(F.rtrim("path", F.lit("/")), "/"), -1)
    twice = df.groupBy(name.alias("name")).count().where("count > 1").head()
    if twice:
        raise ValueError(f"{twice['count']} files named {twice['name']}")
    df.sparkSession.dataSource.register(FilesSink)
    df.select("path", "content").write.format("tidewright_files").mode("append").option("path", folder).save()
