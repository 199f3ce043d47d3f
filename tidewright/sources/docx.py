"""DOCX files: text blocks out, cleaned text back in. Archives are parsed where the bytes are, a batch of files at a time."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import write_files

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
BLOCKS = "path string, id int, type string, text string, metadata map<string,string>"
BATCH = 20


def _text(p: ET.Element) -> str:
    marks = {f"{_W}t": lambda e: e.text or "", f"{_W}tab": lambda e: "\t", f"{_W}br": lambda e: "\n", f"{_W}cr": lambda e: "\n"}
    return "".join(marks[e.tag](e) for e in p.iter() if e.tag in marks)


def _margins(z: zipfile.ZipFile, kind: str) -> list[str]:
    return sorted(n for n in z.namelist() if re.fullmatch(rf"word/{kind}\d*\.xml", n))


def blocks_of(content: bytes) -> list[tuple[int, str, str, dict[str, str]]]:
    """(id, type, text, metadata) of paragraphs and table cells in order, then headers and footers; blank ones are skipped."""
    out: list[tuple[int, str, str, dict[str, str]]] = []
    cells = 0

    def add(kind: str, text: str, meta: dict[str, str]) -> bool:
        if text.strip():
            out.append((len(out), kind, text.strip(), meta))
            return True
        return False

    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ET.fromstring(z.read("word/document.xml")).find(f"{_W}body")
        for e in body if body is not None else []:
            if e.tag == f"{_W}p":
                style = e.find(f"{_W}pPr/{_W}pStyle")
                add("paragraph", _text(e), {"style": style.get(f"{_W}val") if style is not None else "Normal"})
            elif e.tag == f"{_W}tbl":
                for r, row in enumerate(e.findall(f"{_W}tr")):
                    for c, cell in enumerate(row.findall(f"{_W}tc")):
                        text = "\n".join(_text(p) for p in cell.findall(f"{_W}p"))
                        cells += add("table_cell", text, {"row": str(r), "col": str(c), "table_index": str(cells)})
        for kind in ("header", "footer"):
            for name in _margins(z, kind):
                for p in ET.fromstring(z.read(name)).iter(f"{_W}p"):
                    add(kind, _text(p), {})
    return out


def read_blocks(files: DataFrame) -> DataFrame:
    """Blocks of binary file rows (path, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(path, *block) for path, content in zip(b["path"], b["content"]) for block in blocks_of(content)]
            yield pd.DataFrame(rows, columns=["path", "id", "type", "text", "metadata"])

    return files.select("path", "content").mapInPandas(run, BLOCKS)


def read_docx(spark: SparkSession, folder: str) -> DataFrame:
    return read_blocks(spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(folder))


def full_text(blocks: DataFrame) -> DataFrame:
    """(path, text): blocks of each file, one a line. A file's blocks fit a row, as the file did."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "text"))), lambda x: x["text"]), "\n")
    return blocks.groupBy("path").agg(joined.alias("text"))


def prompts(blocks: DataFrame, size: int = BATCH) -> DataFrame:
    """(path, batch, prompt): blocks in batches of ``size``."""
    line = F.concat(F.lit("[ID: "), F.col("id").cast("string"), F.lit("] "), F.col("text"))
    rows = blocks.select("path", F.floor(F.col("id") / size).cast("int").alias("batch"), "id", line.alias("line"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "line"))), lambda x: x["line"]), "\n")
    return rows.groupBy("path", "batch").agg(F.concat(F.lit("Clean these blocks; answer with a JSON array of objects with id and cleaned.\n"), joined).alias("prompt"))


def apply_replies(blocks: DataFrame, replies: DataFrame) -> DataFrame:
    """Blocks with ``cleaned``: what the replies (path, reply) say for their id, else the text as it was; replies that are no JSON array say nothing."""
    fenced = F.regexp_extract("reply", r"(?s)```(?:json)?\s*(\[.*?\])\s*```", 1)
    array = F.regexp_extract(F.when(fenced != "", fenced).otherwise(F.col("reply")), r"(?s)\[.*\]", 0)
    items = replies.select("path", F.explode(F.from_json(array, "array<struct<id:int,cleaned:string>>")).alias("x"))
    known = items.where("x.id is not null and x.cleaned is not null").groupBy("path", F.col("x.id").alias("id")).agg(F.max("x.cleaned").alias("cleaned"))
    return blocks.join(known, ["path", "id"], "left").withColumn("cleaned", F.coalesce("cleaned", "text"))


def _replace(p: ET.Element, text: str) -> None:
    """The first run keeps its looks and takes the text; the others are emptied."""
    runs = [t for t in p.iter(f"{_W}t")]
    for i, t in enumerate(runs):
        t.text = text if i == 0 else ""
        t.set("{http://www.w3.org/XML/1998/namespace}space", "preserve")


def rebuilt(content: bytes, cleaned: dict[str, str]) -> bytes:
    """The document with paragraphs replaced by trimmed text; everything else is copied."""
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as z, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as to:
        parts = {"word/document.xml", *_margins(z, "header"), *_margins(z, "footer")}
        for item in z.infolist():
            data = z.read(item.filename)
            if item.filename in parts:
                root = ET.fromstring(data)
                for p in root.iter(f"{_W}p"):
                    new = cleaned.get(_text(p).strip())
                    if new is not None:
                        _replace(p, new)
                data = ET.tostring(root, xml_declaration=True, encoding="UTF-8")
            to.writestr(item, data)
    return out.getvalue()


def rebuild(files: DataFrame, blocks: DataFrame) -> DataFrame:
    """(path, content): files with the cleaned text of their blocks; of equal texts the last block's version is taken."""
    per = blocks.groupBy("path", "text").agg(F.max_by("cleaned", "id").alias("cleaned")).groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("text", "cleaned"))).alias("cleaned"))

    @F.pandas_udf("binary")
    def made(content: pd.Series, cleaned: pd.Series) -> pd.Series:
        return pd.Series([rebuilt(c, dict(m or {})) for c, m in zip(content, cleaned)])

    return files.select("path", "content").join(per, "path", "left").select("path", made("content", "cleaned").alias("content"))


def clean_folder(spark: SparkSession, folder: str, out_dir: str, resolve: Callable[[list[str]], list[str]] | None = None) -> None:
    """The documents of a folder, cleaned, under their names in another."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.docx").load(folder)
    write_files(clean_documents(files, resolve), out_dir)


def clean_documents(files: DataFrame, resolve: Callable[[list[str]], list[str]] | None = None) -> DataFrame:
    """Files cleaned by a resolver of prompts; without one they come back as they are, text for text."""
    blocks = read_blocks(files)
    if resolve is None:
        return rebuild(files, blocks.withColumn("cleaned", F.col("text")))

    @F.pandas_udf("string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(resolve(s.tolist()))

    return rebuild(files, apply_replies(blocks, prompts(blocks).select("path", ask("prompt").alias("reply"))))
