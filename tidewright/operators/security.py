"""The file gate: verdict rows instead of deletions, and neutral cells instead of formulas."""

from __future__ import annotations

import io
import zipfile
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import values
from ..config import Config


def neutralise(c: Column) -> Column:
    """A quote before cells that a spreadsheet would take for a formula."""
    return F.when(c.rlike(r"(?U)^\s*[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)


def neutralise_all(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All text cells and headers but ``keep`` made neutral."""
    text = {f.name for f in df.schema if f.dataType.simpleString() == "string"} - set(keep)
    header = lambda n: f"'{n}" if n.strip()[:1] in ("=", "+", "-", "@") and n not in keep else n
    return df.select(*((neutralise(F.col(f"`{c}`")) if c in text else F.col(f"`{c}`")).alias(header(c)) for c in df.columns))


def dangerous_cells(df: DataFrame, names: list[str]) -> DataFrame:
    """How many cells neutralise() changes."""
    bad = lambda c: F.coalesce(F.col(f"`{c}`").rlike(r"(?U)^\s*[=+\-@]"), F.lit(False)).cast("long")
    return df.agg(F.coalesce(F.sum(reduce(lambda a, b: a + b, map(bad, names))), F.lit(0)).alias("dangerous_cells"))


def first_byte_pattern(content: Column) -> Column:
    """The first of the known byte patterns that occurs, as text; null if none does."""
    return F.coalesce(*(F.when(F.contains(content, F.lit(p)), F.lit(p.decode("latin-1"))) for p in values.BYTE_PATTERNS))


def first_text_pattern(text: Column) -> Column:
    low = F.lower(text)
    return F.coalesce(*(F.when(low.contains(p.lower()), F.lit(p)) for p in values.TEXT_PATTERNS))


@F.pandas_udf(StringType())
def _zip_verdict(contents: pd.Series) -> pd.Series:
    """Null for a sound archive, else what is wrong: MACRO or BAD_ZIP."""

    def one(data):
        if data is None:
            return None
        try:
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                return "MACRO" if any(p in n.lower() for n in z.namelist() for p in values.MACRO_PARTS) else None
        except zipfile.BadZipFile:
            return "BAD_ZIP"

    return contents.map(one)


def verdicts(files: DataFrame, cfg: Config = Config()) -> DataFrame:
    """(path, length, sha256, verdict) of binary file rows; checks run in the gate's order and the first failure is the verdict."""
    content = F.col("content")
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1))
    magic = reduce(lambda w, s: w.when(ext == s[0], F.substring(content, 1, len(s[1])) == F.lit(s[1])), [*values.SIGNATURES.items()], F.when(F.lit(False), F.lit(False)))
    head = F.substring(content, 1, 8192)
    # as a reader of the first 8 KiB sees it: what comes later, and a character cut at the end, is not judged
    valid = reduce(lambda a, b: a | b, (F.is_valid_utf8(F.substring(content, 1, 8192 - k).cast("string")) for k in range(4)))
    text = F.make_valid_utf8(content.cast("string"))
    zipped = _zip_verdict(F.when(ext == ".docx", content))
    known = F.col("sha256").isin(*cfg.malicious_hashes) if cfg.malicious_hashes else F.lit(False)
    verdict = (
        F.when(F.col("length") > cfg.max_file_bytes, "FILE_SIZE_EXCEEDED")
        .when(ext.isin(values.HAZARDOUS_EXTENSIONS), "HAZARDOUS_FILE_DETECTED")
        .when(~ext.isin(values.ALLOWED_EXTENSIONS), "UNSUPPORTED_FILE_TYPE")
        .when((ext == ".csv") & (F.contains(head, F.lit(b"\x00")) | ~valid), "INVALID_FILE_SIGNATURE")
        .when(~F.coalesce(magic, F.lit(True)), "INVALID_FILE_SIGNATURE")
        .when(first_byte_pattern(content).isNotNull(), F.concat(F.lit("MALWARE_PATTERN_DETECTED: "), first_byte_pattern(content)))
        .when((ext == ".csv") & first_text_pattern(text).isNotNull(), F.concat(F.lit("DANGEROUS_PATTERN_DETECTED: "), first_text_pattern(text)))
        .when(zipped == "MACRO", "MACRO_DETECTED")
        .when(zipped == "BAD_ZIP", "INVALID_DOCX")
        .when(known, "KNOWN_THREAT_DETECTED")
        .otherwise("OK")
    )
    return files.withColumn("sha256", F.sha2(content, 256)).select("path", "length", "sha256", verdict.alias("verdict"))


def hashes(content: Column) -> dict[str, Column]:
    data = content.cast("binary")
    return {"md5": F.md5(data), "sha1": F.sha1(data), "sha256": F.sha2(data, 256)}


def blocked(files: DataFrame, blocklist: DataFrame) -> DataFrame:
    """Files whose SHA-256 is on a list; Spark broadcasts the list if its size allows."""
    return files.withColumn("sha256", F.sha2(F.col("content").cast("binary"), 256)).join(blocklist.select("sha256"), "sha256", "left_semi")
