"""Deterministic cleaning: sanitise every column, normalise the typed ones, keep the raw values beside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import values
from ..config import Config
from ..functions import normalize as N
from ..functions.missing import is_missing, sanitize
from ..functions.text import let, row_uuid

LINE = "_line_number"


def normalizer(kind: str, c: Column, name: str, cfg: Config) -> Column:
    """struct(value, status, reason) of a typed column; values of currency are doubles."""
    if kind == "currency":
        judged = lambda v: F.struct(v.alias("value"), F.when(v.isNull(), "ERROR").otherwise("VALID").alias("status"), F.when(v.isNull(), "Currency parse failed").alias("reason"))
        return let(N.currency(c, cfg.thousands_cut), judged)
    made = {
        "email": lambda: N.email(c, cfg.strip_cjk),
        "phone": lambda: N.phone(c, cfg.placeholder, cfg.strip_cjk),
        "first_name": lambda: N.name(c, "first_name", cfg.greedy_honorifics, cfg.strip_cjk),
        "last_name": lambda: N.name(c, "last_name", cfg.greedy_honorifics, cfg.strip_cjk),
        "job_title": lambda: N.job_title(c, cfg.strip_cjk),
        "company": lambda: N.company(c),
        "date": lambda: N.date(c),
    }
    return made[kind]()


def clean(df: DataFrame, types: dict[str, str], cfg: Config = Config()) -> DataFrame:
    """Columns row_id, run_id, _line_number, raw (struct), clean (struct), details (struct of statuses).

    ``df`` has text columns and _line_number. A typed value replaces the sanitised one where it is not null, and is written under
    its canonical name too; of several columns of a type the last one that has a value wins.
    """
    names = [c for c in df.columns if c != LINE]
    col = lambda c: F.col(f"`{c}`")
    results: dict[str, Column] = {}
    staged = df
    for i, c in enumerate(names):
        if c in types:
            kind = types[c]
            none = F.struct(F.lit(None).cast("double" if kind == "currency" else "string").alias("value"), F.lit("MISSING").alias("status"), F.lit("Missing value").alias("reason"))
            staged = staged.withColumn(f"__n{i}", F.when(is_missing(col(c)), none).otherwise(normalizer(kind, col(c), c, cfg)))
            results[c] = F.col(f"__n{i}")
    fields: dict[str, Column] = {}
    for c in names:
        plain = sanitize(col(c), c, cfg.placeholder, cfg.strip_cjk)
        if c not in results:
            fields[c] = plain
        elif types[c] == "currency":
            fields[c] = results[c]["value"]
        else:
            fields[c] = F.coalesce(results[c]["value"], plain)
    for kind in values.CANONICAL:
        found = [results[c]["value"] for c in names if types.get(c) == kind]
        if found and any(types.get(c) == kind and c != kind for c in names):
            own = [fields[kind]] if kind in fields else []
            fields[kind] = F.coalesce(*reversed(found), *own)
    line = F.col(LINE).cast("long")
    return staged.select(
        row_uuid(cfg.run_id, line).alias("row_id"),
        F.lit(cfg.run_id).alias("run_id"),
        line.alias(LINE),
        F.struct(*(col(c).alias(c) for c in names)).alias("raw"),
        let(F.struct(*(e.alias(n) for n, e in fields.items())), lambda x: x).alias("clean"),
        F.struct(*(results[c]["status"].alias(c) for c in results), F.lit(True).alias("__")).alias("details"),
    )


def fields_of(df: DataFrame, column: str) -> list[str]:
    return [f for f in df.schema[column].dataType.names if f != "__"]
