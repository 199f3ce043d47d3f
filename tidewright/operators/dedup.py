"""Duplicate records by key fingerprint, with survivorship: the first record in input order keeps, and learns from its duplicates.

Groups are aggregated: map-side minima and maxima combine before the shuffle, so a hot key (placeholders make some) costs no
more than its tasks' partial rows. Their results go back to the records by a join on the key and a salt: the records of a hot key
are dealt to SALTS tasks, and only keys with more than one record are on the other side, once for each salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import values
from ..config import Config
from ..functions.text import let, strip
from .clean import LINE, fields_of

#: Tasks that the records of one key are dealt to.
SALTS = 16
_LABELS = {"email_only": "email", "phone_only": "phone"}
GAVE = "struct<filled:int,updated:int>"


def _value(df: DataFrame, field: str, cfg: Config) -> Column | None:
    """The field for comparison: the clean value, else the raw one, stripped and in lower case; None if there is no such field."""
    parts = []
    if field in fields_of(df, "clean"):
        c = F.col("clean")[field].cast("string")
        parts.append(F.nullif(c, F.lit("")) if cfg.placeholder_in_key else F.when(c.isin("", cfg.placeholder), None).otherwise(c))
    if field in fields_of(df, "raw"):
        parts.append(F.nullif(F.col("raw")[field].cast("string"), F.lit("")))
    return let(F.lower(strip(F.coalesce(*parts))), lambda v: F.when(v != "", v)) if parts else None


def key(df: DataFrame, cfg: Config) -> Column:
    """The key's text: labelled fields in order of their names; the row id where no field has a value."""
    fallback = F.concat(F.lit("row_id:"), F.col("row_id"))
    if cfg.strategy in _LABELS:
        names = [_LABELS[cfg.strategy]]
    elif cfg.strategy == "all_fields":
        names = sorted(f for f in fields_of(df, "clean") if f != LINE)
        parts = [F.concat(F.lit(f"{n}:"), F.lower(strip(F.col("clean")[n].cast("string")))) for n in names]
        return F.coalesce(F.nullif(F.concat_ws("|", *parts), F.lit("")), fallback)
    else:  # composite, and whatever else was asked for
        names = sorted(cfg.dedup_fields)
    found = [(n, _value(df, n, cfg)) for n in names]
    parts = [F.concat(F.lit(f"{n}:"), v) for n, v in found if v is not None]
    return let(F.concat_ws("|", *parts), lambda v: F.when(v != "", v).otherwise(fallback)) if parts else fallback


def record_date(df: DataFrame) -> Column:
    """The first date field that parses: ISO in the first ten characters, or month/day/year."""
    have = fields_of(df, "clean")
    dates = []
    for f in values.DATE_FIELDS:
        if f in have:
            c = F.col("clean")[f].cast("string")
            dates += [F.to_date(F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd"))), F.to_date(F.try_to_timestamp(c, F.lit("M/d/yyyy")))]
    return F.coalesce(*dates) if dates else F.lit(None).cast("date")


def _salted(df: DataFrame, groups: DataFrame) -> DataFrame:
    """df with the columns of ``groups``, a row for each fingerprint that has one; null for others."""
    salt = F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int")
    each = groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("__salt", salt).join(each, ["fingerprint", "__salt"], "left").drop("__salt")


def mark(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Adds fingerprint, is_duplicate and duplicate_of (the keeper's row_id)."""
    if not cfg.dedup or cfg.strategy == "disabled":
        return df.withColumns({"fingerprint": F.lit(None).cast("string"), "is_duplicate": F.lit(False), "duplicate_of": F.lit(None).cast("string")})
    # never null, and known to be: else a join would push the whole expression down into a filter once more
    keyed = df.withColumn("fingerprint", F.coalesce(F.sha2(key(df, cfg), 256), F.lit("")))
    first = keyed.groupBy("fingerprint").agg(F.min(F.struct(LINE, "row_id")).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    joined = _salted(keyed, first).select(*keyed.columns, "first")
    again = F.coalesce(F.col("row_id") != F.col("first.row_id"), F.lit(False))
    return joined.withColumns({"is_duplicate": again, "duplicate_of": F.when(again, F.col("first.row_id"))}).drop("first")


def enrich(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Keepers' clean values with gaps filled by their duplicates, and mutable fields taken from newer ones.

    ``df`` is marked. Of newer duplicates the last in input order wins; gaps take the first value in input order. Fields that are
    double have a gap only where null, and zero is no value of a duplicate. all_fields has nothing to add, and is left alone.

    ``gave`` is added: of a duplicate, how many gaps of its keeper it filled and how many values it was newer for; null for others.

    One pass gathers, for each key and date, the first and last values in input order (both combine before the shuffle); a
    keeper then takes its gaps from the first of all and its updates from the dates after its own. A key has as many dates as
    its records have days.
    """
    if not cfg.dedup or cfg.strategy in ("disabled", "all_fields"):
        return df.withColumn("gave", F.lit(None).cast(GAVE))
    kinds = {f.name: f.dataType.simpleString() for f in df.schema["clean"].dataType.fields}
    names = list(kinds)
    mutable = [n for n in names if n in values.MUTABLE]

    def said(n: str, updating: bool = False) -> Column:
        c = F.col("clean")[n]
        says = (c != 0) if kinds[n] == "double" else (c != "")
        if updating and not cfg.placeholder_overwrites and kinds[n] != "double":
            says = says & (c != cfg.placeholder)
        return F.when(says, F.struct(F.col(LINE).alias("line"), c.alias("v")))

    def own(n: str) -> Column:
        c = F.col("clean")[n]
        return c if kinds[n] == "double" else F.nullif(c, F.lit(""))

    dated = df.withColumn("__date", record_date(df))
    gaps = [F.bool_or(~F.col("is_duplicate") & own(n).isNull()).alias(f"e{i}") for i, n in enumerate(names)]
    firsts = [F.min(F.when(F.col("is_duplicate"), said(n))).alias(f"f{i}") for i, n in enumerate(names)]
    lasts = [F.max(F.when(F.col("is_duplicate"), said(n, True))).alias(f"u{i}") for i, n in enumerate(mutable)]
    by_date = dated.groupBy("fingerprint", "__date").agg(*firsts, *gaps, *lasts, F.max(~F.col("is_duplicate")).alias("own"), F.max("is_duplicate").alias("others"))
    found = by_date.groupBy("fingerprint").agg(
        *(F.min(f"f{i}").alias(f"f{i}") for i in range(len(names))),
        *(F.bool_or(f"e{i}").alias(f"e{i}") for i in range(len(names))),
        F.max("others").alias("others"),
        F.max(F.when(F.col("own"), F.col("__date"))).alias("owner_date"),
        F.collect_list(F.when(F.col("__date").isNotNull(), F.struct(F.col("__date").alias("date"), *(F.col(f"u{i}") for i in range(len(mutable)))))).alias("dates"),
    )
    newer = F.filter("dates", lambda d: d["date"] > F.col("owner_date"))
    last = lambda i: F.array_max(F.transform(newer, lambda d: d[f"u{i}"]))
    found = found.where("others").select("fingerprint", "owner_date", *(f"{k}{i}" for k in "fe" for i in range(len(names))), *(last(i).alias(f"u{i}") for i in range(len(mutable))))
    out = []
    for i, n in enumerate(names):
        c = F.col("clean")[n]
        update = [F.col(f"u{mutable.index(n)}")["v"]] if n in mutable else []
        got = F.coalesce(*update, own(n), F.col(f"f{i}")["v"], c)
        out.append(F.when(F.col("is_duplicate"), c).otherwise(got).alias(n))
    fills = [F.coalesce(F.col(f"e{i}") & (F.col(f"f{i}")["line"] == F.col(LINE)), F.lit(False)) for i in range(len(names))]
    updates = [said(n, True).isNotNull() & F.coalesce(F.col("__date") > F.col("owner_date"), F.lit(False)) & ~fills[names.index(n)] for n in mutable]
    count = lambda cs: sum((c.cast("int") for c in cs), F.lit(0))
    gave = F.when(F.col("is_duplicate"), F.struct(count(fills).alias("filled"), count(updates).alias("updated"))).cast(GAVE)
    return _salted(dated, found).withColumns({"clean": let(F.struct(*out), lambda x: x), "gave": gave}).select(*df.columns, "gave")
