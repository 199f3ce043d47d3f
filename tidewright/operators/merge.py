"""Merge and verify: every input row ends in exactly one output, which is then flattened, ordered and pruned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import values
from ..config import Config
from ..functions.text import pin, strip
from .clean import LINE, fields_of


class VerificationError(Exception):
    """Outputs do not account for the input."""


def finish(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Clean rows without both names become EMPTY_NAME rejects, rows without a verdict UNFINISHED_PROCESSING."""
    names = fields_of(df, "clean")
    nameless = F.lit(False)
    if "first_name" in names and "last_name" in names:
        no = lambda c: F.coalesce(c, F.lit("")).isin("", cfg.placeholder)
        nameless = (F.col("status") == "CLEAN") & no(F.col("clean")["first_name"]) & no(F.col("clean")["last_name"])
    open_ = ~F.col("status").isin("CLEAN", "REJECTED")
    reason = F.when(nameless, "EMPTY_NAME").when(open_, "UNFINISHED_PROCESSING").otherwise(F.col("failure_reason"))
    return df.withColumns({"failure_reason": pin(reason), "status": pin(F.when(nameless | open_, "REJECTED").otherwise(F.col("status")))})


def conservation(inputs: DataFrame, final: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row of counts: rows in, final and rejected, and ids that overlap, are missing, or come from nowhere."""
    ids = inputs.select("row_id", F.lit(1).alias("i"), F.lit(0).alias("f"), F.lit(0).alias("r"))
    ids = ids.unionByName(final.select("row_id", F.lit(0).alias("i"), F.lit(1).alias("f"), F.lit(0).alias("r"))).unionByName(rejected.select("row_id", F.lit(0).alias("i"), F.lit(0).alias("f"), F.lit(1).alias("r")))
    per = ids.groupBy("row_id").agg(*(F.sum(c).alias(c) for c in "ifr"))
    count = lambda cond: F.count_if(cond)
    return per.agg(
        F.coalesce(F.sum("i"), F.lit(0)).alias("n_input"),
        F.coalesce(F.sum("f"), F.lit(0)).alias("n_final"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("n_rejected"),
        count((F.col("f") > 0) & (F.col("r") > 0)).alias("n_overlap"),
        count((F.col("i") > 0) & (F.col("f") + F.col("r") == 0)).alias("n_missing"),
        count((F.col("i") == 0) & (F.col("f") + F.col("r") > 0)).alias("n_ghost"),
    )


def verify(inputs: DataFrame, final: DataFrame, rejected: DataFrame) -> None:
    c = conservation(inputs, final, rejected).first()
    if c["n_input"] != c["n_final"] + c["n_rejected"]:
        raise VerificationError(f"{c['n_input']} rows in, {c['n_final']} + {c['n_rejected']} out")
    for name, what in (("n_overlap", "in both outputs"), ("n_missing", "missing"), ("n_ghost", "from nowhere")):
        if c[name]:
            raise VerificationError(f"{c[name]} rows {what}")


def ordered(names: list[str]) -> list[str]:
    """Row id, other ids (short names first), known fields, the rest by name, raw columns last."""
    ids = sorted((n for n in names if n.lower().strip() in values.ID_COLUMNS), key=len)
    first = [n for n in ["row_id", *ids, *values.FIRST_COLUMNS] if n in names]
    rest = [n for n in names if n not in first]
    return first + sorted(n for n in rest if not n.startswith("raw_")) + sorted(n for n in rest if n.startswith("raw_"))


def extra_keys(df: DataFrame) -> list[str]:
    """Keys that repair added to any record, by one aggregation; they become columns of the outputs."""
    if "extras" not in df.columns:
        return []
    return sorted(r["k"] for r in df.select(F.explode(F.map_keys("extras")).alias("k")).distinct().collect())


def flatten(df: DataFrame, full: bool = False, extras: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Columns of the output file, rows in input order kept by _line_number: the id, clean values and ``extras``, or (``full``) all there is."""
    meta = ["row_id", "run_id", "status", "confidence_score", "failure_reason"] if full else ["row_id"]
    cols: dict[str, Column] = {m: F.col(m) for m in meta}
    for n in fields_of(df, "clean"):
        cols[f"{n}_original" if n in values.RESERVED else n] = F.col("clean")[n]
    cols |= {n: F.col("extras")[n] for n in extras if n not in cols and n != LINE}
    if full:
        cols |= {f"raw_{n}": F.col("raw")[n] for n in fields_of(df, "raw")}
    for n in [c for c in cols if c.endswith("_original")]:
        if n[: -len("_original")] not in cols:
            cols = {(k[: -len("_original")] if k == n else k): v for k, v in cols.items()}
    if "job_title" in cols:
        cols.pop("position", None)
    names = ordered(list(cols))
    return df.select(*(cols[n].alias("position" if n == "job_title" else n) for n in names), F.col(LINE))


def says_something(c: Column, placeholder: str = values.PLACEHOLDER) -> Column:
    s = strip(c.cast("string"))
    return F.coalesce((s != "") & ~F.lower(s).isin("nan", "none") & (s != placeholder), F.lit(False))


def empty_columns(df: DataFrame, cfg: Config = Config()) -> list[str]:
    """Columns in which no row says anything, by one aggregation."""
    names = [c for c in df.columns if c != LINE]
    got = df.agg(*(F.bool_or(says_something(F.col(f"`{c}`"), cfg.placeholder)).alias(f"c{i}") for i, c in enumerate(names))).first()
    return [c for i, c in enumerate(names) if not got[i]]


def whole_columns(df: DataFrame) -> list[str]:
    """Double columns that hold whole numbers only, by one aggregation."""
    names = [f.name for f in df.schema if f.dataType.simpleString() in ("double", "float")]
    if not names:
        return []
    got = df.agg(*(F.bool_and(F.col(f"`{c}`") == F.floor(F.col(f"`{c}`"))).alias(f"c{i}") for i, c in enumerate(names))).first()
    return [c for i, c in enumerate(names) if got[i]]


def prune(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    return df.drop(*empty_columns(df, cfg))


def restore_integers(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(f"`{c}`").cast("long") for c in whole_columns(df) if c != "confidence_score"})
