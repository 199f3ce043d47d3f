"""Confidence of a record, and where it goes: CLEAN, AI_REQUIRED or REJECTED."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import values
from ..config import Config
from ..functions.text import pin
from .clean import fields_of


def expected(types: dict[str, str]) -> list[str]:
    """Contact fields that the input has a column for."""
    return [k for k in ("email", "phone") if k in types.values()]


def _absent(df: DataFrame, field: str, cfg: Config) -> Column:
    if field not in fields_of(df, "clean"):
        return F.lit(True)
    c = F.col("clean")[field].cast("string")
    none = c.isNull() | (c == "")
    return none if cfg.placeholder_present else none | (c == cfg.placeholder)


def confidence(df: DataFrame, contacts: list[str], cfg: Config = Config()) -> Column:
    score = F.lit(1.0)
    for field, cost in (("email", 0.3), ("phone", 0.1)):
        if field in contacts:
            score = score - F.when(_absent(df, field, cfg), F.lit(cost)).otherwise(0.0)  # a sum: its text names the score so far once
    for f in fields_of(df, "details"):
        score = score - F.when(F.col("details")[f] == "INVALID", 0.5).otherwise(0.0)
    if "job_title" in fields_of(df, "clean"):
        job = F.col("clean")["job_title"]
        odd = job.rlike(r"[^\x00-\x7F]") | job.rlike(r"[/|]") | job.rlike(rf"(?i)\b({'|'.join(values.BUZZWORDS)})\b")
        score = score - F.when((job != "") & odd, 0.6).otherwise(0.0)
    return F.greatest(F.lit(0.0), score)


def route(df: DataFrame, contacts: list[str], cfg: Config = Config()) -> DataFrame:
    """Adds status, failure_reason and confidence_score. Duplicates are rejected with score 0."""
    score = confidence(df, contacts, cfg)
    lacking = F.lit(False)
    for field in contacts:
        lacking = lacking | _absent(df, field, cfg)
    fine = (F.col("__score") >= cfg.threshold) & ~F.col("__lacking")
    status, points = F.when(fine, "CLEAN").otherwise("AI_REQUIRED"), F.col("__score")
    if cfg.generic_mode:
        filled = sum((F.when(F.coalesce(F.col("clean")[f].cast("string"), F.lit("")) != "", 1).otherwise(0) for f in fields_of(df, "clean")), F.lit(0))
        wrong = F.lit(False)
        for f in fields_of(df, "details"):
            wrong = wrong | (F.col("details")[f] == "INVALID")
        generic = ~fine & (filled >= 3) & ~wrong
        status = F.when(fine | generic, "CLEAN").otherwise("AI_REQUIRED")
        points = F.when(generic, F.greatest(F.lit(cfg.threshold), points)).otherwise(points)
    out = df.withColumns({"__score": score, "__lacking": lacking})
    return out.withColumns(
        {
            "status": pin(F.when(F.col("is_duplicate"), "REJECTED").otherwise(status)),
            "failure_reason": pin(F.when(F.col("is_duplicate"), "DUPLICATE")),
            "confidence_score": pin(F.when(F.col("is_duplicate"), 0.0).otherwise(points)),
        }
    ).drop("__score", "__lacking")
