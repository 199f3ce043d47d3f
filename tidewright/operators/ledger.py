"""What a run rejected and what it did, as event tables written once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import is_missing
from ..functions.text import strip
from .clean import fields_of

LEDGER = "run_id string, type string, item_id string, reason string, details string"
AUDIT = "run_id string, row_id string, phase string, action string, before string, after string, reason string, confidence string"


def _entry(run: Column, kind: str, item: Column, reason: Column, **details: Column) -> list[Column]:
    return [run.alias("run_id"), F.lit(kind).alias("type"), item.alias("item_id"), reason.alias("reason"), F.to_json(F.struct(*(v.alias(k) for k, v in details.items()))).alias("details")]


def values_rejected(df: DataFrame) -> DataFrame:
    """One row for each raw value that was missing and got another text, or did not pass its normaliser."""
    typed = set(fields_of(df, "details"))
    cleaned = set(fields_of(df, "clean"))
    found = []
    for n in fields_of(df, "raw"):
        if n not in cleaned:
            continue
        raw, new = F.col("raw")[n], F.col("clean")[n].cast("string")
        shown = F.coalesce(raw, F.lit("nan"))
        changed = is_missing(raw) & (strip(shown) != strip(F.coalesce(new, F.lit("None"))))
        entry = lambda reason: F.struct(F.lit(n).alias("field"), shown.alias("original"), F.coalesce(new, F.lit("None")).alias("new"), F.lit(reason).alias("reason"))  # noqa: B023, E731
        found.append(F.when(changed, entry("MISSING")))
        if n in typed:
            found.append(F.when(F.col("details")[n].isin("INVALID", "ERROR"), entry("INVALID")))
    if not found:
        return df.sparkSession.createDataFrame([], LEDGER)
    rows = df.select("run_id", "row_id", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("v"))
    return rows.select(*_entry(F.col("run_id"), "VALUE_REJECTED", F.concat_ws(":", "row_id", "v.field"), F.col("v.reason"), row_id=F.col("row_id"), field=F.col("v.field"), original=F.col("v.original"), new=F.col("v.new")))


def rows_rejected(df: DataFrame) -> DataFrame:
    """One row for each rejected record, with its clean values."""
    return df.where(F.col("status") == "REJECTED").select(*_entry(F.col("run_id"), "ROW_REJECTED", F.col("row_id"), F.coalesce("failure_reason", F.lit("Unknown")), status=F.col("status"), confidence_score=F.col("confidence_score"), clean=F.col("clean")))


def columns_rejected(spark: SparkSession, run_id: str, names: list[str], placeholder: str) -> DataFrame:
    rows = [(run_id, "COLUMN_REJECTED", n, f"Entirely empty or {placeholder}", f'{{"column": "{n}"}}') for n in names]
    return spark.createDataFrame(rows, LEDGER)


def files_rejected(verdicts: DataFrame, run_id: str) -> DataFrame:
    bad = verdicts.where(F.col("verdict") != "OK")
    return bad.select(*_entry(F.lit(run_id), "FILE_REJECTED_SECURITY", F.col("path"), F.col("verdict"), filename=F.col("path"), action=F.lit("REPORTED")))


def audit(df: DataFrame) -> DataFrame:
    """Row events of a finished frame, in one pass and without personal data: what was before and after is left to fingerprints."""
    none = F.lit(None).cast("string")

    def event(when: Column, phase: str, action: Column, reason: Column = none, confidence: Column = none, before: Column = none, row: str = "row_id") -> Column:
        made = F.struct(F.col(row).alias("row_id"), F.lit(phase).alias("phase"), action.alias("action"), before.alias("before"), none.alias("after"), reason.alias("reason"), confidence.cast("string").alias("confidence"))
        return F.when(when, made)

    found = [
        event(F.lit(True), "PHASE_1", F.lit("ROW_PROCESSED")),
        event(F.col("is_duplicate"), "PHASE_1", F.lit("DUPLICATE_DETECTED"), F.concat(F.lit("duplicate of "), F.col("duplicate_of")), before=F.col("fingerprint")),
        event(F.col("failure_reason") == "EMPTY_NAME", "PHASE_3", F.lit("EMPTY_NAME_REJECTION")),
    ]
    if "gave" in df.columns:  # events of the keeper, one for each duplicate that gave something
        for action, n, what in (("ROW_ENRICHED", "filled", "gaps filled by duplicate "), ("ROW_UPDATED_FROM_NEWER", "updated", "values of newer duplicate ")):
            reason = F.concat(F.col("gave")[n].cast("string"), F.lit(" " + what), F.col("row_id"))
            found.append(event(F.col("gave")[n] > 0, "PHASE_1", F.lit(action), reason, row="duplicate_of"))
    if "repair_event" in df.columns:
        done = F.col("repair_event") == "ROW_RESOLVED"
        found.append(event(F.col("repair_event").isNotNull(), "PHASE_2", F.col("repair_event"), confidence=F.when(done, F.col("confidence_score"))))
    return df.select("run_id", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("v")).select("run_id", "v.*")


def phases(spark: SparkSession, run_id: str, to_repair: int) -> DataFrame:
    """Events of the run itself: each phase's start and end; repair is skipped where no record needs it."""
    middle = [("PHASE_2", "START", f"{to_repair} rows"), ("PHASE_2", "COMPLETE", None)] if to_repair else [("PHASE_2", "SKIP", "no rows need repair")]
    events = [("PHASE_1", "START", None), ("PHASE_1", "COMPLETE", None), *middle, ("PHASE_3", "START", None), ("PHASE_3", "COMPLETE", None)]
    return spark.createDataFrame([(run_id, None, p, a, None, None, r, None) for p, a, r in events], AUDIT)
