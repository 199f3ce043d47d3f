"""Reports on a run."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import LINE


def health(df: DataFrame) -> DataFrame:
    """One row: totals by status, their shares (null for no rows), and whether over half of the rows need repair."""
    n = F.count("*")
    share = lambda s: F.count_if(F.col("status") == s) / F.nullif(n, F.lit(0))
    counted = df.agg(n.alias("total"), *(F.count_if(F.col("status") == s).alias(k) for s, k in (("CLEAN", "clean"), ("AI_REQUIRED", "ai_required"), ("REJECTED", "rejected"))), *(share(s).alias(f"{k}_ratio") for s, k in (("CLEAN", "clean"), ("AI_REQUIRED", "ai"), ("REJECTED", "rejected"))))
    return counted.withColumn("warn", F.coalesce(F.col("ai_ratio") > 0.5, F.lit(False)))


def first_repairs(df: DataFrame, n: int = 5) -> DataFrame:
    return df.where(F.col("status") == "AI_REQUIRED").orderBy(LINE).limit(n)


def action_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("action").agg(F.count("*").alias("n"))


def _rows(spark: SparkSession, path: str) -> DataFrame | None:
    """A run's file as text columns, or None if it is not there."""
    try:
        return spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def analyze(spark: SparkSession, folder: str, run_id: str) -> dict | None:
    """Shape, columns, first rows, action counts and rejection counts of a run's files; None without a final file, no counts without the others."""
    final, log, book = (_rows(spark, f"{folder}/{name}_{run_id}.csv") for name in ("final_output", "pipeline_log", "rejection_cache"))
    if final is None:
        return None
    actions = {r["action"]: r["n"] for r in action_counts(log).collect()} if log is not None else {}
    rejected = {r["type"]: r["n"] for r in book.groupBy("type").agg(F.count("*").alias("n")).collect()} if book is not None else {}
    return {"rows": final.count(), "columns": final.columns, "head": [r.asDict() for r in final.head(10)], "enriched": actions.get("ROW_ENRICHED", 0), "resolved": actions.get("ROW_RESOLVED", 0), "actions": actions, "rejected": rejected}
