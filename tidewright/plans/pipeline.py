"""A whole cleaning run, from a file to verified outputs: one lazy lineage, with actions only for typing, checks and writes."""

from __future__ import annotations

import tempfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import dedup, ledger, merge, score, security
from ..operators.clean import clean
from ..operators.infer import column_types
from ..operators.semantic import Resolver, repair
from ..sources.sinks import write_csv
from ..sources.tables import read_table


class RejectedFile(Exception):
    """The gate did not let the file pass."""


def records(df: DataFrame, cfg: Config = Config(), resolver: Resolver | None = None, types: dict[str, str] | None = None, until: str = "finish") -> DataFrame:
    """Text records with _line_number through cleaning, dedup, routing, repair and the last verdicts; ``until`` names the last step."""
    types = column_types(df) if types is None else types
    out = dedup.enrich(dedup.mark(clean(df, types, cfg), cfg), cfg)
    out = score.route(out, score.expected(types), cfg)
    if until == "route":
        return out
    out = repair(settled(out), resolver, cfg)
    return out if until == "repair" else merge.finish(out, cfg)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; on one machine, where that is unset, a folder of it."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not shared:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tidewright-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """The rows as a checkpoint in the shared folder: what follows reads them several times, and must not plan or compute all before it again."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def outputs(done: DataFrame, cfg: Config = Config()) -> tuple[DataFrame, DataFrame]:
    """The final and the rejected table, flat and in their column order, before pruning."""
    extras = merge.extra_keys(done) if cfg.preserve_all_fields else []
    return merge.flatten(done.where(F.col("status") == "CLEAN"), extras=extras), merge.flatten(done.where(F.col("status") == "REJECTED"), full=True, extras=extras)


@dataclass
class Result:
    final: DataFrame
    rejected: DataFrame
    ledger: DataFrame
    audit: DataFrame
    done: DataFrame


def run(spark: SparkSession, path: str, cfg: Config = Config(), resolver: Resolver | None = None, out_dir: str | None = None, gate: bool = True) -> Result:
    """Gate, read, clean, verify; with ``out_dir`` the three files of a run are written once everything is accounted for."""
    if gate:
        verdict = security.verdicts(spark.read.format("binaryFile").load(path), cfg).first()["verdict"]
        if verdict != "OK":
            if out_dir:
                write_csv(ledger.files_rejected(spark.createDataFrame([(path, verdict)], "path string, verdict string"), cfg.run_id), f"{out_dir}/rejection_cache_{cfg.run_id}.csv")
            raise RejectedFile(f"{path}: {verdict}")
    table = read_table(spark, path)
    table = security.neutralise_all(table)
    done = records(table, cfg, resolver).persist()  # read by the checks and by every output
    final, rejected = outputs(done, cfg)
    merge.verify(done.select("row_id"), done.where(F.col("status") == "CLEAN"), done.where(F.col("status") == "REJECTED"))
    gone = merge.empty_columns(final, cfg)
    final = merge.restore_integers(final.drop(*gone))
    rejected = merge.prune(rejected, cfg)
    book = ledger.values_rejected(done).unionByName(ledger.rows_rejected(done)).unionByName(ledger.columns_rejected(spark, cfg.run_id, gone, cfg.placeholder))
    asked = done.where(F.col("repair_event").isNotNull()).count()
    log = ledger.audit(done).unionByName(ledger.phases(spark, cfg.run_id, asked)).withColumn("timestamp", F.current_timestamp())
    if out_dir:
        write_csv(final, f"{out_dir}/final_output_{cfg.run_id}.csv")
        write_csv(book, f"{out_dir}/rejection_cache_{cfg.run_id}.csv")
        write_csv(log, f"{out_dir}/pipeline_log_{cfg.run_id}.csv")
    return Result(final, rejected, book, log, done)
