"""python -m tidewright FILE [OUT_DIR] [--health-check]: a cleaning run, or its health report only."""

from __future__ import annotations

import argparse
import sys
import uuid

from pyspark.sql import SparkSession

from .config import Config
from .plans import pipeline, report


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("input")
    p.add_argument("output", nargs="?", default="output")
    p.add_argument("--health-check", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("tidewright").getOrCreate()
    try:
        if a.health_check:
            table = pipeline.read_table(spark, a.input)
            report.health(pipeline.records(pipeline.security.neutralise_all(table), until="route")).show(truncate=False)
        else:
            cfg = Config(run_id=uuid.uuid4().hex[:12])
            report.health(pipeline.run(spark, a.input, cfg, out_dir=a.output).done).show(truncate=False)
    except Exception as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
