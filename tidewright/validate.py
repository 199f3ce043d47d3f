"""python -m tidewright.validate --input FILE.csv --rules FILE.txt [--output FILE.csv]: rows that pass every rule."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from .operators import rules
from .operators.clean import LINE
from .sources.sinks import write_csv
from .sources.tables import InputError, with_lines


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--input", required=True)
    p.add_argument("--rules", required=True)
    p.add_argument("--output")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("validate").getOrCreate()
    try:
        with open(a.rules, encoding="utf-8") as f:
            found = rules.parse(f.read())
        df = with_lines(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(a.input))
        for r in rules.drop_counts(df, found).orderBy("rule_no").collect():
            print(f"{r['rule']}: {r['dropped']} rows dropped")
        print("written:", write_csv(rules.apply(df, found), a.output or os.path.join(os.path.dirname(a.input), "valid_leads.csv")))
    except (OSError, ValueError, InputError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
