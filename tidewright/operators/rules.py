"""Row rules in text: ``Column[name] == True | Valid | "a" | "a" OR "b"``, one a line, # for comments."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import values
from ..functions.text import strip

_RULE = re.compile(r"^column\[([^\]]+)\]\s*==\s*(.+)$", re.I)
_QUOTED = re.compile(r'"([^"]*)"')


@dataclass(frozen=True)
class Rule:
    column: str
    check: str  # exists, phone, email, one_of
    options: tuple[str, ...] = ()
    line: str = ""


def parse(text: str) -> list[Rule]:
    """Rules of a rule file's text; a line that is none raises ValueError with its number."""
    out = []
    for number, raw in enumerate(text.splitlines(), 1):
        line = raw.strip()
        if not line or line.startswith("#"):
            continue
        m = _RULE.match(line)
        if not m:
            raise ValueError(f"line {number}: not a rule: {line}")
        name, value = m[1].strip(), m[2].strip()
        if value.lower() == "true":
            out.append(Rule(name, "exists", (), line))
        elif value.lower() == "valid":
            low = name.lower()
            kind = "phone" if "phone" in low else "email" if "email" in low or "mail" in low else None
            if kind is None:
                raise ValueError(f"line {number}: Valid is for phone and email columns: {line}")
            out.append(Rule(name, kind, (), line))
        elif options := _QUOTED.findall(value):
            out.append(Rule(name, "one_of", tuple(options), line))
        else:
            raise ValueError(f"line {number}: not a rule: {line}")
    return out


def predicate(rule: Rule) -> Column:
    """Never null: a row passes or it does not."""
    c = strip(F.coalesce(F.col(f"`{rule.column}`").cast("string"), F.lit("nan" if rule.check == "one_of" else "")))
    if rule.check == "exists":
        return ~F.lower(c).isin(values.RULE_NULLS)
    if rule.check == "phone":
        n = F.length(F.regexp_replace(c, r"\D", ""))
        return (c != "") & F.when(c.startswith("+"), n >= 7).otherwise(n.between(7, 15))
    if rule.check == "email":
        return c.rlike(r"(?U)" + values.EMAIL)
    return F.lower(c).isin([v.lower() for v in rule.options])


def _known(df: DataFrame, rules: list[Rule]) -> None:
    for r in rules:
        if r.column not in df.columns:
            raise ValueError(f"no column {r.column} for the rule: {r.line}")


def apply(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows that pass every rule, in one filter."""
    _known(df, rules)
    return df.where(reduce(lambda a, r: a & predicate(r), rules, F.lit(True)))


def drop_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule_no, rule, dropped): rows that each rule drops of those that came to it, in one aggregation."""
    _known(df, rules)
    aggs, so_far = [], F.lit(True)
    for i, r in enumerate(rules):
        aggs.append(F.count_if(so_far & ~predicate(r)).alias(f"d{i}"))
        so_far = so_far & predicate(r)
    one = df.agg(*aggs) if aggs else df.limit(0).agg(F.count("*").alias("d"))
    rows = [F.struct(F.lit(i + 1).alias("rule_no"), F.lit(r.line).alias("rule"), F.col(f"d{i}").alias("dropped")) for i, r in enumerate(rules)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*") if rows else one.where("false")
