"""Repair of records that rules could not settle, by a resolver that answers a prompt with JSON."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import values
from ..config import Config
from ..functions.text import let, pin
from .clean import fields_of

PROMPT = "Clean this record. Answer with one JSON object that uses the keys first_name, last_name, email, phone, company and job_title, and with nothing else.\n"
REPAIRED_SCORE = 0.8


class Resolver(Protocol):
    """Answers prompts, called with at most a batch of rows. ``load()``, if there is one, is called once a task before that."""

    def resolve(self, prompts: list[str]) -> list[str]: ...


class NullResolver:
    """No model: every answer is an empty object, so records pass unchanged."""

    def resolve(self, prompts: list[str]) -> list[str]:
        return ["{}"] * len(prompts)


def prompt(df: DataFrame) -> Column:
    return F.concat(F.lit(PROMPT + "Input: "), F.to_json(F.col("raw")), F.lit("\nOutput:"))


def _answers(resolver: Resolver, prompts: list[str], size: int) -> Iterator[tuple[str | None, str | None]]:
    """(reply, failure) of each prompt. Batches are halved where one fails, and grow back after one that works."""
    at, n = 0, size
    while at < len(prompts):
        batch = prompts[at : at + n]
        try:
            got = resolver.resolve(batch)
            if len(got) != len(batch):
                raise ValueError("a reply for each prompt is expected")
        except Exception as e:  # a model may fail in any way: narrow the batch down to the row
            if len(batch) > 1:
                n = len(batch) // 2
                continue
            got, failure = [None], "MODEL_CRASH" if isinstance(e, MemoryError) else "UNKNOWN"
        else:
            failure, n = None, min(2 * n, size)
        at += len(batch)
        yield from ((g, failure) for g in got)


def replies(df: DataFrame, resolver: Resolver | None = None, cfg: Config = Config()) -> DataFrame:
    """Adds reply to the rows that need repair, null to others, and failed: why a row has no answer. Without a resolver the reply is
    a literal. A row that fails by itself has UNKNOWN, or MODEL_CRASH if memory ran out; where the resolver does not load, all rows
    that need repair have MODEL_CRASH."""
    asks = F.col("status") == "AI_REQUIRED"
    if resolver is None or isinstance(resolver, NullResolver):
        return df.withColumns({"reply": F.when(asks, F.lit("{}")), "failed": F.lit(None).cast("string")})
    size = cfg.batch_rows

    @F.pandas_udf("reply string, failed string")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        loaded = None
        for s in batches:
            texts = s.dropna()
            if loaded is None and len(texts):
                try:
                    getattr(resolver, "load", lambda: None)()
                    loaded = True
                except Exception:  # as above
                    loaded = False
            got = list(_answers(resolver, texts.tolist(), size)) if loaded else [(None, "MODEL_CRASH")] * len(texts)
            yield pd.DataFrame(got, columns=["reply", "failed"], index=texts.index).reindex(s.index).astype(object)

    return df.withColumn("__r", ask(F.when(asks, prompt(df)))).withColumns({"reply": F.col("__r.reply"), "failed": F.col("__r.failed")}).drop("__r")


def parsed(reply: Column) -> Column:
    """The JSON text of a reply, by the forms that models use: plain, in a fence (final, whatever it holds), cut at the next Input:,
    or from the first to the last brace; null if none is JSON."""
    ok = lambda c: F.when(F.try_parse_json(c).isNotNull(), c)
    fence = r"(?s)```{}\s*(\{{.*?\}})\s*```"
    first, second = F.regexp_extract(reply, fence.format("json"), 1), F.regexp_extract(reply, fence.format(""), 1)
    head = F.when(F.instr(reply, "Input:") > 0, F.substring_index(reply, "Input:", 1)).otherwise(reply)
    braces = lambda c: F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit(""))
    return F.coalesce(
        ok(reply),
        F.when(first != "", F.coalesce(ok(first), F.lit("null"))),
        F.when(second != "", F.coalesce(ok(second), F.lit("null"))),
        F.when(braces(head).isNotNull(), F.coalesce(ok(braces(head)), F.lit("null"))),
        ok(braces(reply)),
    )


def fault(reply: Column) -> Column:
    """Null for a JSON object, JSON_PARSE_ERROR for what is no JSON or null, SCHEMA_ERROR for other JSON."""
    kind = F.schema_of_variant(F.try_parse_json(parsed(reply)))
    return let(kind, lambda k: F.when(k.startswith("OBJECT"), None).when(k.isNull() | (k == "VOID"), "JSON_PARSE_ERROR").otherwise("SCHEMA_ERROR"))


def verdict(reply: Column) -> Column:
    """OBJECT, or INVALID_FORMAT for what is no JSON, null or no object."""
    return F.when(fault(reply).isNull(), "OBJECT").otherwise("INVALID_FORMAT")


def canonical_keys(m: Column) -> Column:
    """A map with alias keys as their canonical names, others as they are; of keys that fall together the last has its say."""
    alias = {a: kind for kind, names in reversed(values.ALIASES.items()) for a in [kind, *names]}
    table = F.create_map(*(F.lit(x) for pair in alias.items() for x in pair))
    entries = F.transform(F.map_entries(m), lambda e: F.struct(F.lower(F.coalesce(table[F.lower(F.trim(e["key"]))], e["key"])).alias("key"), e["value"].alias("value")))
    last = F.aggregate(
        entries,
        F.array().cast("array<struct<key:string,value:string>>"),
        lambda acc, e: F.concat(F.filter(acc, lambda x: x["key"] != e["key"]), F.array(e)),
    )
    return F.map_from_entries(last)


def reply_map(reply: Column) -> Column:
    return canonical_keys(F.from_json(parsed(reply), "map<string,string>"))


def merged(name: str, old: Column, answer: Column) -> Column:
    """A field after repair: what the first phase has stays unless the answer says something better."""
    has = F.map_contains_key(answer, name)
    new = answer[name]
    known = old.isNotNull() & (old != "")
    blank = new.isNull() | (F.trim(new) == "")
    useless = blank | (F.lower(F.trim(new)) == "not provided")
    keep = known & (useless if name != "phone" else blank)
    if name == "email":
        keep = keep | (known & old.contains("@"))
    return F.when(F.coalesce(has, F.lit(False)) & ~keep, new).otherwise(old)


def repair(df: DataFrame, resolver: Resolver | None = None, cfg: Config = Config()) -> DataFrame:
    """Routed rows after repair; keys of answers that are no fields go to the map ``extras``, what happened to ``repair_event``."""
    if not cfg.repair:
        return df.withColumns({"extras": F.lit(None).cast("map<string,string>"), "repair_event": F.lit(None).cast("string")})
    asked = replies(df, resolver, cfg).withColumn("__v", pin(fault(F.col("reply")))).withColumn("__m", pin(reply_map(F.col("reply"))))
    asks = F.col("status") == "AI_REQUIRED"
    good = asks & F.col("failed").isNull() & F.col("__v").isNull()
    event = F.when(good, "ROW_RESOLVED").when(asks & F.col("failed").isNotNull(), "ROW_ERROR").when(asks, F.col("__v"))
    names = fields_of(df, "clean")
    kinds = {f.name: f.dataType.simpleString() for f in df.schema["clean"].dataType.fields}
    fixed = [F.when(good, merged(n, F.col("clean")[n], F.col("__m"))).otherwise(F.col("clean")[n]).alias(n) if kinds[n] == "string" else F.when(good & F.map_contains_key("__m", n), F.coalesce(F.col("__m")[n].try_cast(kinds[n]), F.col("clean")[n])).otherwise(F.col("clean")[n]).alias(n) for n in names]
    extras = F.map_filter("__m", lambda k, v: ~k.isin(names))
    return (
        asked.withColumns(
            {
                "clean": pin(F.struct(*fixed)),
                "extras": F.when(good, extras),
                "repair_event": pin(event),
                "failure_reason": pin(F.when(asks & F.col("failed").isNotNull(), F.col("failed")).when(asks & ~good, "INVALID_FORMAT").otherwise(F.col("failure_reason"))),
                "confidence_score": F.when(good, REPAIRED_SCORE).otherwise(F.col("confidence_score")),
                "status": pin(F.when(good, "CLEAN").when(asks, "REJECTED").otherwise(F.col("status"))),
            }
        )
        .drop("reply", "failed", "__v", "__m")
    )
