"""Normalisers: text in, struct(value, status, reason) out. Null and empty texts are MISSING."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import values
from .text import capitalize, clean_whitespace, let, strip, strip_emojis, title


def _result(value, status: str, reason: str | None = None) -> Column:
    v = F.lit(None).cast("string") if value is None else value
    return F.struct(v.alias("value"), F.lit(status).alias("status"), F.lit(reason).cast("string").alias("reason"))


def _absent(c: Column) -> Column:
    return c.isNull() | (c == "")


def email(c: Column, cjk: bool = True) -> Column:
    x = F.regexp_replace(F.lower(strip(strip_emojis(c, cjk))), r"(?U)\s+", "")
    judged = let(x, lambda x: F.when(x.rlike(r"(?U)" + values.EMAIL), _result(x, "VALID")).otherwise(_result(c, "INVALID", "Invalid format")))
    return F.when(_absent(c), _result(None, "MISSING", "Empty value")).otherwise(judged)


def phone(c: Column, placeholder: str = values.PLACEHOLDER, cjk: bool = True) -> Column:
    marker = r"(?:ext\.?|extension|x)\s*"

    def judged(digits: Column, extension: Column) -> Column:
        n = F.length(digits)
        tail = F.when(extension != "", F.concat(F.lit(" x"), extension)).otherwise("")
        ten = F.concat(F.substring(digits, 1, 3), F.lit("-"), F.substring(digits, 4, 3), F.lit("-"), F.substring(digits, 7, 4), tail)
        seven = F.concat(F.substring(digits, 1, 3), F.lit("-"), F.substring(digits, 4, 4), tail)
        wrong = F.struct(F.lit(placeholder).alias("value"), F.lit("INVALID").alias("status"), F.concat(F.lit("Expected 7 or 10 digits, found "), n.cast("string")).alias("reason"))
        return F.when(n == 10, _result(ten, "VALID")).when(n == 7, _result(seven, "VALID")).when(n == 0, _result(F.lit(placeholder), "MISSING", "No phone digits found")).otherwise(wrong)

    def digits_of(s: Column) -> Column:
        plain = F.regexp_replace(F.regexp_replace(s, f"(?is){marker}\\d+.*$", ""), r"\D", "")
        local = let(plain, lambda d: F.when((F.length(d) == 11) & d.startswith("1"), F.substring(d, 2, 10)).otherwise(d))
        return let(F.struct(local.alias("d"), F.regexp_extract(s, f"(?i){marker}(\\d+)", 1).alias("x")), lambda p: judged(p["d"], p["x"]))

    s = F.regexp_replace(strip(strip_emojis(c, cjk)), "^['\"]+", "")
    return F.when(_absent(c), _result(F.lit(placeholder), "MISSING", "Empty value")).otherwise(let(s, digits_of))


def name(c: Column, field: str = "name", greedy: bool = True, cjk: bool = True) -> Column:
    x = clean_whitespace(strip_emojis(c, cjk))
    for h in values.HONORIFICS_STOP:
        x = F.regexp_replace(x, rf"(?iU)\b{h}\.?\s*" if greedy else rf"(?iU)\b{h}(?:\.\s*|\s+|$)", "")
    for h in values.HONORIFICS_SPACE:
        x = F.regexp_replace(x, rf"(?iU)\b{h}\s+", "")

    def judged(y: Column) -> Column:
        out = F.when(y.rlike(r"(?U)[\d()]"), _result(c, "INVALID", "Contains digits or parentheses"))
        if field == "last_name":
            out = out.when(F.length(F.regexp_replace(y, r"\.+$", "")) <= 2, _result(c, "INVALID", "Suspiciously short (possible truncation)"))
        return out.when(F.length(y) < 2, _result(c, "INVALID", "Too short")).otherwise(_result(y, "VALID"))

    def body(x: Column) -> Column:
        aside = F.upper(F.regexp_extract(x, r"\(([^)]+)\)", 1))
        titled = aside.rlike("|".join(values.TITLES_IN_NAMES))
        y = title(clean_whitespace(F.regexp_replace(F.regexp_replace(x, '"[^"]*"', ""), r"\([^)]*\)", "")))
        return F.when(titled, _result(c, "INVALID", "Potential Job Title in Name")).otherwise(let(y, judged))

    return F.when(_absent(c), _result(None, "MISSING", "Empty value")).otherwise(let(x, body))


def job_title(c: Column, cjk: bool = True) -> Column:
    words = F.split(clean_whitespace(strip_emojis(c, cjk)), " ")
    cased = F.transform(words, lambda w, i: F.when((i > 0) & F.lower(w).isin(values.SMALL_WORDS), F.lower(w)).otherwise(capitalize(w)))
    x = F.array_join(cased, " ")
    for a in values.ACRONYMS:
        x = F.regexp_replace(x, rf"(?iU)\b{a}\b", a)
    return F.when(_absent(c), _result(None, "MISSING", "Empty value")).otherwise(_result(x, "VALID"))


def company(c: Column) -> Column:
    return F.when(_absent(c), _result(None, "MISSING", "Empty value")).otherwise(_result(strip(c), "VALID"))


def currency(c: Column, thousands_cut: bool = True) -> Column:
    """A number of dollars or the like as double, scaled by K, M or B; null where there is none. ``thousands_cut``: stop at a comma."""

    def body(s: Column) -> Column:
        text = s if thousands_cut else F.regexp_replace(s, r"(?<=\d),(?=\d{3})", "")
        amount = F.regexp_extract(text, r"(-?\d+(?:\.\d+)?)", 1).try_cast("double")
        return amount * F.when(s.contains("K"), 1e3).when(s.contains("M"), 1e6).when(s.contains("B"), 1e9).otherwise(1.0)

    return F.when(_absent(c), F.lit(None).cast("double")).otherwise(let(F.upper(strip(c)), body))


#: Date forms that are parsed natively: (pattern that the text must match, format).
_DATE_FORMS = [
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^(0[1-9]|1[0-2])/\d{2}/\d{4}$", "MM/dd/yyyy"),
    (r"^(1[3-9]|2\d|3[01])/\d{2}/\d{4}$", "dd/MM/yyyy"),
]


@F.pandas_udf(StringType())
def _any_date(texts: pd.Series) -> pd.Series:
    """Whatever else pandas takes for a date, text by text."""

    def one(x):
        if x is None:
            return None
        try:
            return pd.to_datetime(x, errors="raise").strftime("%Y-%m-%d")
        except Exception:  # any failure means that it is no date
            return None

    return texts.map(one)


def date(c: Column, lenient: bool = True) -> Column:
    """yyyy-MM-dd text. Common forms stay in the JVM; the rest goes to pandas in Arrow batches if ``lenient``."""
    known = F.coalesce(*(F.when(c.rlike(p), F.date_format(F.try_to_timestamp(c, F.lit(f)), "yyyy-MM-dd")) for p, f in _DATE_FORMS))
    common = reduce(lambda a, p: a | c.rlike(p[0]), _DATE_FORMS, F.lit(False))
    x = F.coalesce(known, _any_date(F.when(~common, c))) if lenient else known
    return F.when(_absent(c), _result(None, "MISSING", "Empty value")).when(x.isNotNull(), _result(x, "VALID")).otherwise(_result(c, "INVALID", "Date parse failed"))
