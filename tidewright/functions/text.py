"""Text functions, Column in and Column out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import values

_REST = 2**31 - 1


def let(c: Column, body: Callable[[Column], Column]) -> Column:
    """body(c) with c evaluated once, however often the body names it; keeps expressions linear in size."""
    return F.element_at(F.transform(F.array(c), body), 1)


def pin(c: Column) -> Column:
    """The same value, computed where it stands: filters on it are not pushed below, where they would repeat what it is made of."""
    return F.when(F.rand(0) >= 0, c)


def strip(c: Column) -> Column:
    """Without white space (of any script) at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean_whitespace(c: Column) -> Column:
    """Runs of white space as one space, ends stripped; null gives an empty text."""
    return F.coalesce(strip(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def emoji_class(cjk: bool = True) -> str:
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in (values.EMOJI if cjk else values.EMOJI_ONLY))


def strip_emojis(c: Column, cjk: bool = True) -> Column:
    """Without emoji; ``cjk``: the ranges that also cover East Asian letters."""
    return F.regexp_replace(c, f"[{emoji_class(cjk)}]+", "")


def capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, _REST)))


def title(c: Column) -> Column:
    """Every run of letters starts with a capital and goes on in lower case."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1)), capitalize), "")


def unquote(c: Column) -> Column:
    """Stripped text without the quote that neutralises formulas, if something follows it."""
    return let(strip(c), lambda s: F.when(s.startswith("'") & (F.length(s) > 1), strip(F.substring(s, 2, _REST))).otherwise(s))


def fingerprint(c: Column) -> Column:
    """SHA-256 of the stripped, lower-cased text, in hex."""
    return F.sha2(F.lower(strip(c)), 256)


def row_uuid(run_id: str, line: Column) -> Column:
    """An id in UUID form that a rerun repeats."""
    h = F.sha2(F.concat(F.lit(f"{run_id}:"), line.cast("string")), 256)
    return F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
