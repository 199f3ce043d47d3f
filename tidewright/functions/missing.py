"""Missing values: what counts as missing, and what stands for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import values
from .text import strip, strip_emojis, unquote


def is_missing(c: Column) -> Column:
    """Null, NaN as text, blank, or one of the indicator words, a neutralising quote aside."""
    return c.isNull() | F.lower(unquote(c)).isin(values.MISSING)


def category(name: str) -> str:
    """placeholder, numeric or other, by the field's name."""
    low = name.lower()
    if low in values.PLACEHOLDER_FIELDS:
        return "placeholder"
    return "numeric" if any(w in low for w in values.NUMERIC_WORDS) else "other"


def sanitize(c: Column, name: str, placeholder: str = values.PLACEHOLDER, cjk: bool = True) -> Column:
    """A present text without emoji, outer white space and neutralising quote; a missing one as null if numeric, else the placeholder."""
    stand_in = F.lit(None).cast("string") if category(name) == "numeric" else F.lit(placeholder)
    return F.when(is_missing(c), stand_in).otherwise(unquote(strip(strip_emojis(c, cjk))))


def indicators(df: DataFrame, names: list[str]) -> DataFrame:
    """A column {name}_was_missing for each name."""
    return df.withColumns({f"{n}_was_missing": is_missing(F.col(f"`{n}`")) for n in names})
