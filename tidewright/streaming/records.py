"""Stateless cleaning of a stream of records: the batch expressions, on a frame that never ends."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import Config
from ..operators.clean import clean


def clean_stream(df: DataFrame, types: dict[str, str], cfg: Config = Config()) -> DataFrame:
    """What clean() does to a streaming frame of text columns with _line_number; types must be given, as a stream has no sample to read."""
    return clean(df, types, cfg)
