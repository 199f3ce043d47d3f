"""Training-data pipeline over a documents table: five operators in a row, each on all that the one before kept.

language ID -> quality rules -> near-duplicate documents -> repeated byte strings -> packing into training windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.llm import langid, packing, perplexity, simhash, suffixes
from tidewright.llm.common import Staged, read
from tidewright.llm.queries import END_ID, tokenizer_spec

#: Least score of the predicted language.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language that the network is sure enough of."""
    return langid.keep_identified(docs, langid.fit(docs), LEAST_SCORE)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose perplexity lies in their language's band."""
    return perplexity.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that a document of smaller doc_id has already; half a character left at a cut goes too.

    Null texts become empty, repeated rows stay, other columns pass unchanged; an empty table stays empty.
    """
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    found = suffixes.dedup_bytes(docs, carry=others, whole=True)
    made = {c: F.col("row")[f"c{i}"] for i, c in enumerate(others)} | {"text": F.col("kept").cast("string")}
    made["n_chars"] = F.length(made["text"]).cast("long")
    return found.select(*(made[c].alias(c) for c in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_spec(), END_ID)


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("packing", pack),
]

#: A network, a language model and a tokenizer are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result but the last is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Staged(stage(spark, docs, sf_dir), name).df
    return STAGES[-1][1](spark, docs, sf_dir)
