"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .oracle import ORACLE

#: Name of the tokenizer file, its vocabulary size and the id that ends a document.
TOKENIZER, VOCABULARY, END_ID = "word_bpe_49k.json", 49_408, 1


def tokenizer_spec(name: str = TOKENIZER) -> str:
    """The tokenizer file's text; the driver reads it once and tasks get it by broadcast."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op1_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import edited_versions

    return edited_versions(read(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_groups

    return near_groups(read(spark, sf_dir, "documents"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit, identify

    docs = read(spark, sf_dir, "documents")
    return identify(docs, fit(docs))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import encode_decode

    return encode_decode(read(spark, sf_dir, "documents"), tokenizer_spec())


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import dedup_bytes

    out = dedup_bytes(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import read_token_files, write_token_files

    return read_token_files(write_token_files(read(spark, sf_dir, "documents"), tokenizer_spec(), VOCABULARY, END_ID).df)


def op7_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .perplexity import quality

    return quality(read(spark, sf_dir, "documents"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import dedup_windows

    out = dedup_windows(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html import extract

    return extract(read(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(read(spark, sf_dir, "documents"), tokenizer_spec(), END_ID)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprint": op1_fingerprint,
        "op2_simhash": op2_simhash,
        "op3_langid": op3_langid,
        "op4_bpe": op4_bpe,
        "op5_suffixes": op5_suffixes,
        "op6_token_files": op6_token_files,
        "op7_perplexity": op7_perplexity,
        "op8_substrings": op8_substrings,
        "op9_html": op9_html,
        "op10_packing": op10_packing,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
