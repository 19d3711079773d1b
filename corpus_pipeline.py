"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps with the columns
of ``documents``; the last returns tokens.  Every stage works on what the one before kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrail.llm import bpe, langid, line_dedup, mixing, simhash
from vectrail.llm.queries import tokenizer_path
from vectrail.llm.texts import free_prefix
from vectrail.session import work_path
from vectrail.sources.tables import load, write_table

MIN_DOCS = 10  # a line in so many documents goes


def _with_text(docs: DataFrame, text: str, like: DataFrame) -> DataFrame:
    """``docs`` with another text and its length, and only the columns of ``like``."""
    changed = docs.withColumn("text", F.col(text))
    if "n_chars" in like.columns:
        changed = changed.withColumn("n_chars", F.char_length("text").cast(like.schema["n_chars"].dataType))
    return changed.select(*like.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; ``lang`` stays as it is given."""
    prefix = free_prefix(docs, "_lang")
    judged = langid.identify(docs, prefix=prefix)
    return judged.filter(~F.col(f"{prefix}_rejected")).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in many documents.

    A document all of whose lines go keeps its row with an empty text.
    """
    prefix = free_prefix(docs, "_line_dedup")
    kept = line_dedup.drop_repeated_lines(docs, min_docs=MIN_DOCS, prefix=prefix)
    return _with_text(kept, f"{prefix}_text", docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return simhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    prefix = free_prefix(docs, "_mix")
    return mixing.copies_of(mixing.mix(docs, prefix=prefix), prefix).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    decoded = bpe.encode_and_decode(docs, tokenizer_path())
    return decoded.select(
        "doc_id",
        "lang",
        "source",
        "token_ids",
        F.size("token_ids").cast("long").alias("n_tokens"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_copies),
    ("source_mixing", mixed),
    ("bpe_tokens", tokens),
]

# Language models and fingerprints can't be written in SQL; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), work_path(spark, f"pipeline-{name}"))
    return STAGES[-1][1](spark, docs, sf_dir)
