"""Queries over lexing, matching and ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from vectrail.functions import text
from vectrail.plans import lexing_sql as L
from vectrail.plans.registry import query, tidy, tidy_sql
from vectrail.sources.tables import load

_QUERY = "ment tion"


def _register_lexemes(language: str) -> None:
    @query(
        f"x6_lexemes_{language}",
        f"""
        SELECT doc_id, len(lex)::BIGINT AS n_lexemes, len(list_distinct(lex))::BIGINT AS n_distinct,
               md5(array_to_string(lex, ' ')) AS digest
        FROM (SELECT doc_id, {L.lexemes_sql('text', language)} AS lex FROM documents)
        """,
    )
    def run(spark, folder):
        docs = load(spark, folder, "documents")
        return docs.select("doc_id", text.lexemes(F.col("text"), language).alias("lex")).select(
            "doc_id",
            F.size("lex").cast("long").alias("n_lexemes"),
            F.size(F.array_distinct("lex")).cast("long").alias("n_distinct"),
            F.md5(F.array_join("lex", " ")).alias("digest"),
        )


for _language in text.STEM_RULES:
    _register_lexemes(_language)


@query(
    "x7_query_terms",
    f"""
    SELECT conv_id, turn, array_to_string(list_sort({L.terms_sql('text', 'english')}), ' ') AS terms
    FROM conversations
    """,
)
def query_terms(spark, folder):
    turns = load(spark, folder, "conversations")
    return turns.select(
        "conv_id",
        "turn",
        F.array_join(text.query_terms(F.col("text"), "english"), " ").alias("terms"),
    )


@query(
    "x8_match_test",
    f"SELECT doc_id, doc_id IN (SELECT doc_id FROM ({L.ranked(_QUERY, 'french')})) AS hit FROM documents",
)
def match_test(spark, folder):
    terms = text.constant_terms(spark, _QUERY)
    docs = load(spark, folder, "documents")
    return docs.select("doc_id", text.constant_match(F.col("text"), terms).alias("hit"))


@query(
    "x8_x9_match_and_rank_of_word_lists",
    f"SELECT doc_id, {tidy_sql('rank')} AS rank FROM ({L.ranked(_QUERY, 'french')})",
)
def match_and_rank(spark, folder):
    lex, terms = F.col("lex"), F.col("terms")
    return (
        load(spark, folder, "documents")
        .select(
            "doc_id",
            text.lexemes(F.col("text")).alias("lex"),
            text.query_terms(F.lit(_QUERY)).alias("terms"),
        )
        .filter(text.matches(lex, terms))
        .select("doc_id", tidy(text.rank(lex, terms)).alias("rank"))
    )


@query(
    "x9_rank",
    f"SELECT doc_id, {tidy_sql('rank')} AS rank FROM ({L.ranked('tion', 'french')})",
)
def constant_rank(spark, folder):
    terms = text.constant_terms(spark, "tion")
    docs = load(spark, folder, "documents").filter(text.constant_match(F.col("text"), terms))
    return docs.select("doc_id", tidy(text.constant_rank(F.col("text"), terms)).alias("rank"))
