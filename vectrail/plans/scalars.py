"""Queries over text, date, JSON and array functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from vectrail.functions import text, vector
from vectrail.functions.time import elapsed_seconds, epoch_ms
from vectrail.operators import embedding as E
from vectrail.plans import lexing_sql as L
from vectrail.plans.registry import query
from vectrail.sources.tables import load


@query(
    "x1_text_basics",
    f"""
    SELECT doc_id, md5(lower(t)) AS lower_digest, md5(upper(source)) AS upper_digest,
           len(t)::BIGINT AS n_chars, substr(t, 3, 5) AS piece
    FROM (SELECT doc_id, source, regexp_replace(text, '^{L.SPACE}+|{L.SPACE}+$', '', 'g') AS t FROM documents)
    """,
)
def text_basics(spark, folder):
    t = F.col("t")
    return (
        load(spark, folder, "documents")
        .select("doc_id", "source", text.trim_all(F.col("text")).alias("t"))
        .select(
            "doc_id",
            F.md5(F.lower(t)).alias("lower_digest"),
            F.md5(F.upper("source")).alias("upper_digest"),
            F.char_length(t).cast("long").alias("n_chars"),
            F.substring(t, 3, 5).alias("piece"),
        )
    )


@query(
    "x2_word_count",
    "SELECT doc_id, len(string_split(text, ' '))::BIGINT AS n_words FROM documents",
)
def word_count(spark, folder):
    return load(spark, folder, "documents").select(
        "doc_id", text.word_count(F.col("text")).cast("long").alias("n_words")
    )


@query(
    "x3_starts_and_contains",
    """
    SELECT page_id, starts_with(url, 'https') AS secure,
           contains(html, 'table') OR contains(html, 'script') AS busy FROM pages
    """,
)
def starts_and_contains(spark, folder):
    html = F.col("html")
    return load(spark, folder, "pages").select(
        "page_id",
        F.col("url").startswith("https").alias("secure"),
        (html.contains("table") | html.contains("script")).alias("busy"),
    )


@query(
    "x4_null_safe_concat",
    """
    SELECT doc_id, coalesce(lang, '') || ' ' || coalesce(quality::VARCHAR, '') || ' ' || coalesce(source, '') AS joined
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def null_safe_concat(spark, folder):
    both = load(spark, folder, "documents").join(load(spark, folder, "labels"), "doc_id", "left")
    joined = text.concat_columns([F.col("lang"), F.col("quality"), F.col("source")])
    return both.select("doc_id", joined.alias("joined"))


@query(
    "k5_article_text",
    """
    SELECT doc_id, md5(source || chr(10) || chr(10) || text) AS digest FROM documents
    """,
)
def article_text(spark, folder):
    made = E.article_text(F.col("source"), F.col("text"))
    return load(spark, folder, "documents").select("doc_id", F.md5(made).alias("digest"))


AS_OF_MS = 1_706_659_200_000  # 2024-01-31 00:00:00 UTC


@query(
    "x10_times",
    f"""
    SELECT event_id, epoch_us(ts) // 1000 AS ms, ({AS_OF_MS} - epoch_us(ts) // 1000) / 1000.0::DOUBLE AS age_seconds,
           ts < now()::TIMESTAMP AS past
    FROM events
    """,
)
def times(spark, folder):
    events = load(spark, folder, "events").withColumn("ms", epoch_ms(F.col("ts")))
    return events.select(
        "event_id",
        "ms",
        elapsed_seconds(F.col("ms"), AS_OF_MS).alias("age_seconds"),
        (F.col("ms") < F.unix_millis(F.current_timestamp())).alias("past"),
    )


@query(
    "x12_json",
    """
    SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, len(json_keys(props))::BIGINT AS n_keys,
           '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS packed
    FROM events WHERE json_extract_string(props, '$.k')::BIGINT > 50
    """,
)
def json_functions(spark, folder):
    k = F.get_json_object("props", "$.k").cast("long")
    packed = F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("kind")))
    return (
        load(spark, folder, "events")
        .filter(k > 50)
        .select(
            "event_id",
            k.alias("k"),
            F.size(F.json_object_keys("props")).cast("long").alias("n_keys"),
            packed.alias("packed"),
        )
    )


@query(
    "x13_arrays",
    """
    SELECT doc_id, array_to_string(w[1:3], '-') AS first_three, len(w)::BIGINT AS n_words,
           len(list_distinct(w))::BIGINT AS n_distinct
    FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
    """,
)
def arrays(spark, folder):
    return (
        load(spark, folder, "documents")
        .select("doc_id", F.split("text", " ", -1).alias("w"))
        .select(
            "doc_id",
            F.array_join(F.slice("w", 1, 3), "-").alias("first_three"),
            F.size("w").cast("long").alias("n_words"),
            F.size(F.array_distinct("w")).cast("long").alias("n_distinct"),
        )
    )


@query(
    "x14_model_lookup",
    """
    SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'qwen/qwen3-embedding-8b' WHEN 1 THEN 'text-embedding-3-large'
           WHEN 2 THEN 'text-embedding-ada-002' WHEN 3 THEN 'text-embedding-3-small'
           WHEN 4 THEN 'bert-base-uncased' END AS model
    FROM part
    """,
)
def model_lookup(spark, folder):
    lengths = F.array(*[F.lit(n) for n in (4096, 3072, 1536, 1024, 768, 64)])
    n = F.get(lengths, F.col("p_size") % 6)
    return load(spark, folder, "part").select("p_partkey", vector.model_for(n).alias("model"))
