"""Queries over embedding, reuse, backfill and the incremental job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vectrail.functions import text, vector
from vectrail.operators import embedding as E
from vectrail.operators.tables import add_vector_column
from vectrail.plans import lexing_sql as L
from vectrail.plans.registry import query, tidy, tidy_sql
from vectrail.session import work_path
from vectrail.sources.tables import corpus, load
from vectrail.streaming.incremental import embed_new_rows, embedded_rows

EMBEDDER = E.Embedder(dims=64)
AS_OF_MS = 1_706_659_200_000  # 2024-01-31 00:00:00 UTC


def checksum(v: Column) -> Column:
    """Sum of the elements weighted by their place, in double."""
    places = F.sequence(F.lit(1), F.lit(64))
    weighted = F.zip_with(v, places, lambda x, i: x.cast("double") * i)
    return tidy(F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x), 5)


def hashed_checks_sql(source: str) -> str:
    """Checksum and norm of the hashed vector of every text: key, checksum, norm."""
    return f"""
        SELECT key, {tidy_sql('coalesce(sum(w * (slot + 1)), 0)', 5)} AS checksum,
               {tidy_sql('coalesce(sqrt(sum(w * w)), 0)', 4)} AS norm
        FROM (SELECT key FROM ({source})) LEFT JOIN
             (SELECT key, slot, w::FLOAT::DOUBLE AS w FROM ({L.hashed_sql(source, 64)})) USING (key)
        GROUP BY key
    """


STORED_CHECK_SQL = tidy_sql("list_sum(list_transform(embedding, lambda x, i: x::DOUBLE * i))", 5)

_DOCS_SQL = "SELECT doc_id AS key, text AS t FROM documents"
_EMBEDDED_SQL = f"SELECT key AS doc_id, checksum, norm FROM ({hashed_checks_sql(_DOCS_SQL)})"


def _checked(df):
    v = F.col("embedding")
    return df.select("doc_id", checksum(v).alias("checksum"), tidy(vector.norm(v), 4).alias("norm"))


@query("k1_embed_documents", _EMBEDDED_SQL)
def embed_documents(spark, folder):
    return _checked(E.embed(load(spark, folder, "documents"), "text", EMBEDDER))


@query(
    "k1_embed_queries",
    f"""
    SELECT key AS item_id, checksum FROM
        ({hashed_checks_sql("SELECT item_id AS key, text AS t FROM benchmark")})
    """,
)
def embed_queries(spark, folder):
    made = E.embed(load(spark, folder, "benchmark"), "text", EMBEDDER)
    return made.select("item_id", checksum(F.col("embedding")).alias("checksum"))


_VOWELS_SQL = " + ".join(
    f"pow(len(text) - len(replace(text, '{c}', '')), 2)" for c in "aeiou"
)


@query(
    "k1_embed_with_plug_in_model",
    f"SELECT doc_id, {tidy_sql(f'sqrt({_VOWELS_SQL})', 3)} AS norm FROM documents",
)
def embed_with_model(spark, folder):
    def letters(texts: list[str]) -> list[list[float]]:
        return [[float(t.count(c)) for c in "aeiou"] for t in texts]

    model = E.Embedder(dims=5, model=letters, batch=32)
    made = E.embed(load(spark, folder, "documents"), "text", model)
    return made.select("doc_id", tidy(vector.norm(F.col("embedding")), 3).alias("norm"))


@query("k2_embed_with_reuse", _EMBEDDED_SQL)
def embed_with_reuse(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "text")
    return _checked(E.embed_with_reuse(docs, "text", EMBEDDER, "doc_id"))


@query("k2_embed_with_known", _EMBEDDED_SQL)
def embed_with_known(spark, folder):
    # Half of the documents were embedded before.
    docs = load(spark, folder, "documents").select("doc_id", "text")
    before = E.embed(docs.filter("doc_id % 2 = 0"), "text", EMBEDDER)
    known = E.embedded_texts(before, "text")
    return _checked(E.embed_with_reuse(docs, "text", EMBEDDER, "doc_id", known=known))


@query("k2_embed_with_reuse_hot_texts", _EMBEDDED_SQL)
def embed_with_reuse_hot(spark, folder):
    # The same with every repeated text treated as hot and split over tasks.
    docs = load(spark, folder, "documents").select("doc_id", "text")
    return _checked(E.embed_with_reuse(docs, "text", EMBEDDER, "doc_id", rows_per_task=1))


# ---------------------------------------------------------- k3 rows by their id

_ASKED_SQL = "SELECT doc_id AS id FROM labels UNION ALL SELECT vec_id + 1000000 FROM embeddings"


def _asked(spark, folder):
    known = load(spark, folder, "labels").select(F.col("doc_id").alias("id"))
    unknown = load(spark, folder, "embeddings").select((F.col("vec_id") + 1_000_000).alias("id"))
    return known.unionAll(unknown)


@query(
    "k3_vectorise_rows",
    f"""
    WITH rows AS (
        SELECT doc_id AS id, embedding, coalesce(lang, '') || ' ' || coalesce(text, '') AS t,
               doc_id IN (SELECT doc_id FROM labels) AS asked
        FROM documents LEFT JOIN embeddings ON doc_id = vec_id),
    made AS ({hashed_checks_sql("SELECT id AS key, t FROM rows WHERE asked AND len(t) >= 5")})
    SELECT id, CASE WHEN asked THEN CASE WHEN len(t) >= 5 THEN 'vectorised' ELSE 'too short' END END AS status,
           CASE WHEN asked AND len(t) >= 5 THEN checksum ELSE {STORED_CHECK_SQL} END AS checksum
    FROM rows LEFT JOIN made ON id = key
    """,
)
def vectorise_rows(spark, folder):
    table = corpus(load(spark, folder, "documents"), load(spark, folder, "embeddings"))
    done = E.vectorise_rows(table, _asked(spark, folder), ["lang", "content"], EMBEDDER)
    return done.select("id", "status", checksum(F.col("embedding")).alias("checksum"))


@query(
    "k3_ids_not_found",
    f"SELECT DISTINCT id FROM ({_ASKED_SQL}) WHERE id NOT IN (SELECT doc_id FROM documents)",
)
def ids_not_found(spark, folder):
    docs = load(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    return E.missing_ids(docs, _asked(spark, folder))


# ------------------------------------------------------------ k4 record texts

_PARTS_SQL = """
    concat_ws(' | ', CASE WHEN lang = 'en' THEN text END,
              CASE WHEN lang IN ('en', 'fr') THEN 'Study: ' || source END,
              CASE WHEN lang = 'de' THEN 'Symbol: ' || lang END,
              CASE WHEN lang = 'fr' AND n_chars % 2 = 0 THEN 'Technical: {"n":' || n_chars || '}' END)
"""


def _parts():
    lang, n = F.col("lang"), F.col("n_chars")
    return (
        F.when(lang == "en", F.col("text")),
        F.when(lang.isin("en", "fr"), F.col("source")),
        F.when(lang == "de", lang),
        F.when((lang == "fr") & (n % 2 == 0), F.to_json(F.struct(n.alias("n")))),
    )


@query(
    "k4_x5_record_text",
    f"SELECT doc_id, md5(coalesce(nullif({_PARTS_SQL}, ''), 'No content provided')) AS digest FROM documents",
)
def record_text(spark, folder):
    return load(spark, folder, "documents").select(
        "doc_id", F.md5(E.record_text(*_parts())).alias("digest")
    )


@query(
    "k4_x5_record_text_or_whole_record",
    f"""
    SELECT doc_id, md5(coalesce(nullif({_PARTS_SQL}, ''),
           '{{"doc_id":' || doc_id || ',"lang":"' || lang || '","source":"' || source || '","n_chars":' || n_chars || '}}')) AS digest
    FROM documents
    """,
)
def record_text_or_record(spark, folder):
    whole = F.to_json(F.struct("doc_id", "lang", "source", "n_chars"))
    return load(spark, folder, "documents").select(
        "doc_id", F.md5(E.record_text(*_parts(), fallback=whole)).alias("digest")
    )


# ---------------------------------------------------------------- k5 backfill

_NEWS_SQL = f"""
    SELECT doc_id AS id, source AS title, text AS content, embedding,
           {AS_OF_MS} - doc_id % 20 * 43200000 - doc_id AS timestamp_unix_ms
    FROM documents LEFT JOIN embeddings ON doc_id = vec_id
"""


def _news(spark, folder):
    texts = load(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("source").alias("title"), F.col("text").alias("content")
    )
    vectors = load(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    age = F.col("id") % 20 * 43_200_000 + F.col("id")
    return texts.join(vectors, "id", "left").withColumn("timestamp_unix_ms", F.lit(AS_OF_MS) - age)


def _backfill_sql(limit: str) -> str:
    return f"""
        WITH news AS ({_NEWS_SQL}),
        due AS (SELECT id AS key, title || chr(10) || chr(10) || content AS t FROM news
                WHERE embedding IS NULL AND timestamp_unix_ms > {AS_OF_MS} - 7 * 86400000
                ORDER BY timestamp_unix_ms DESC, id {limit}),
        made AS ({hashed_checks_sql("SELECT key, t FROM due")})
        SELECT id, CASE WHEN key IS NOT NULL THEN 'embedded' END AS backfill,
               coalesce({STORED_CHECK_SQL}, checksum) AS checksum
        FROM news LEFT JOIN made ON id = key
    """


def _backfilled(spark, folder, limit=None):
    return E.backfill(_news(spark, folder), EMBEDDER, AS_OF_MS, limit=limit)


@query("k5_backfill", _backfill_sql(""))
def backfill(spark, folder):
    done = _backfilled(spark, folder)
    return done.select("id", "backfill", checksum(F.col("embedding")).alias("checksum"))


@query("k5_backfill_newest_first", _backfill_sql("LIMIT 100"))
def backfill_newest(spark, folder):
    done = _backfilled(spark, folder, 100)
    return done.select("id", "backfill", checksum(F.col("embedding")).alias("checksum"))


@query(
    "k5_backfill_counts",
    f"""
    SELECT count(*) AS due, count(*) AS embedded, 0::BIGINT AS failed FROM ({_NEWS_SQL})
    WHERE embedding IS NULL AND timestamp_unix_ms > {AS_OF_MS} - 7 * 86400000
    """,
)
def backfill_counts(spark, folder):
    return E.backfill_counts(_backfilled(spark, folder))


# --------------------------------------------------------- k6, r1, re-embedding


@query(
    "k6_dimension_agreement",
    """
    SELECT dims, count(*) AS n_rows, dims = 64 AS agrees
    FROM (SELECT CASE WHEN lang = 'en' THEN 32 ELSE 64 END AS dims FROM documents) GROUP BY dims
    """,
)
def dimension_agreement(spark, folder):
    made = E.embed(load(spark, folder, "documents"), "text", EMBEDDER)
    v = F.col("embedding")
    mixed = made.select(F.when(F.col("lang") == "en", F.slice(v, 1, 32)).otherwise(v).alias("v"))
    return E.dimension_agreement(mixed, "v", 64)


@query("r1_incremental_embedding", _EMBEDDED_SQL)
def incremental(spark, folder):
    return _checked(_streamed(spark, folder, reuse=False))


@query("r1_incremental_embedding_with_reuse", _EMBEDDED_SQL)
def incremental_with_reuse(spark, folder):
    return _checked(_streamed(spark, folder, reuse=True))


def _streamed(spark, folder, reuse):
    target = work_path(spark, "embedded")
    embed_new_rows(
        spark,
        # A pattern, since the table may be one file, which a stream takes by no other name, or a folder of files.
        f"{folder.rstrip('/')}/{{documents.parquet}}",
        load(spark, folder, "documents").schema,
        target,
        work_path(spark, "progress"),
        "text",
        EMBEDDER,
        "doc_id",
        reuse=reuse,
        files="*",
    ).awaitTermination()
    return embedded_rows(spark, target)


@query(
    "a10_append_with_embedding",
    f"""
    SELECT vec_id AS id, {STORED_CHECK_SQL} AS checksum, NULL::VARCHAR AS text FROM embeddings
    UNION ALL
    SELECT (SELECT max(vec_id) FROM embeddings) + 1 + key, checksum, text
    FROM ({hashed_checks_sql("SELECT item_id AS key, text AS t FROM benchmark")})
    JOIN benchmark ON key = item_id
    """,
)
def append_with_embedding(spark, folder):
    from vectrail.operators.tables import append_with_embedding as append

    base = load(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    records = load(spark, folder, "benchmark").withColumnRenamed("item_id", "item")
    grown = append(base, records, F.col("text"), EMBEDDER, extend=True)
    return grown.select("id", checksum(F.col("embedding")).alias("checksum"), "text")


@query(
    "a6_change_dimension_and_embed_again",
    f"""
    SELECT doc_id AS id, checksum FROM documents
    JOIN ({hashed_checks_sql(_DOCS_SQL)}) ON doc_id = key
    """,
)
def change_dimension(spark, folder):
    from vectrail.operators.tables import change_dimension as change

    # The stored vectors were declared with 128 elements by mistake: all of
    # them become NULL and are embedded again with the new length.
    docs = load(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")
    wide = add_vector_column(docs, "embedding", 128).withColumn(
        "embedding", vector.zeros(128)
    )
    changed = change(wide, "embedding", 64, on_mismatch="null")
    filled = changed.withColumn(
        "embedding", F.coalesce("embedding", EMBEDDER.column(text.trim_all(F.col("text"))))
    )
    return filled.select("id", checksum(F.col("embedding")).alias("checksum"))
