"""Queries over the search operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrail.functions import text, vector
from vectrail.operators import ann, batch, search
from vectrail.operators.embedding import Embedder
from vectrail.operators.skew import top_per_group
from vectrail.plans import lexing_sql as L
from vectrail.plans.registry import PROBE_SQL, longs, probe_vector, query, tidy, tidy_sql
from vectrail.session import work_path
from vectrail.sources.tables import corpus, load

QUERY_EN = "rewh thatin"
QUERY_FR = "ment tion"
EMBEDDER = Embedder(dims=64)


def _corpus(spark, folder):
    return corpus(load(spark, folder, "documents"), load(spark, folder, "embeddings"))


def _vectors(spark, folder):
    return load(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


def _texts(spark, folder):
    return load(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), "lang"
    )


# ------------------------------------------------------------------ j1 vector

_FORMULAS = {
    "cosine": "1 - list_cosine_similarity(e, q)",
    "l2": "list_distance(e, q)",
    "inner_product": "-list_inner_product(e, q)",
}


def _register_search(metric: str) -> None:
    @query(
        f"j1_vector_search_{metric}",
        f"""
        SELECT vec_id, label, {tidy_sql('d')} AS distance, {tidy_sql('1 - d')} AS similarity
        FROM (SELECT vec_id, label, {_FORMULAS[metric]} AS d
              FROM (SELECT vec_id, label, embedding::DOUBLE[] AS e, {PROBE_SQL} AS q FROM embeddings))
        ORDER BY d, vec_id LIMIT 10
        """,
    )
    def run(spark, folder):
        found = search.vector_search(
            load(spark, folder, "embeddings"), probe_vector(spark, folder), 10, metric, key="vec_id"
        )
        return found.select(
            "vec_id", "label", tidy(F.col("distance")).alias("distance"),
            tidy(F.col("similarity")).alias("similarity"),
        )


for _metric in vector.METRICS:
    _register_search(_metric)


@query(
    "j1_vector_search_filtered",
    f"""
    SELECT vec_id, {tidy_sql('d')} AS distance
    FROM (SELECT vec_id, list_distance(embedding::DOUBLE[], {PROBE_SQL}) AS d
          FROM embeddings WHERE label IN (2, 3))
    ORDER BY d, vec_id LIMIT 5
    """,
)
def vector_search_filtered(spark, folder):
    found = search.vector_search(
        load(spark, folder, "embeddings"), probe_vector(spark, folder), 5, "l2",
        key="vec_id", columns=["vec_id"], where="label IN (2, 3)",
    )
    return found.select("vec_id", tidy(F.col("distance")).alias("distance"))


@query(
    "j1_vector_search_arrow",
    f"""
    SELECT vec_id, {tidy_sql('d')} AS distance
    FROM (SELECT vec_id, 1 - list_cosine_similarity(embedding::DOUBLE[], {PROBE_SQL}) AS d FROM embeddings)
    ORDER BY d, vec_id LIMIT 25
    """,
)
def vector_search_arrow(spark, folder):
    found = search.vector_search(
        load(spark, folder, "embeddings"), probe_vector(spark, folder), 25,
        key="vec_id", engine="arrow",
    )
    return found.select("vec_id", tidy(F.col("distance")).alias("distance"))


# -------------------------------------------------------------------- j2 text


def _register_text(name: str, words: str, language: str) -> None:
    @query(
        name,
        f"""
        SELECT doc_id AS id, lang, {tidy_sql('rank')} AS rank
        FROM ({L.ranked(words, language)}) ORDER BY rank DESC, doc_id LIMIT 10
        """,
    )
    def run(spark, folder):
        found = search.text_search(_texts(spark, folder), words, language=language)
        return found.select("id", "lang", tidy(F.col("rank")).alias("rank"))


_register_text("j2_text_search_french", QUERY_FR, "french")
_register_text("j2_text_search_english", QUERY_EN, "english")
_register_text("j2_text_search_german", "lich", "german")
_register_text("j2_text_search_spanish", "mente", "spanish")


# ------------------------------------------------------------------ j3 hybrid

_HYBRID_SQL = f"""
    WITH hits AS (
        SELECT doc_id AS id, rank AS text_rank FROM ({L.ranked(QUERY_EN, 'english')})
        ORDER BY rank DESC, doc_id LIMIT 100),
    scored AS (
        SELECT id, text_rank, 1 - list_cosine_similarity(embedding::DOUBLE[], {PROBE_SQL}) AS d
        FROM hits LEFT JOIN embeddings ON id = vec_id),
    near AS (SELECT *, row_number() OVER (ORDER BY d NULLS LAST, id) AS rank FROM scored
             ORDER BY d NULLS LAST, id LIMIT 10)
    SELECT id, {tidy_sql('text_rank')} AS text_rank, {tidy_sql('1 - d')} AS similarity, rank,
           {tidy_sql('0.7 * coalesce(1 - d, 0) + 0.3 * text_rank')} AS final_score
    FROM near
"""


def _hybrid(df, query_vector, vectors=None):
    found = search.hybrid_search(df, QUERY_EN, query_vector, vectors, language="english")
    return longs(
        found.select(
            "id", tidy(F.col("text_rank")).alias("text_rank"),
            tidy(F.col("similarity")).alias("similarity"), "rank",
            tidy(F.col("final_score")).alias("final_score"),
        ),
        ["rank"],
    )


@query("j3_hybrid_search", _HYBRID_SQL)
def hybrid_search(spark, folder):
    return _hybrid(_texts(spark, folder), probe_vector(spark, folder), _vectors(spark, folder))


@query("j3_hybrid_search_one_table", _HYBRID_SQL)
def hybrid_one_table(spark, folder):
    return _hybrid(_corpus(spark, folder), probe_vector(spark, folder))


@query(
    "j3_hybrid_search_no_hit",
    f"SELECT doc_id AS id FROM ({L.ranked('zzqxv wwqzk', 'english')})",
)
def hybrid_no_hit(spark, folder):
    found = search.hybrid_search(
        _texts(spark, folder), "zzqxv wwqzk", probe_vector(spark, folder),
        _vectors(spark, folder), language="english",
    )
    return found.select("id")


# ------------------------------------------------------- j4 to j6 query modes

_LOG_SQL = """
    SELECT 'c' || conv_id || '-' || turn AS query_id, text AS query FROM conversations WHERE role = 'user'
    UNION ALL SELECT 'p' || p_partkey, p_name FROM part
"""
_NORMAL = f"regexp_replace(lower(query), '^{L.SPACE}+|{L.SPACE}+$', '', 'g')"
_MODE_SQL = f"""
    CASE WHEN starts_with(n, 'test:') OR starts_with(n, 'debug:') OR starts_with(n, 'random:')
              OR contains(n, 'performance') OR contains(n, 'benchmark') THEN 'text'
         WHEN len(string_split(n, ' ')) <= 2 THEN 'text'
         WHEN contains(n, 'comment') OR contains(n, 'pourquoi') OR contains(n, 'quelle est')
              OR len(n) > 50 THEN 'hybrid'
         ELSE 'vector' END
"""
_MODED_SQL = f"""
    SELECT query_id, query, {_MODE_SQL} AS mode
    FROM (SELECT query_id, query, {_NORMAL} AS n FROM ({_LOG_SQL}))
"""


def _log(spark, folder):
    turns = (
        load(spark, folder, "conversations")
        .filter(F.col("role") == "user")
        .select(
            F.concat(F.lit("c"), "conv_id", F.lit("-"), "turn").alias("query_id"),
            F.col("text").alias("query"),
        )
    )
    names = load(spark, folder, "part").select(
        F.concat(F.lit("p"), "p_partkey").alias("query_id"), F.col("p_name").alias("query")
    )
    return turns.unionByName(names)


@query("j4_detect_mode", f"SELECT query_id, mode FROM ({_MODED_SQL})")
def detect_mode(spark, folder):
    return search.detect_mode(_log(spark, folder)).select("query_id", "mode")


@query("j4_detect_mode_requested", f"SELECT query_id, 'vector' AS mode FROM ({_LOG_SQL})")
def detect_mode_requested(spark, folder):
    return search.detect_mode(_log(spark, folder), requested="vector").select("query_id", "mode")


@query(
    "j6_analyse_queries",
    f"""
    SELECT query_id, mode,
           CASE WHEN mode = 'text' AND words <= 2 THEN 0.8
                WHEN mode = 'hybrid' AND (contains(query, 'comment') OR len(query) > 50) THEN 0.9
                WHEN mode = 'vector' AND len(query) > 20 AND words > 2 THEN 0.7
                ELSE 0.5 END::DOUBLE AS confidence,
           concat_ws('; ', CASE WHEN words <= 2 THEN 'short query' END,
               CASE WHEN contains(query, 'comment') OR contains(query, 'pourquoi') THEN 'complex question' END,
               CASE WHEN starts_with(query, 'test:') OR starts_with(query, 'debug:') THEN 'test query' END,
               CASE WHEN len(query) > 100 THEN 'long query' END) AS reasons,
           (CASE WHEN words <= 2 THEN 1 ELSE 0 END
            + CASE WHEN contains(query, 'comment') OR contains(query, 'pourquoi') THEN 1 ELSE 0 END
            + CASE WHEN starts_with(query, 'test:') OR starts_with(query, 'debug:') THEN 1 ELSE 0 END
            + CASE WHEN len(query) > 100 THEN 1 ELSE 0 END)::BIGINT AS n_suggestions
    FROM (SELECT *, len(string_split(query, ' ')) AS words FROM ({_MODED_SQL}))
    """,
)
def analyse_queries(spark, folder):
    return search.analyse_queries(_log(spark, folder)).select(
        "query_id", "mode", "confidence",
        F.array_join("reasons", "; ").alias("reasons"),
        F.size("suggestions").cast("long").alias("n_suggestions"),
    )


_EMBED_QUERY = "ment tion que la vie"


@query(
    "j5_search_routed_vector",
    f"""
    WITH slots AS ({L.hashed_sql(f"SELECT 0 AS key, '{_EMBED_QUERY}' AS t", 64)}),
    q AS (SELECT list(coalesce(w, 0.0)::FLOAT::DOUBLE ORDER BY i) AS q
          FROM (SELECT unnest(range(64)) AS i) LEFT JOIN slots ON slot = i)
    SELECT vec_id AS id, 'vector' AS mode, {tidy_sql('d', 5)} AS distance
    FROM (SELECT vec_id, 1 - list_cosine_similarity(embedding::DOUBLE[], q) AS d FROM embeddings, q)
    ORDER BY d, vec_id LIMIT 10
    """,
)
def search_routed_vector(spark, folder):
    found = search.search(_vectors(spark, folder), _EMBED_QUERY, EMBEDDER)
    return found.select("id", "mode", tidy(F.col("distance"), 5).alias("distance"))


@query(
    "j5_search_routed_text",
    f"""
    SELECT doc_id AS id, 'text' AS mode, {tidy_sql('rank')} AS text_rank
    FROM ({L.ranked(QUERY_FR, 'french')}) ORDER BY rank DESC, doc_id LIMIT 10
    """,
)
def search_routed_text(spark, folder):
    found = search.search(_texts(spark, folder), QUERY_FR, EMBEDDER)
    return found.select("id", "mode", tidy(F.col("text_rank")).alias("text_rank"))


# More than fifty characters, so it is routed to hybrid search.
_LONG_QUERY = "ment tion, la ment et la tion: ment ment ment tion tion tion ?"


@query(
    "j5_search_routed_hybrid",
    f"""
    WITH slots AS ({L.hashed_sql(f"SELECT 0 AS key, '{_LONG_QUERY}' AS t", 64)}),
    q AS (SELECT list(coalesce(w, 0.0)::FLOAT::DOUBLE ORDER BY i) AS q
          FROM (SELECT unnest(range(64)) AS i) LEFT JOIN slots ON slot = i),
    hits AS (SELECT doc_id AS id, rank AS text_rank FROM ({L.ranked(_LONG_QUERY, 'french')})
             ORDER BY rank DESC, doc_id LIMIT 100),
    near AS (SELECT id, text_rank, 1 - list_cosine_similarity(embedding::DOUBLE[], q) AS d
             FROM (SELECT * FROM hits LEFT JOIN embeddings ON id = vec_id), q
             ORDER BY d NULLS LAST, id LIMIT 10)
    SELECT id, 'hybrid' AS mode, {tidy_sql('0.7 * coalesce(1 - d, 0) + 0.3 * text_rank', 5)} AS final_score
    FROM near
    """,
)
def search_routed_hybrid(spark, folder):
    found = search.search(_corpus(spark, folder), _LONG_QUERY, EMBEDDER)
    return found.select("id", "mode", tidy(F.col("final_score"), 5).alias("final_score"))


# ---------------------------------------------------------------- j7 and j12


@query(
    "j7_suggest",
    "SELECT DISTINCT text AS content FROM documents WHERE text ILIKE '%rewh that%' ORDER BY content LIMIT 5",
)
def suggest(spark, folder):
    return search.suggest(_texts(spark, folder), "rewh that")


@query(
    "j12_filtered_vector_search",
    f"""
    SELECT doc_id AS id, {tidy_sql('1 - d')} AS similarity
    FROM (SELECT doc_id, 1 - list_cosine_similarity(embedding::DOUBLE[], {PROBE_SQL}) AS d
          FROM ({L.ranked(QUERY_EN, 'english')}) JOIN embeddings ON doc_id = vec_id)
    ORDER BY d, doc_id LIMIT 10
    """,
)
def filtered_vector_search(spark, folder):
    both = _texts(spark, folder).join(_vectors(spark, folder), "id")
    found = search.filtered_vector_search(
        both, QUERY_EN, probe_vector(spark, folder), language="english"
    )
    return found.select("id", tidy(F.col("similarity")).alias("similarity"))


# ------------------------------------------------------- j8, d6, w2 in batch


def _register_batch(metric: str) -> None:
    # Every stored vector asks for its neighbours: a full nearest-neighbour join.
    @query(
        f"j8_batch_vector_search_{metric}",
        f"""
        SELECT query_id, id, {tidy_sql('d')} AS distance, position FROM (
            SELECT query_id, id, d, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 12), id) AS position
            FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, {_FORMULAS[metric]} AS d
                  FROM (SELECT vec_id, embedding::DOUBLE[] AS q FROM embeddings) a,
                       (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) b))
        WHERE position <= 5
        """,
    )
    def run(spark, folder):
        vectors = _vectors(spark, folder)
        asked = vectors.select(
            F.col("id").alias("query_id"), F.col("embedding").alias("query_vector")
        )
        found = batch.batch_vector_search(asked, vectors, 5, metric)
        return longs(
            found.select("query_id", "id", tidy(F.col("distance")).alias("distance"), "position"),
            ["position"],
        )


for _metric in vector.METRICS:
    _register_batch(_metric)


@query(
    "d6_queries_against_corpus",
    f"""
    SELECT query_id, id, {tidy_sql('d')} AS distance FROM (
        SELECT query_id, id, d, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 12), id) AS position
        FROM (SELECT a.vec_id AS query_id, b.vec_id AS id, list_distance(q, e) AS d
              FROM (SELECT vec_id, embedding::DOUBLE[] AS q FROM embeddings) a,
                   (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) b
              WHERE a.vec_id <> b.vec_id))
    WHERE position = 1
    """,
)
def queries_against_corpus(spark, folder):
    # In parts, as for a query table too large to share: the nearest
    # other vector is in the first two, the vector itself being one of them
    # unless two copies stand before it.
    vectors = _vectors(spark, folder)
    asked = vectors.select(
        F.col("id").alias("query_id"), F.col("embedding").alias("query_vector")
    )
    near = batch.batch_vector_search(
        asked, vectors, 2, "l2", max_shared_queries=100
    ).filter("query_id != id")
    first = top_per_group(
        near.drop("position"), ["query_id"], [F.col("distance").asc(), F.col("id").asc()], 1
    )
    return first.select("query_id", "id", tidy(F.col("distance")).alias("distance"))


@query(
    "w2_top_k_per_query",
    """
    SELECT label::BIGINT AS label, vec_id, position FROM (
        SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY embedding[1] DESC, vec_id) AS position
        FROM embeddings) WHERE position <= 3
    """,
)
def top_k_per_query(spark, folder):
    rows = load(spark, folder, "embeddings").withColumn("first", F.get("embedding", F.lit(0)))
    top = top_per_group(rows, ["label"], [F.desc("first"), F.col("vec_id").asc()], 3)
    return longs(top.select("label", "vec_id", "position"), ["label", "position"])


# The third and fourth word of every document ask for the documents that hold both.
_PAIRS_SQL = f"""
    SELECT doc_id AS query_id,
           array_to_string(list_slice(regexp_split_to_array(lower(text), '{text.WORD_GAP}'), 3, 4), ' ') AS query
    FROM documents
"""


def _word_pairs(spark, folder):
    # Splitting stops after the pieces that are needed.
    pair = F.array_join(F.slice(F.split(F.lower("text"), text.WORD_GAP, 6), 3, 2), " ")
    return load(spark, folder, "documents").select(
        F.col("doc_id").alias("query_id"), pair.alias("query")
    )


_BATCH_TEXT_SQL = f"""
    WITH asked AS (SELECT query_id, {L.terms_sql('query', 'french')} AS terms FROM ({_PAIRS_SQL})),
    docs AS (SELECT doc_id AS id, {L.lexemes_sql('text', 'french')} AS lex FROM documents),
    pairs AS (SELECT query_id, id, t, count(*) AS tf, any_value(len(terms)) AS n
              FROM (SELECT query_id, terms, unnest(terms) AS t FROM asked)
              JOIN (SELECT id, unnest(lex) AS t FROM docs) USING (t)
              GROUP BY query_id, id, t),
    ranked AS (SELECT query_id, id, sum(tf / (tf + 1.0)) / any_value(n) AS rank FROM pairs
               GROUP BY query_id, id HAVING count(*) = any_value(n))
"""


@query(
    "j8_batch_text_search",
    f"""
    {_BATCH_TEXT_SQL}
    SELECT query_id, id, {tidy_sql('rank')} AS text_rank, position
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(rank, 12) DESC, id) AS position FROM ranked)
    WHERE position <= 10
    """,
)
def batch_text_search(spark, folder):
    found = batch.batch_text_search(_word_pairs(spark, folder), _texts(spark, folder))
    return longs(
        found.select("query_id", "id", tidy(F.col("text_rank")).alias("text_rank"), "position"),
        ["position"],
    )


_ROUTED_SQL = f"""
    WITH moded AS ({_MODED_SQL}),
    asked AS (SELECT query_id, {L.terms_sql('query', 'french')} AS terms FROM moded WHERE mode <> 'vector'),
    docs AS (SELECT doc_id AS id, {L.lexemes_sql('text', 'french')} AS lex FROM documents),
    pairs AS (SELECT query_id, id, t, count(*) AS tf, any_value(len(terms)) AS n
              FROM (SELECT query_id, terms, unnest(terms) AS t FROM asked)
              JOIN (SELECT id, unnest(lex) AS t FROM docs) USING (t)
              GROUP BY query_id, id, t),
    ranked AS (SELECT query_id, id, round(sum(tf / (tf + 1.0)) / any_value(n), 12) AS rank FROM pairs
               GROUP BY query_id, id HAVING count(*) = any_value(n)),
    hits AS (SELECT query_id, mode, id, rank, row_number() OVER (PARTITION BY query_id ORDER BY rank DESC, id) AS p
             FROM ranked JOIN moded USING (query_id)),
    slots AS ({L.hashed_sql("SELECT query_id AS key, query AS t FROM (" + _MODED_SQL + ") WHERE mode <> 'text'", 64)}),
    q AS (SELECT query_id, mode, list(coalesce(w, 0.0)::FLOAT::DOUBLE ORDER BY i) AS q
          FROM (SELECT query_id, mode, unnest(range(64)) AS i FROM moded WHERE mode <> 'text')
          LEFT JOIN slots ON key = query_id AND slot = i GROUP BY query_id, mode),
    nearest AS (SELECT query_id, mode, vec_id AS id,
                       row_number() OVER (PARTITION BY query_id ORDER BY round(d, 12), vec_id) AS position
                FROM (SELECT query_id, mode, vec_id, 1 - list_cosine_similarity(embedding::DOUBLE[], q) AS d
                      FROM q, embeddings WHERE mode = 'vector' AND list_max(list_transform(q, lambda x: abs(x))) > 0)),
    scored AS (SELECT query_id, mode, id, rank, 1 - list_cosine_similarity(embedding::DOUBLE[], q) AS d
               FROM hits JOIN q USING (query_id, mode) LEFT JOIN embeddings ON id = vec_id
               WHERE mode = 'hybrid' AND p <= 100),
    near AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d NULLS LAST, id) AS place FROM scored),
    fused AS (SELECT query_id, mode, id, row_number() OVER (PARTITION BY query_id
                  ORDER BY 0.7 * coalesce(1 - d, 0) + 0.3 * rank DESC, id) AS position
              FROM near WHERE place <= 10)
    SELECT query_id, mode, id, p AS position FROM hits WHERE mode = 'text' AND p <= 10
    UNION ALL SELECT query_id, mode, id, position FROM nearest WHERE position <= 10
    UNION ALL SELECT query_id, mode, id, position FROM fused
"""


@query("j8_batch_search_routed", _ROUTED_SQL)
def batch_search_routed(spark, folder):
    found = batch.batch_search(
        _log(spark, folder), _texts(spark, folder), _vectors(spark, folder), EMBEDDER
    )
    return longs(found.select("query_id", "mode", "id", "position"), ["position"])


# ------------------------------------------------------ j9 and j10, e8 and e9

_RUNS_SQL = f"""
    SELECT mode, len(query)::DOUBLE AS ms, len(query) % 7 <> 0 AS ok FROM ({_MODED_SQL})
"""


def _runs(spark, folder):
    n = F.char_length("query")
    return search.detect_mode(_log(spark, folder)).select(
        "mode", n.cast("double").alias("ms"), (n % 7 != 0).alias("ok")
    )


_SUMMARY_SQL = f"""
    SELECT mode, count(*) AS runs, {tidy_sql('coalesce(sum(ms) FILTER (ok), 0) / count(*)')} AS avg_ms,
           {tidy_sql('avg(ms) FILTER (ok)')} AS avg_ok_ms,
           {tidy_sql('100.0 * count(*) FILTER (ok) / count(*)')} AS success_pct
    FROM ({_RUNS_SQL}) GROUP BY mode
"""


@query("j9_e8_mode_summary", _SUMMARY_SQL)
def mode_summary(spark, folder):
    found = batch.mode_summary(_runs(spark, folder))
    return found.select(
        "mode", "runs", *[tidy(F.col(c)).alias(c) for c in ("avg_ms", "avg_ok_ms", "success_pct")]
    )


@query(
    "e9_fastest_mode",
    f"""
    SELECT mode AS fastest, avg_ms FROM ({_SUMMARY_SQL})
    ORDER BY avg_ms, list_position(['text', 'vector', 'hybrid'], mode) DESC LIMIT 1
    """,
)
def fastest_mode(spark, folder):
    found = batch.fastest_mode(batch.mode_summary(_runs(spark, folder)))
    return found.select("fastest", tidy(F.col("avg_ms")).alias("avg_ms"))


@query(
    "j10_random_probe_search",
    f"""
    WITH q AS (SELECT list(-1 + ('0x' || substr(md5('42:0:' || i), 1, 8))::BIGINT / 4294967296.0 * 2 ORDER BY i) AS q
               FROM (SELECT unnest(range(64)) AS i))
    SELECT vec_id, {tidy_sql('d')} AS distance
    FROM (SELECT vec_id, 1 - list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]) AS d FROM embeddings, q)
    ORDER BY d, vec_id LIMIT 5
    """,
)
def random_probe_search(spark, folder):
    found = search.random_probe_search(load(spark, folder, "embeddings"), 64, key="vec_id")
    return found.select("vec_id", tidy(F.col("distance")).alias("distance"))


# ------------------------------------------------------------------- j11 lists


# The lists around the sixteen smallest ids, so that SQL can build them too.
_LISTS_SQL = """
    centres AS (SELECT vec_id AS list_id, embedding::DOUBLE[] AS c FROM embeddings ORDER BY vec_id LIMIT 16),
    listed AS (
        SELECT vec_id, embedding::DOUBLE[] AS e,
               (SELECT list_id FROM centres
                ORDER BY round(list_cosine_similarity(c, embedding::DOUBLE[]), 12) DESC, list_id LIMIT 1) AS list_id
        FROM embeddings)
"""


def _fixed_lists(spark, folder, path, **options):
    rows = load(spark, folder, "embeddings")
    first = rows.orderBy("vec_id").limit(16).select(
        F.col("vec_id").cast("int").alias("list_id"), F.col("embedding").cast("array<double>").alias("centre")
    )
    ann.ivf_build(rows, path, first, key="vec_id", **options)


@query(
    "j11_ivf_search",
    f"""
    WITH {_LISTS_SQL},
    probed AS (SELECT list_id FROM centres ORDER BY list_cosine_similarity(c, {PROBE_SQL}) DESC, list_id LIMIT 4)
    SELECT vec_id, {tidy_sql('d')} AS distance
    FROM (SELECT vec_id, 1 - list_cosine_similarity(e, {PROBE_SQL}) AS d FROM listed JOIN probed USING (list_id))
    ORDER BY d, vec_id LIMIT 10
    """,
)
def ivf_search(spark, folder):
    path = work_path(spark, "ivf")
    _fixed_lists(spark, folder, path)
    found = ann.ivf_search(spark, path, probe_vector(spark, folder), 10, 4, key="vec_id")
    return found.select("vec_id", tidy(F.col("distance")).alias("distance"))


def _every_fiftieth(rows):
    return rows.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))


@query(
    "j11_ivf_recall",
    """
    SELECT count(*) FILTER (vec_id % 50 = 0) AS n_queries,
           (count(*) FILTER (vec_id % 50 = 0) * least(10, count(*)))::BIGINT AS n_exact,
           true AS most_found
    FROM embeddings
    """,
)
def ivf_recall(spark, folder):
    # Learnt lists; every fiftieth vector is a query, against an exact search of all rows.
    path = work_path(spark, "ivf")
    rows = load(spark, folder, "embeddings")
    ann.ivf_build(rows, path, ann.learn_centres(rows, 16), key="vec_id")
    asked = _every_fiftieth(rows)
    exact = batch.batch_vector_search(asked, rows, 10, key="vec_id")
    some = ann.batch_ivf_search(asked, path, 10, 4, 12, key="vec_id")
    found = ann.mean_recall(exact, some, key="vec_id")
    return found.select("n_queries", "n_exact", (F.col("recall") >= 0.9).alias("most_found"))


@query("j11_ivf_recall_by_probes")
def ivf_recall_by_probes(spark, folder):
    """Recall as it falls out of the learnt lists, so there is no SQL for it."""
    path = work_path(spark, "ivf")
    rows = load(spark, folder, "embeddings")
    ann.ivf_build(rows, path, ann.learn_centres(rows, 16), key="vec_id")
    asked = _every_fiftieth(rows)
    exact = batch.batch_vector_search(asked, rows, 10, key="vec_id")
    figures = []
    for probes, most in ((2, 2), (4, 4), (8, 8), (4, 12), (2, None)):
        some = ann.batch_ivf_search(asked, path, 10, probes, most, key="vec_id")
        found = ann.mean_recall(exact, some, key="vec_id")
        figures.append(found.select(F.lit(probes).alias("probes"), F.lit(most).cast("int").alias("max_probes"), "n_queries", "recall"))
    return reduce(DataFrame.unionByName, figures)


@query(
    "j11_ivf_bounded_search",
    f"""
    SELECT vec_id, {tidy_sql('d')} AS distance
    FROM (SELECT vec_id, list_distance(embedding::DOUBLE[], {PROBE_SQL}) AS d FROM embeddings)
    ORDER BY d, vec_id LIMIT 10
    """,
)
def ivf_bounded_search(spark, folder):
    # Two lists first, then those that may hold a nearer row by their radius; half of the rows are appended.
    path = work_path(spark, "ivf")
    rows = load(spark, folder, "embeddings")
    centres = ann.learn_centres(rows, 16, "l2")
    ann.ivf_build(rows.filter("vec_id % 2 = 0"), path, centres, "l2", key="vec_id")
    ann.ivf_append(rows.filter("vec_id % 2 = 1"), path, "l2", key="vec_id")
    found = ann.ivf_search(spark, path, probe_vector(spark, folder), 10, 2, "l2", key="vec_id", bounded=True)
    return found.select("vec_id", tidy(F.col("distance")).alias("distance"))


@query(
    "j11_ivf_search_all_lists",
    f"""
    SELECT vec_id, {tidy_sql('d')} AS distance
    FROM (SELECT vec_id, 1 - list_cosine_similarity(embedding::DOUBLE[], {PROBE_SQL}) AS d FROM embeddings)
    ORDER BY d, vec_id LIMIT 10
    """,
)
def ivf_search_all_lists(spark, folder):
    # Probing every list must give the exact answer.
    path = work_path(spark, "ivf")
    _fixed_lists(spark, folder, path, rows_per_file=20)
    found = ann.ivf_search(spark, path, probe_vector(spark, folder), 10, 16, key="vec_id")
    return found.select("vec_id", tidy(F.col("distance")).alias("distance"))


# ------------------------------------------------- candidate joins and places


@query(
    "d3_candidate_join",
    f"""
    WITH hits AS (SELECT doc_id, rank FROM ({L.ranked(QUERY_EN, 'english')})
                  ORDER BY rank DESC, doc_id LIMIT 100)
    SELECT doc_id AS id, label::BIGINT AS label, {tidy_sql('rank')} AS text_rank
    FROM hits JOIN embeddings ON doc_id = vec_id
    """,
)
def candidate_join(spark, folder):
    hits = search.text_search(
        _texts(spark, folder), QUERY_EN, k=100, language="english", rank_name="text_rank"
    )
    vectors = load(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "label")
    ranks = hits.select("id", "text_rank")
    joined = search.join_candidates(ranks, [vectors], "id").filter(F.col("label").isNotNull())
    return longs(joined.select("id", "label", tidy(F.col("text_rank")).alias("text_rank")), ["label"])


@query(
    "w1_position_in_result",
    f"""
    SELECT vec_id, row_number() OVER (ORDER BY d, vec_id) AS position
    FROM (SELECT vec_id, list_distance(embedding::DOUBLE[], {PROBE_SQL}) AS d FROM embeddings)
    ORDER BY d, vec_id LIMIT 20
    """,
)
def position_in_result(spark, folder):
    found = search.vector_search(
        load(spark, folder, "embeddings"), probe_vector(spark, folder), 20, "l2", key="vec_id"
    )
    order = [F.asc_nulls_last("distance"), F.col("vec_id").asc()]
    return longs(search.add_positions(found, order).select("vec_id", "position"), ["position"])


@query(
    "o3_resort_by_score",
    f"""
    SELECT id, row_number() OVER (ORDER BY final_score DESC, id) AS place FROM ({_HYBRID_SQL})
    """,
)
def resort_by_score(spark, folder):
    found = _hybrid(_texts(spark, folder), probe_vector(spark, folder), _vectors(spark, folder))
    order = [F.desc("final_score"), F.col("id").asc()]
    return longs(search.add_positions(found, order, "place").select("id", "place"), ["place"])
