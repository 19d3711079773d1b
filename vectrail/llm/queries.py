"""One registered query per training-data operator, next to its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrail.llm import bpe, exact, hard_negatives, langid, line_dedup, mixing, quality, simhash, spelling, topk, toxicity, url_rules, vector_dedup, warc
from vectrail.llm.texts import third
from vectrail.session import work_path
from vectrail.sources.tables import load

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that must agree with it."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        LLM_QUERIES[name] = run
        if sql is not None:
            LLM_ORACLES[name] = sql
        return run

    return register


@query(
    "op1_line_dedup",
    """
    WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
    l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
    k AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM l),
    often AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
    m AS (SELECT k.*, often.key IS NOT NULL AS gone FROM k LEFT JOIN often ON k.key = often.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM m GROUP BY doc_id
    """,
)
def op1_line_dedup(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", "text")
    kept = line_dedup.drop_repeated_lines(documents, min_docs=10)
    return kept.select(
        "doc_id",
        F.col("_line_dedup_lines").alias("n_lines"),
        F.col("_line_dedup_dropped").alias("n_dropped"),
        F.sha2("_line_dedup_text", 256).alias("kept_sha256"),
    )


@query("op9_source_mixing")
def op9_source_mixing(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", "text", "source")
    mixed = mixing.mix(documents)
    return mixed.select(
        "doc_id",
        F.col("_mix_size").alias("size"),
        F.col("_mix_source_size").alias("source_size"),
        F.col("_mix_target").alias("target"),
        (F.col("_mix_copies") * F.col("_mix_size")).alias("taken"),
    )


@query("op7_simhash_near_dedup")
def op7_simhash_near_dedup(spark, folder):
    found = simhash.near_duplicates(load(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        F.col("_id").alias("doc_id"),
        simhash.fingerprint_text().alias("fingerprint"),
        "component_id",
    )


@query(
    "op8_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    d AS (SELECT page_id, h, strlen(h) AS n, sha1(h) AS x FROM p),
    b AS (
        SELECT page_id, n, x, list_aggregate(list_transform(range(0, 32), lambda i: substr(
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(x, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)),
            'string_agg', '') AS b32
        FROM d),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY x, n) AS top FROM b)
    SELECT page_id, n::BIGINT AS payload_bytes, b32 AS payload_digest,
           CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id <> top THEN top END AS refers_to
    FROM m
    """,
)
def op8_warc(spark, folder):
    path = work_path(spark, "warc")
    warc.write_warc(load(spark, folder, "pages"), path)
    return warc.page_records(spark, path)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op6_bpe")
def op6_bpe(spark, folder):
    path = tokenizer_path()
    documents = load(spark, folder, "documents").select("doc_id", "text")
    return bpe.encode_and_decode(documents, path).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.ids_text("token_ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_toxicity")
def op2_toxicity(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(documents, load(spark, folder, "labels").select("doc_id", "toxic"))
    scored = toxicity.score(documents, model)
    return scored.select(
        F.col("_id").alias("doc_id"),
        (third("_id") == 1).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.OPERATING_SCORE).cast("int").alias("predicted"),
    )


@query("op5_language_id")
def op5_language_id(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", "text", "lang")
    model = langid.train(documents)
    return langid.score(documents.select("doc_id", "text"), model).select(
        "doc_id",
        (third("doc_id") == 1).alias("held_out"),
        F.col("_lang_pred").alias("lang_pred"),
        F.col("_lang_score").alias("score"),
    )


@query(
    "op3_exact_top_k",
    """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
)
def op3_exact_top_k(spark, folder):
    rows = load(spark, folder, "embeddings").select("vec_id", topk.scaled(F.col("embedding")).alias("vector"))
    return topk.top_k(rows.filter(F.col("vec_id") % 100 == 0), rows, 10)


@query(
    "op10_vector_near_dedup",
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
    reach AS (
        SELECT vec_id AS a, vec_id AS b FROM embeddings
        UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
    counted AS (SELECT a, count(*) AS n FROM links GROUP BY a),
    smallest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, smallest.b AS component_id, smallest.b = vec_id AS kept
    FROM embeddings LEFT JOIN counted ON counted.a = vec_id JOIN smallest ON smallest.a = vec_id
    """,
)
def op10_vector_near_dedup(spark, folder):
    found = vector_dedup.near_duplicates(load(spark, folder, "embeddings"))
    return found.select(F.col("_id").alias("vec_id"), "n_links", "component_id", "kept")


@query("op4_quality")
def op4_quality(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(documents, load(spark, folder, "labels").select("doc_id", "quality"))
    top = F.coalesce(F.try_element_at("reach", F.lit(-1)), F.lit(0.0))
    return quality.score(documents, model).select(
        F.col("_id").alias("doc_id"),
        (third("_id") == 1).alias("held_out"),
        "expected_grade",
        top.alias("tail_probability"),
        (top >= 0.5).alias("selected"),
    )


# The rules that op11_url_filters applies.
URL_RULES = """
    SELECT * FROM VALUES
        ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
    AS rules(host, path, verdict)
"""


@query(
    "op11_url_filters",
    """
    WITH u AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
    p AS (
        SELECT page_id, coalesce(regexp_extract(rest, '^[^/?#]*', 0), '') AS h,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM u),
    h AS (
        SELECT page_id, path,
               translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM p),
    r(rule_host, rule_path, verdict) AS (
        VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
               ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    f AS (
        SELECT page_id, rule_host || rule_path AS rule, verdict FROM h JOIN r
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
    best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
             FROM f GROUP BY page_id)
    SELECT h.page_id, host, path, best.rule, coalesce(best.verdict, 'allow') AS verdict
    FROM h LEFT JOIN best ON h.page_id = best.page_id
    """,
)
def op11_url_filters(spark, folder):
    pages = load(spark, folder, "pages").select("page_id", "url")
    judged = url_rules.judge_urls(pages, spark.sql(URL_RULES))
    return judged.select("row.page_id", "host", "path", "rule", "verdict")


@query(
    "op12_hard_negatives",
    """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, o.vec_id AS id, a.label = o.label AS same,
                 list_inner_product(a.e, o.e)::BIGINT AS score
          FROM v a JOIN v o ON a.vec_id % 50 = 0 AND o.vec_id <> a.vec_id),
    p AS (SELECT anchor_id, id AS positive_id, score AS positive_score,
                 row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS place FROM s WHERE same),
    n AS (SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id)::INT AS rank
          FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
               AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
          WHERE place <= 5)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
    """,
)
def op12_hard_negatives(spark, folder):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = load(spark, folder, "embeddings").select(
        "vec_id", moved.alias("label"), exact.floored(F.col("embedding"), 256.0).alias("vector")
    )
    return hard_negatives.hard_negatives(rows.filter(F.col("vec_id") % 50 == 0), rows)


# crc32 by its table: 3988292384 is the reversed polynomial.
@query(
    "op13_spelling_variants",
    """
    WITH RECURSIVE steps AS (
        SELECT list(c ORDER BY i) AS t FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b:
                CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS c
            FROM (SELECT unnest(range(256)) AS i))),
    runs AS (
        SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
        FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
        WHERE length(run) >= 7 GROUP BY ALL),
    hashed AS (
        SELECT run, n, xor(list_reduce(
            list_prepend(4294967295, list_transform(range(0, strlen(k)), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
            lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1])), 4294967295) AS h
        FROM (SELECT run, n, coalesce(doc_id::VARCHAR, '') || ':' || run AS k, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs), steps),
    words AS (
        SELECT word, sum(n)::BIGINT AS n FROM (
            SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                      ELSE run END AS word FROM hashed)
        WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    gaps AS (
        SELECT word, i, substr(word, 1, i::INT) || substr(word, i::INT + 2) AS gap
        FROM (SELECT word, unnest(range(0, length(word))) AS i FROM words)),
    near AS (
        SELECT a.word, b.word AS near FROM gaps a JOIN gaps b ON a.i = b.i AND a.gap = b.gap AND a.word <> b.word
        UNION SELECT g.word, w.word FROM gaps g JOIN words w ON g.gap = w.word
        UNION SELECT w.word, g.word FROM gaps g JOIN words w ON g.gap = w.word),
    best AS (
        SELECT near.word, count(*) AS n_near, max(n) AS top, arg_min(near, (-n, near)) AS form
        FROM near JOIN words o ON near.near = o.word GROUP BY near.word),
    formed AS (
        SELECT words.word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top >= 10 * n THEN form END AS form,
               CASE WHEN top >= 10 * n THEN top END::BIGINT AS form_n
        FROM words LEFT JOIN best USING (word)),
    walk AS (
        SELECT word, form AS at FROM formed WHERE form IS NOT NULL
        UNION ALL SELECT walk.word, formed.form FROM walk JOIN formed ON walk.at = formed.word WHERE formed.form IS NOT NULL),
    roots AS (SELECT walk.word, walk.at AS root FROM walk JOIN formed ON walk.at = formed.word WHERE formed.form IS NULL)
    SELECT formed.word, n, n_near, form, form_n, coalesce(root, formed.word) AS root
    FROM formed LEFT JOIN roots ON formed.word = roots.word
    """,
)
def op13_spelling_variants(spark, folder):
    documents = load(spark, folder, "documents").select("doc_id", "text")
    return spelling.variants(spelling.word_counts(documents, min_chars=7, min_count=2, noise_every=31))


@query("pipeline")
def pipeline(spark, folder):
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, folder)
