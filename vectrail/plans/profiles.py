"""Queries over table and vector profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from vectrail.operators import profile as P
from vectrail.plans.registry import longs, query, tidy, tidy_sql
from vectrail.sources.tables import corpus, load

# Column names and types of the given tables, as Spark names them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _columns():
    for table, text in SCHEMAS.items():
        for position, item in enumerate(text.split(", "), 1):
            name, kind = item.split(" ")
            yield table, name, kind, position


def _profile_sql(distinct: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{k}' AS data_type, true AS nullable, "
        f"{p}::BIGINT AS position, count(*) AS n_rows, count({c}) AS n_filled, "
        f"count(*) - count({c}) AS n_null, {distinct.format(c=c)} AS n_distinct FROM {t}"
        for t, c, k, p in _columns()
    )


def _tables(spark, folder):
    return {name: load(spark, folder, name) for name in SCHEMAS}


@query("b1_table_profile", _profile_sql("count(DISTINCT {c})"))
def table_profile(spark, folder):
    return longs(P.table_profile(_tables(spark, folder), "exact"), ["position"])


@query("b1_table_profile_counts", _profile_sql("NULL::BIGINT"))
def table_profile_counts(spark, folder):
    return longs(P.table_profile(_tables(spark, folder), None), ["position"])


@query(
    "b2_table_overview",
    f"""
    SELECT table_name, count(*) AS n_columns, max(n_rows) AS n_rows, 'table' AS kind
    FROM ({_profile_sql('NULL::BIGINT')}) GROUP BY table_name
    """,
)
def table_overview(spark, folder):
    return P.table_overview(P.table_profile(_tables(spark, folder), None))


@query(
    "b2_number_of_tables",
    f"SELECT count(DISTINCT table_name) AS n_tables, sum(n_rows)::BIGINT AS n_rows FROM "
    f"(SELECT table_name, max(n_rows) AS n_rows FROM ({_profile_sql('NULL::BIGINT')}) GROUP BY table_name)",
)
def number_of_tables(spark, folder):
    overview = P.table_overview(P.table_profile(_tables(spark, folder), None))
    return overview.agg(F.count("*").alias("n_tables"), F.sum("n_rows").alias("n_rows"))


_FILLED = "documents LEFT JOIN embeddings ON doc_id = vec_id"


def _corpus(spark, folder):
    return corpus(load(spark, folder, "documents"), load(spark, folder, "embeddings"))


@query(
    "b3_vector_columns",
    f"""
    SELECT table_name, 'embedding' AS column_name, avg(len(embedding)) AS avg_dims,
           min(len(embedding))::BIGINT AS min_dims, max(len(embedding))::BIGINT AS max_dims,
           {tidy_sql('count(embedding) / count(*)')} AS filled_share
    FROM (SELECT 'corpus' AS table_name, embedding FROM {_FILLED}
          UNION ALL SELECT 'embeddings', embedding FROM embeddings)
    GROUP BY table_name
    """,
)
def vector_columns(spark, folder):
    tables = {**_tables(spark, folder), "corpus": _corpus(spark, folder)}
    found = P.vector_columns(tables).withColumn("filled_share", tidy(F.col("filled_share")))
    return longs(found, ["min_dims", "max_dims"])


@query(
    "b4_vector_stats",
    f"""
    SELECT count(*) AS n_rows, count(embedding) AS n_filled,
           count(*) FILTER (embedding IS NULL) AS n_null FROM {_FILLED}
    """,
)
def vector_stats(spark, folder):
    return P.vector_stats(_corpus(spark, folder))


@query(
    "b5_average_dimensions",
    f"SELECT count(*) AS n_rows, avg(len(embedding)) AS avg_dims FROM {_FILLED} WHERE embedding IS NOT NULL",
)
def average_dimensions(spark, folder):
    return P.dimension_stats(_corpus(spark, folder))


@query(
    "b6_diagnose",
    f"""
    WITH s AS (SELECT count(*) AS n, count(embedding) AS filled FROM {_FILLED})
    SELECT 'vector column' AS "check", true AS ok, 'embedding' AS detail, NULL::VARCHAR AS suggestion FROM s
    UNION ALL SELECT 'support columns', true, 'content, id', NULL FROM s
    UNION ALL SELECT 'row count', n > 0, n::VARCHAR, NULL FROM s
    UNION ALL SELECT 'null vectors', n = filled, (n - filled)::VARCHAR,
                     CASE WHEN n <> filled THEN 'run backfill' END FROM s
    UNION ALL SELECT 'standard dimension', false, '64', 'check the model in use' FROM s
    """,
)
def diagnose(spark, folder):
    return P.diagnose(_corpus(spark, folder))


@query(
    "b6_diagnose_without_vectors",
    """
    SELECT 'vector column' AS "check", false AS ok, 'embedding' AS detail, 'add it with add_vector_column' AS suggestion FROM labels
    UNION SELECT 'support columns', false, '', 'add content or metadata' FROM labels
    UNION SELECT 'row count', true, (SELECT count(*) FROM labels)::VARCHAR, NULL FROM labels
    UNION SELECT 'null vectors', false, (SELECT count(*) FROM labels)::VARCHAR, 'run backfill' FROM labels
    UNION SELECT 'standard dimension', false, '', 'check the model in use' FROM labels
    """,
)
def diagnose_without_vectors(spark, folder):
    return P.diagnose(load(spark, folder, "labels"))
