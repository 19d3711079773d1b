"""Queries over scans, table creation and table rewrites."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectrail.operators import tables as M
from vectrail.plans.embedding import STORED_CHECK_SQL, checksum
from vectrail.plans.registry import PROBE_SQL, longs, probe_vector, query, tidy_sql
from vectrail.session import work_path
from vectrail.sources.tables import load, read_table, write_table


def _vectors(spark, folder):
    return load(spark, folder, "embeddings").withColumnRenamed("vec_id", "id")


@query("a1_table_scan", "SELECT * FROM customer")
def table_scan(spark, folder):
    return read_table(spark, f"{folder}/customer.parquet")


@query(
    "a1_table_scan_by_name",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier",
)
def table_scan_by_name(spark, folder):
    load(spark, folder, "supplier").createOrReplaceTempView("vectrail_supplier")
    return read_table(spark, "vectrail_supplier")


@query(
    "a2_select_columns",
    "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem WHERE l_tax > 0.05",
)
def select_columns(spark, folder):
    return read_table(
        spark,
        f"{folder}/lineitem.parquet",
        ["l_orderkey", "l_linenumber", "l_extendedprice * (1 - l_discount) AS net"],
        "l_tax > 0.05",
    )


@query(
    "a3_inline_relation",
    """
    SELECT e.vec_id, p.position, e.label
    FROM embeddings e JOIN (VALUES (7::BIGINT, 1::BIGINT), (340, 2), (425, 3)) AS p(vec_id, position) USING (vec_id)
    """,
)
def inline_relation(spark, folder):
    places = spark.createDataFrame([(7, 1), (340, 2), (425, 3)], "vec_id long, position long")
    rows = load(spark, folder, "embeddings")
    # Three fixed rows, so the broadcast does not grow.
    return rows.join(F.broadcast(places), "vec_id").select("vec_id", "position", "label")


@query(
    "a4_create_vector_table",
    "SELECT vec_id AS id, len(embedding)::BIGINT AS n_dims, 64::BIGINT AS declared FROM embeddings",
)
def create_vector_table(spark, folder):
    path = work_path(spark, "vectors")
    note = T.StructType([T.StructField("label", T.IntegerType())])
    M.create_vector_table(spark, path, 64, extra=note)
    table = M.create_vector_table(spark, path, 32)  # a second call changes nothing
    declared = table.schema["embedding"].metadata["vector_dim"]
    grown = M.append_rows(table, _vectors(spark, folder))
    return grown.select(
        "id", F.size("embedding").cast("long").alias("n_dims"), F.lit(declared).cast("long").alias("declared")
    )


@query(
    "a5_add_vector_column",
    "SELECT doc_id, lang, true AS empty, 64::BIGINT AS declared FROM documents",
)
def add_vector_column(spark, folder):
    table = M.add_vector_column(load(spark, folder, "documents"), dims=64)
    declared = table.schema["embedding"].metadata["vector_dim"]
    return table.select(
        "doc_id", "lang", F.col("embedding").isNull().alias("empty"),
        F.lit(declared).cast("long").alias("declared"),
    )


@query(
    "a6_change_dimension",
    f"SELECT vec_id AS id, {STORED_CHECK_SQL} AS checksum FROM embeddings",
)
def change_dimension(spark, folder):
    table = M.change_dimension(_vectors(spark, folder), "embedding", 64)
    return table.select("id", checksum(F.col("embedding")).alias("checksum"))


@query(
    "a7_append_rows",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL
    SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey),
           s_name, s_nationkey, s_acctbal, 'NONE' FROM supplier
    """,
)
def append_rows(spark, folder):
    new = load(spark, folder, "supplier").selectExpr(
        "s_suppkey", "s_name AS c_name", "s_nationkey AS c_nationkey", "s_acctbal AS c_acctbal"
    )
    return M.append_rows(
        load(spark, folder, "customer"), new, "c_custkey", "s_suppkey",
        {"c_mktsegment": F.lit("NONE")},
    )


@query(
    "a7_append_row_with_default_time",
    """
    SELECT vec_id AS id, label, false AS stamped FROM embeddings
    UNION ALL SELECT max(vec_id) + 1, 9, true FROM embeddings
    """,
)
def append_row(spark, folder):
    base = _vectors(spark, folder).withColumn("created_at", F.lit(None).cast("timestamp"))
    new = spark.createDataFrame([(1, 9)], "item long, label int")
    grown = M.append_rows(base, new, "id", "item", {"created_at": F.current_timestamp()})
    return grown.select("id", "label", F.col("created_at").isNotNull().alias("stamped"))


@query(
    "a8_append_vector",
    f"""
    SELECT vec_id AS id, {STORED_CHECK_SQL} AS checksum, NULL::VARCHAR AS content, NULL::VARCHAR AS metadata
    FROM embeddings
    UNION ALL SELECT max(vec_id) + 1, (SELECT {STORED_CHECK_SQL} FROM embeddings WHERE vec_id = 7),
                     'copy of seven', '{{"source":"seven"}}' FROM embeddings
    """,
)
def append_vector(spark, folder):
    base = _with_support(_vectors(spark, folder))
    item = spark.createDataFrame(
        [(1, probe_vector(spark, folder), "copy of seven", {"source": "seven"})],
        "item long, embedding array<float>, content string, metadata map<string,string>",
    )
    grown = M.append_vectors(base, item)
    return grown.select("id", checksum(F.col("embedding")).alias("checksum"), "content", "metadata")


def _with_support(df):
    empty = F.lit(None).cast("string")
    return df.withColumn("content", empty).withColumn("metadata", empty)


@query(
    "a9_batch_append",
    """
    SELECT vec_id AS id, NULL::VARCHAR AS content, NULL::VARCHAR AS metadata FROM embeddings
    UNION ALL
    SELECT (SELECT max(vec_id) FROM embeddings) + row_number() OVER (ORDER BY doc_id), text, NULL
    FROM documents JOIN embeddings ON doc_id = vec_id
    """,
)
def batch_append(spark, folder):
    # Every item has content but only some have metadata, which is left out.
    texts = load(spark, folder, "documents").withColumnRenamed("doc_id", "item")
    vectors = load(spark, folder, "embeddings").withColumnRenamed("vec_id", "item")
    metadata = F.when(F.col("lang") == "fr", F.create_map(F.lit("lang"), "lang"))
    items = texts.join(vectors, "item").select(
        "item", "embedding", F.col("text").alias("content"), metadata.alias("metadata")
    )
    base = _with_support(_vectors(spark, folder))
    return M.append_vectors(base, items).select("id", "content", "metadata")


@query(
    "a11_update_vectors",
    f"""
    SELECT vec_id AS id, CASE WHEN label = 3 THEN (SELECT {STORED_CHECK_SQL} FROM embeddings WHERE vec_id = 7)
                              ELSE {STORED_CHECK_SQL} END AS checksum FROM embeddings
    """,
)
def update_vectors(spark, folder):
    done = M.vector_update(_vectors(spark, folder), probe_vector(spark, folder), "label = 3")
    return done.select("id", checksum(F.col("embedding")).alias("checksum"))


@query(
    "a11_a12_affected_rows",
    """
    SELECT count(*) FILTER (label = 3) AS n_affected, count(*) FILTER (label <> 3) AS n_remaining FROM embeddings
    """,
)
def affected_rows(spark, folder):
    return M.affected(_vectors(spark, folder), "label = 3")


@query(
    "a12_delete_where",
    """
    SELECT doc_id, label::BIGINT AS label FROM documents LEFT JOIN embeddings ON doc_id = vec_id
    WHERE label >= 5 OR label IS NULL
    """,
)
def delete_where(spark, folder):
    # The predicate is NULL for documents without a vector, which stay.
    vectors = load(spark, folder, "embeddings").withColumnRenamed("vec_id", "doc_id")
    both = load(spark, folder, "documents").join(vectors, "doc_id", "left")
    return longs(M.delete_where(both, "label < 5").select("doc_id", "label"), ["label"])


@query(
    "a13_store_changed_table",
    f"""
    SELECT label::BIGINT AS label, count(*) AS n, {tidy_sql(f'min(list_distance(embedding::DOUBLE[], {PROBE_SQL}))')} AS nearest
    FROM embeddings WHERE label <> 3 GROUP BY label
    """,
)
def store_changed_table(spark, folder):
    from vectrail.functions.vector import distance_to
    from vectrail.plans.registry import tidy

    changed = M.delete_where(_vectors(spark, folder), "label = 3")
    stored = write_table(changed, work_path(spark, "changed"), ["label"])
    near = distance_to(F.col("embedding"), probe_vector(spark, folder), "l2")
    return longs(
        stored.groupBy("label").agg(F.count("*").alias("n"), tidy(F.min(near)).alias("nearest")),
        ["label"],
    )
