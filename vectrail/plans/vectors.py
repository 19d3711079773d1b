"""Queries over the vector functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from vectrail.functions import vector
from vectrail.operators.profile import validate_vectors, vector_flags
from vectrail.plans.registry import PROBE_SQL, longs, probe_vector, query, tidy, tidy_sql
from vectrail.sources.tables import load

_DISTANCES = {
    "cosine": ("v1_cosine_distance", "1 - list_cosine_similarity(e, q)"),
    "l2": ("v2_l2_distance", "list_distance(e, q)"),
    "inner_product": ("v3_negative_inner_product", "-list_inner_product(e, q)"),
}


def _register_distance(metric: str, name: str, formula: str) -> None:
    @query(
        name,
        f"""
        SELECT vec_id, {tidy_sql('d')} AS distance, {tidy_sql('1 - d')} AS similarity
        FROM (SELECT vec_id, {formula} AS d
              FROM (SELECT vec_id, embedding::DOUBLE[] AS e, {PROBE_SQL} AS q FROM embeddings))
        """,
    )
    def run(spark, folder):
        # v4: the similarity is one minus the distance for every metric
        rows = load(spark, folder, "embeddings")
        d = vector.distance_to(F.col("embedding"), probe_vector(spark, folder), metric)
        return rows.select("vec_id", d.alias("d")).select(
            "vec_id",
            tidy(F.col("d")).alias("distance"),
            tidy(vector.similarity(F.col("d"))).alias("similarity"),
        )


for _metric, (_name, _formula) in _DISTANCES.items():
    _register_distance(_metric, _name, _formula)


@query(
    "v4_similarity_summary",
    f"""
    SELECT label::BIGINT AS label, {tidy_sql('max(c)')} AS best_cosine,
           {tidy_sql('max(l)')} AS best_l2, {tidy_sql('max(i)')} AS best_inner_product
    FROM (SELECT label, list_cosine_similarity(e, q) AS c, 1 - list_distance(e, q) AS l,
                 1 + list_inner_product(e, q) AS i
          FROM (SELECT label, embedding::DOUBLE[] AS e, {PROBE_SQL} AS q FROM embeddings))
    GROUP BY label
    """,
)
def similarity_summary(spark, folder):
    probe = probe_vector(spark, folder)
    v = F.col("embedding")
    best = [
        tidy(F.max(vector.similarity(vector.distance_to(v, probe, m)))).alias(f"best_{m}")
        for m in vector.METRICS
    ]
    return longs(load(spark, folder, "embeddings").groupBy("label").agg(*best), ["label"])


@query(
    "v5_v6_dimensions_and_norm",
    f"""
    SELECT vec_id, len(embedding)::BIGINT AS n_dims,
           {tidy_sql('sqrt(list_inner_product(e, e))')} AS norm
    FROM (SELECT vec_id, embedding, embedding::DOUBLE[] AS e FROM embeddings)
    """,
)
def dimensions_and_norm(spark, folder):
    v = F.col("embedding")
    return load(spark, folder, "embeddings").select(
        "vec_id",
        vector.dims(v).cast("long").alias("n_dims"),
        tidy(vector.norm(v)).alias("norm"),
    )


_SCALES = {
    "l2": ("v7_normalise_l2", "sqrt(list_inner_product(e, e))", "0"),
    "max": ("v8_normalise_max", "list_max(list_transform(e, lambda x: abs(x)))", "0"),
    "minmax": ("v9_normalise_minmax", "list_max(e) - list_min(e)", "list_min(e)"),
    "sum": ("v10_normalise_sum", "list_sum(list_transform(e, lambda x: abs(x)))", "0"),
}


def _register_scale(method: str, name: str, span: str, low: str) -> None:
    @query(
        name,
        f"""
        SELECT vec_id, n[1] AS first_value, n[64] AS last_value,
               {tidy_sql('list_sum(n)', 4)} AS total,
               {tidy_sql('sqrt(list_inner_product(n, n))', 4)} AS new_norm
        FROM (SELECT vec_id, list_transform(e, lambda x: {tidy_sql(f'(x - {low}) / ({span})', 4)}) AS n
              FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings))
        """,
    )
    def run(spark, folder):
        # v11: the new norm comes from the rounded elements
        scaled = vector.normalise(F.col("embedding"), method, 4)
        shown = F.transform(scaled, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
        n = F.col("n")
        return (
            load(spark, folder, "embeddings")
            .select("vec_id", shown.alias("n"))
            .select(
                "vec_id",
                F.get(n, F.lit(0)).alias("first_value"),
                F.get(n, F.lit(63)).alias("last_value"),
                tidy(F.aggregate(n, F.lit(0.0), lambda acc, x: acc + x), 4).alias("total"),
                tidy(vector.norm(n), 4).alias("new_norm"),
            )
        )


for _method, (_name, _span, _low) in _SCALES.items():
    _register_scale(_method, _name, _span, _low)


@query(
    "v11_round_then_norm",
    f"""
    SELECT label::BIGINT AS label, {tidy_sql('avg(sqrt(list_inner_product(n, n)))')} AS mean_norm,
           {tidy_sql('min(n[1])', 2)} AS least_first
    FROM (SELECT label, list_transform(embedding::DOUBLE[], lambda x: round(x, 2)) AS n FROM embeddings)
    GROUP BY label
    """,
)
def round_then_norm(spark, folder):
    n = F.transform("embedding", lambda x: F.round(x.cast("double"), 2))
    return longs(
        load(spark, folder, "embeddings")
        .select("label", n.alias("n"))
        .groupBy("label")
        .agg(
            tidy(F.avg(vector.norm(F.col("n")))).alias("mean_norm"),
            tidy(F.min(F.get("n", F.lit(0))), 2).alias("least_first"),
        ),
        ["label"],
    )


_DRAW = (
    "-1 + ('0x' || substr(md5(concat_ws(':', '42', vec_id, i)), 1, 8))::BIGINT / 4294967296.0 * 2"
)


@query(
    "v12_random_vectors",
    f"""
    SELECT vec_id, {tidy_sql('max(x) FILTER (i = 0)')} AS raw_first,
           {tidy_sql('max(x) FILTER (i = 0) / sqrt(sum(x * x))')} AS first_value,
           {tidy_sql('max(x) FILTER (i = 31) / sqrt(sum(x * x))')} AS last_value
    FROM (SELECT vec_id, i, {_DRAW} AS x
          FROM embeddings, (SELECT unnest(range(32)) AS i))
    GROUP BY vec_id
    """,
)
def random_vectors(spark, folder):
    key = F.col("vec_id")
    return (
        load(spark, folder, "embeddings")
        .select(
            key,
            vector.random_vector(key, 32, unit=False).alias("raw"),
            vector.random_vector(key, 32).alias("unit"),
        )
        .select(
            key,
            tidy(F.get("raw", F.lit(0))).alias("raw_first"),
            tidy(F.get("unit", F.lit(0))).alias("first_value"),
            tidy(F.get("unit", F.lit(31))).alias("last_value"),
        )
    )


# Vectors cut short, emptied, or holding NaN and infinity, made from the table.
_DAMAGED = """
    SELECT vec_id, CASE WHEN vec_id % 10 = 1 THEN embedding[1:32]
                        WHEN vec_id % 10 = 2 THEN []::FLOAT[]
                        WHEN vec_id % 10 = 3 THEN list_concat(embedding[1:63], ['nan'::FLOAT])
                        WHEN vec_id % 10 = 4 THEN list_concat(embedding[1:63], ['infinity'::FLOAT])
                        WHEN vec_id % 10 = 5 THEN NULL
                        ELSE embedding END AS v
    FROM embeddings
"""


def _damaged(spark, folder):
    v, digit = F.col("embedding"), F.col("vec_id") % 10

    def ending(value: str):
        return F.concat(F.slice(v, 1, 63), F.array(F.lit(value).cast("float")))

    return load(spark, folder, "embeddings").select(
        "vec_id",
        F.when(digit == 1, F.slice(v, 1, 32))
        .when(digit == 2, F.array().cast("array<float>"))
        .when(digit == 3, ending("NaN"))
        .when(digit == 4, ending("Infinity"))
        .when(digit == 5, F.lit(None).cast("array<float>"))
        .otherwise(v)
        .alias("v"),
    )


_FLAGS_SQL = f"""
    SELECT vec_id, len(v)::BIGINT AS n_dims, v IS NULL AS is_null,
           coalesce(len(v) = 0, false) AS is_empty,
           coalesce(list_bool_or(list_transform(v, lambda x: isnan(x))), false) AS has_nan,
           coalesce(list_bool_or(list_transform(v, lambda x: isinf(x))), false) AS has_infinity,
           coalesce(len(v) > 0 AND len(v) <> 64, false) AS wrong_dims
    FROM ({_DAMAGED})
"""


@query("v13_vector_flags", _FLAGS_SQL)
def damaged_flags(spark, folder):
    flagged = vector_flags(_damaged(spark, folder), "v", 64).drop("v", "has_null")
    return longs(flagged, ["n_dims"])


@query(
    "v13_validate_vectors",
    f"""
    SELECT count(*) AS n_vectors, count(*) FILTER (is_null) AS n_null,
           count(*) FILTER (is_empty) AS n_empty, 0::BIGINT AS n_with_null,
           count(*) FILTER (has_nan) AS n_nan,
           count(*) FILTER (has_infinity) AS n_infinity,
           count(*) FILTER (wrong_dims) AS n_wrong_dims,
           count(DISTINCT n_dims) FILTER (n_dims > 0) AS n_lengths,
           min(n_dims) FILTER (n_dims > 0) AS min_dims, max(n_dims) FILTER (n_dims > 0) AS max_dims,
           false AS compatible
    FROM ({_FLAGS_SQL})
    """,
)
def validate_damaged(spark, folder):
    return longs(validate_vectors(_damaged(spark, folder), "v", 64), ["min_dims", "max_dims"])


@query(
    "v13_validate_clean_table",
    """
    SELECT count(*) AS n_vectors, count(DISTINCT len(embedding)) AS n_lengths,
           count(DISTINCT len(embedding)) = 1 AS compatible
    FROM embeddings
    """,
)
def validate_clean(spark, folder):
    return validate_vectors(load(spark, folder, "embeddings")).select(
        "n_vectors", "n_lengths", "compatible"
    )


@query(
    "v14_vector_text_form",
    """
    SELECT vec_id, starts_with(t, '[') AND ends_with(t, ']') AS bracketed,
           (len(t) - len(replace(t, ',', '')) + 1)::BIGINT AS n_parts, true AS same
    FROM (SELECT vec_id, '[' || array_to_string(embedding, ',') || ']' AS t FROM embeddings)
    """,
)
def vector_text_form(spark, folder):
    t = F.col("t")
    return (
        load(spark, folder, "embeddings")
        .withColumn("t", vector.to_text(F.col("embedding")))
        .select(
            "vec_id",
            (t.startswith("[") & t.endswith("]")).alias("bracketed"),
            (F.length(t) - F.length(F.replace(t, F.lit(","), F.lit(""))) + 1)
            .cast("long")
            .alias("n_parts"),
            (vector.from_text(t) == F.col("embedding")).alias("same"),
        )
    )


@query(
    "v15_zero_vector",
    """
    SELECT vec_id, 64::BIGINT AS n_dims, 0.0::DOUBLE AS norm, true AS no_cosine
    FROM embeddings
    """,
)
def zero_vector(spark, folder):
    z = vector.zeros(64)
    return load(spark, folder, "embeddings").select(
        "vec_id",
        vector.dims(z).cast("long").alias("n_dims"),
        vector.norm(z).alias("norm"),
        vector.cosine_distance(F.col("embedding"), z).isNull().alias("no_cosine"),
    )
