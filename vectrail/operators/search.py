"""Vector, text and hybrid search, and the router between them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectrail.functions import kernels, text, vector
from vectrail.operators.embedding import Embedder, embed_query


def arrow_distance(column: str, query: Sequence[float], metric: str):
    """Distance to one query vector, a batch at a time.

    Same values as the native expression up to the order of the sums, and
    about four times its speed on large tables; it needs Python workers.
    """
    q = np.asarray([float(x) for x in query], dtype=np.float64)

    @F.arrow_udf("double")
    def udf(vectors: pa.Array) -> pa.Array:
        rows, valid = kernels.matrix(vectors, len(q))
        found = kernels.distances(rows, q[None, :], metric)[0]
        lost = ~valid
        if metric == "cosine":
            lost |= (rows == 0).all(axis=1)
            if not q.any():
                lost[:] = True
        return pa.array(found, pa.float64(), mask=lost)

    return udf(F.col(column))


def vector_search(
    df: DataFrame,
    query: Sequence[float],
    k: int = 5,
    metric: str = "cosine",
    vector_column: str = "embedding",
    key: str = "id",
    columns: Sequence[str] | None = None,
    where: str | None = None,
    engine: str = "native",
    keep_undefined: bool = True,
) -> DataFrame:
    """The k rows nearest to a query vector, exact.

    One scan and a top-k per task (``TakeOrderedAndProject``); no shuffle of
    the table.  Ties fall to the smaller key.  Rows without a distance (no vector, another
    length, no direction) come last, as in ``batch_vector_search``; without
    ``keep_undefined`` they are left out.  ``engine="arrow"`` trades Python workers for
    faster arithmetic.
    """
    if metric not in vector.METRICS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {vector.METRICS}")
    if where:
        df = df.filter(F.expr(where))
    if engine == "arrow":
        dist = arrow_distance(vector_column, query, metric)
    else:
        dist = vector.distance_to(F.col(vector_column), query, metric)
    ranked = (
        df.withColumn("distance", dist)
        .orderBy(F.asc_nulls_last("distance"), key)
        .limit(k)
        .withColumn("similarity", vector.similarity(F.col("distance")))
    )
    if not keep_undefined:
        # After the cut, so that no distance is worked out twice.
        ranked = ranked.filter(F.col("distance").isNotNull())
    if columns is None:
        return ranked
    return ranked.selectExpr(*columns, "distance", "similarity")


def random_probe_search(
    df: DataFrame,
    dims: int,
    k: int = 5,
    seed: int = 42,
    unit: bool = False,
    **options,
) -> DataFrame:
    """Search with a random query vector, to try a table out."""
    probe = df.sparkSession.range(1).select(
        vector.random_vector(F.lit(0), dims, seed, unit=unit).alias("v")
    )
    return vector_search(df, probe.first()["v"], k, **options)


def text_search(
    df: DataFrame,
    query: str,
    content: str = "content",
    k: int = 10,
    key: str = "id",
    language: str = "french",
    rank_name: str = "rank",
) -> DataFrame:
    """The k texts that hold every query term, best rank first."""
    terms = text.constant_terms(df.sparkSession, query, language)
    return _ranked_matches(df, terms, content, k, key, rank_name)


def _ranked_matches(df, terms, content, k, key, rank_name) -> DataFrame:
    # The rank is NULL without a match.  Filtering it after the limit keeps the
    # optimizer from working it out twice; NULLs sort last, so nothing is lost.
    return (
        df.filter(text.may_match(F.col(content), terms))
        .withColumn(rank_name, text.constant_rank(F.col(content), terms))
        .orderBy(F.desc_nulls_last(rank_name), key)
        .limit(k)
        .filter(F.col(rank_name).isNotNull())
    )


def fuse(
    df: DataFrame, vector_weight: float = 0.7, text_weight: float = 0.3
) -> DataFrame:
    """Add ``final_score`` from ``similarity`` and ``text_rank``; no similarity counts as 0."""
    return df.withColumn(
        "final_score",
        F.coalesce(F.col("similarity"), F.lit(0.0)) * vector_weight
        + F.col("text_rank") * text_weight,
    )


def hybrid_search(
    df: DataFrame,
    query: str,
    query_vector: Sequence[float],
    vectors: DataFrame | None = None,
    content: str = "content",
    vector_column: str = "embedding",
    key: str = "id",
    k: int = 10,
    text_limit: int = 100,
    vector_weight: float = 0.7,
    text_weight: float = 0.3,
    language: str = "french",
) -> DataFrame:
    """Text search narrows to ``text_limit`` rows (k, if that is more), vector distance
    keeps k, both score.

    With ``vectors`` (key and vector in a table of their own) only the
    candidates are joined to it.  ``rank`` is the place by distance and
    ``final_score`` orders the result.  The texts are read once.
    """
    text_limit = max(text_limit, k)
    hits = text_search(df, query, content, text_limit, key, language, "text_rank")
    if vectors is not None:
        hits = join_candidates(hits, [vectors.select(key, vector_column)], key)
    near = (
        hits.withColumn(
            "distance", vector.distance_to(F.col(vector_column), query_vector)
        )
        .orderBy(F.asc_nulls_last("distance"), key)
        .limit(k)
        .withColumn("similarity", vector.similarity(F.col("distance")))
    )
    placed = add_positions(near, [F.asc_nulls_last("distance"), F.col(key)], "rank")
    return fuse(placed, vector_weight, text_weight).orderBy(F.desc("final_score"), key)


def join_candidates(hits: DataFrame, tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Join the candidates, already cut to a limit, with tables that hold more about them.

    A candidate that a table does not have keeps its row.  Nothing runs before the result is
    asked for: the candidates meet each table in an inner join, which Spark broadcasts by
    their size, and those that met no row are added from the same, shared exchange.
    """
    for table in tables:
        names = [c for c in table.columns if c != key]
        # One small partition, used by both branches with all its columns, so it is made once.
        few = hits.repartition(1)
        # NULL-safe, so that Spark does not put a filter into one branch and thereby part the two.
        other = table.filter(F.col(key).isNotNull()).withColumnRenamed(key, "_other")
        met = few.join(other, F.col(key).eqNullSafe(F.col("_other"))).select(
            *hits.columns, *names, F.lit(1).alias("_met")
        )
        alone = few.select(
            *hits.columns, *[F.lit(None).cast(table.schema[c].dataType).alias(c) for c in names], F.lit(0).alias("_met")
        )
        # Only candidates are left here: a limit's worth of rows.
        most = F.max("_met").over(W.partitionBy(key))
        hits = alone.unionByName(met).withColumn("_most", most).filter("_met = _most").drop("_met", "_most")
    return hits


def add_positions(df: DataFrame, order: list, name: str = "position") -> DataFrame:
    """Place in an ordered result.  Only for a result already limited to k rows."""
    return df.withColumn(name, F.row_number().over(W.orderBy(*order)))


def filtered_vector_search(
    df: DataFrame,
    query: str,
    query_vector: Sequence[float],
    k: int = 10,
    content: str = "content",
    language: str = "french",
    **options,
) -> DataFrame:
    """Vector search among all the rows whose text matches; no score is mixed in."""
    terms = text.constant_terms(df.sparkSession, query, language)
    return vector_search(
        df.filter(text.constant_match(F.col(content), terms)),
        query_vector,
        k,
        **options,
    )


def detect_mode(df: DataFrame, query: str = "query", requested: str = "auto") -> DataFrame:
    """Add the search mode of every query of a table."""
    return df.withColumn("mode", text.detect_mode(F.col(query), requested))


def analyse_queries(df: DataFrame, query: str = "query") -> DataFrame:
    """Add mode, confidence, reasons and suggestions to a table of queries."""
    q = F.col(query)
    return df.withColumn("mode", text.detect_mode(q)).withColumns(
        {
            "confidence": text.mode_confidence(q, F.col("mode")),
            "reasons": text.mode_reasons(q),
            "suggestions": text.mode_suggestions(q),
        }
    )


def search(
    df: DataFrame,
    query: str,
    embedder: Embedder,
    mode: str = "auto",
    k: int = 10,
    content: str = "content",
    vector_column: str = "embedding",
    key: str = "id",
    language: str = "french",
    text_limit: int = 100,
) -> DataFrame:
    """Route one query to text, vector or hybrid search.

    The result has ``mode`` and the scores of that mode; the others are NULL.  Rows
    that vector search can't score are left out.
    """
    spark = df.sparkSession
    picked = spark.range(1).select(text.detect_mode(F.lit(query), mode).alias("m")).first()["m"]
    if picked == "text":
        found = text_search(df, query, content, k, key, language, "text_rank")
    elif picked == "vector":
        found = vector_search(
            df, embed_query(spark, query, embedder), k, vector_column=vector_column, key=key, keep_undefined=False
        )
    elif picked == "hybrid":
        found = hybrid_search(
            df, query, embed_query(spark, query, embedder), None, content, vector_column, key, k,
            text_limit, language=language,
        )
    else:
        raise ValueError(f"unknown mode {picked!r}, expected auto or one of {text.MODES}")
    for name in ("distance", "similarity", "text_rank", "final_score"):
        if name not in found.columns:
            found = found.withColumn(name, F.lit(None).cast(T.DoubleType()))
    return found.drop("rank").withColumn("mode", F.lit(picked))


def suggest(df: DataFrame, partial: str, content: str = "content", n: int = 5) -> DataFrame:
    """Distinct texts that contain a piece, whatever the case; ``%`` and ``_`` are wild."""
    return (
        df.filter(F.col(content).ilike(f"%{partial}%"))
        .select(content)
        .distinct()
        .orderBy(content)
        .limit(n)
    )
