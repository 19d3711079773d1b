"""Embedding of texts: the default model, plug-in models, reuse and backfill."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrail.functions import kernels, text, vector
from vectrail.functions.time import recent
from vectrail.operators.skew import salted_lookup
from vectrail.session import work_path
from vectrail.sources.tables import write_table


@dataclass(frozen=True)
class Embedder:
    """A model that turns texts into vectors of ``dims`` elements.

    ``model`` gets a list of trimmed, non-blank texts and returns one vector
    per text, or None for a text it failed on; an exception fails the list
    and is retried text by text.  Without ``model`` the built-in feature
    hashing is used.
    """

    dims: int = 1536
    model: Callable[[list[str]], Sequence] | None = None
    batch: int = 64

    def column(self, texts: Column) -> Column:
        """Vector of a text column: NULL stays NULL, blank gives the zero vector."""
        if self.model is None:
            return _hashed(self.dims)(text.word_codes(texts, self.dims))
        return _modelled(self)(text.trim_all(texts))


def _hashed(dims: int):
    @F.arrow_udf("array<float>")
    def udf(codes: pa.Array) -> pa.Array:
        return kernels.coded_vectors(codes, dims)

    return udf


def _modelled(embedder: Embedder):
    model, dims, size = embedder.model, embedder.dims, embedder.batch

    def attempt(batch: list[str]) -> list:
        try:
            return [None if v is None else [float(x) for x in v] for v in model(batch)]
        except Exception:
            if len(batch) == 1:
                return [None]
            return [attempt([one])[0] for one in batch]

    @F.arrow_udf("array<float>")
    def udf(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        out: list = [None if v is None else [0.0] * dims for v in values]
        asked = [i for i, v in enumerate(values) if v]
        for start in range(0, len(asked), size):
            part = asked[start : start + size]
            for i, found in zip(part, attempt([values[i] for i in part])):
                out[i] = found
        return pa.array(out, pa.list_(pa.float32()))

    return udf


def embed(
    df: DataFrame, text_column: str, embedder: Embedder, target: str = "embedding"
) -> DataFrame:
    """Embed every row where it stands; no shuffle."""
    return df.withColumn(target, embedder.column(F.col(text_column)))


def text_digest(texts: Column) -> Column:
    """What tells texts apart when embeddings are reused: a digest of the trimmed text."""
    return F.sha2(text.trim_all(texts), 256)


def embed_with_reuse(
    df: DataFrame,
    text_column: str,
    embedder: Embedder,
    key: str,
    target: str = "embedding",
    rows_per_task: int = 1_000_000,
    known: DataFrame | None = None,
) -> DataFrame:
    """Embed each distinct trimmed text once and hand the vector to all its copies.

    ``known`` has ``text_digest`` and ``vector`` of texts embedded before with the same
    model; those are not embedded again.  ``embedded_texts`` gives what to add to it.  Stored by
    ``prefix`` of the digest, only the folders of the texts at hand are read; see ``known_of``.
    Texts are grouped and looked up by their digests, so that only one copy of each is
    moved.  A text with very many copies is spread over several tasks.
    """
    keyed = df.withColumn("_digest", text_digest(F.col(text_column)))
    distinct = (
        keyed.filter(F.col("_digest").isNotNull())
        .groupBy("_digest")
        .agg(F.first(text_column).alias("_text"), F.count("*").alias("_copies"))
    )
    if known is None:
        made = distinct.withColumn(target, embedder.column(F.col("_text")))
    else:
        distinct = write_table(distinct, work_path(df.sparkSession, "distinct-texts"))
        stored = known_of(known, distinct.select("_digest"))
        made = (
            distinct.join(stored, "_digest", "left")
            .withColumn("_new", embedder.column(F.when(F.col("_known").isNull(), F.col("_text"))))
            .withColumn(target, F.coalesce("_known", "_new"))
        )
    made = made.select("_digest", "_copies", target)
    return salted_lookup(keyed, made, "_digest", "_copies", key, rows_per_task).drop("_digest")


def digest_prefix(digest: Column) -> Column:
    """The folder of a digest in a store of known texts: one of 256."""
    return F.substring(digest, 1, 2)


def known_of(known: DataFrame, digests: DataFrame) -> DataFrame:
    """``_digest`` and ``_known`` (vector) of the ``known`` texts that ``digests`` asks for.

    Where ``known`` has a column ``prefix``, the folders of other prefixes are not read.  The rest is cut to
    the digests at hand before anything is shuffled, by a join that Spark picks by their size.
    """
    if "prefix" in known.columns:
        wanted = digests.select(digest_prefix(F.col("_digest")).alias("p")).distinct().collect()  # at most 256
        known = known.filter(F.col("prefix").isin([r["p"] for r in wanted]))
    stored = known.select(F.col("text_digest").alias("_digest"), F.col("vector").alias("_known"))
    return stored.join(digests, "_digest", "left_semi").dropDuplicates(["_digest"])


def embedded_texts(
    done: DataFrame, text_column: str, target: str = "embedding", known: DataFrame | None = None
) -> DataFrame:
    """``text_digest`` and ``vector`` of the texts of ``done`` that ``known`` does not hold yet."""
    made = (
        done.filter(F.col(target).isNotNull() & F.col(text_column).isNotNull())
        .groupBy(text_digest(F.col(text_column)).alias("text_digest"))
        .agg(F.first(target).alias("vector"))
    )
    if known is None:
        return made
    old = known_of(known, made.select(F.col("text_digest").alias("_digest"))).select("_digest")
    return made.join(old, made["text_digest"] == old["_digest"], "left_anti")


def embed_query(spark: SparkSession, query: str, embedder: Embedder) -> list[float]:
    """Vector of one query text."""
    row = spark.createDataFrame([(query,)], "q string").select(embedder.column(F.col("q")).alias("v"))
    return list(row.first()["v"])


def vectorise_rows(
    df: DataFrame,
    ids: DataFrame,
    text_columns: Sequence[str],
    embedder: Embedder,
    key: str = "id",
    target: str = "embedding",
    min_length: int = 5,
) -> DataFrame:
    """Embed the rows named by ``ids``; the table with its new vectors.

    ``status`` is ``vectorised``, ``failed`` (the model gave no vector, an old one stays),
    ``too short`` or NULL for a row not asked for.  Use ``missing_ids`` for the ids the
    table does not hold.
    """
    asked = ids.select(key).distinct().withColumn("_asked", F.lit(True))
    flagged = df.join(asked, key, "left")
    source = text.concat_columns([F.col(c) for c in text_columns])
    due = F.col("_asked") & (F.char_length(source) >= min_length)
    # A model column runs for every row, so rows not due hand it a NULL.
    made = flagged.withColumn("_due", due).withColumn("_new", embedder.column(F.when(F.col("_due"), source)))
    status = F.when(
        F.col("_asked"),
        F.when(F.col("_new").isNotNull(), F.lit("vectorised"))
        .when(F.col("_due"), F.lit("failed"))
        .otherwise(F.lit("too short")),
    )
    filled = made.withColumn("status", status).withColumn(target, F.coalesce("_new", target))
    return filled.drop("_asked", "_due", "_new")


def missing_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Ids asked for that the table does not hold."""
    return ids.select(key).distinct().join(df.select(key), key, "left_anti")


def record_text(
    interpretation: Column,
    study: Column,
    symbol: Column,
    technical: Column,
    fallback: Column | None = None,
) -> Column:
    """Text of a record from its labelled parts.

    Without any part it is ``fallback``, or a fixed phrase.
    """
    return text.labelled(
        [("", interpretation), ("Study: ", study), ("Symbol: ", symbol), ("Technical: ", technical)],
        F.lit("No content provided") if fallback is None else fallback,
    )


def article_text(title: Column, content: Column, max_chars: int | None = None) -> Column:
    """Title, blank line, content; whole, or cut to the length a model takes."""
    joined = F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(content, F.lit("")))
    return joined if max_chars is None else F.substring(joined, 1, max_chars)


def backfill(
    df: DataFrame,
    embedder: Embedder,
    as_of_ms: int,
    days: int = 7,
    limit: int | None = None,
    key: str = "id",
    title: str = "title",
    content: str = "content",
    time_ms: str = "timestamp_unix_ms",
    target: str = "embedding",
    max_chars: int | None = None,
) -> DataFrame:
    """Embed the recent rows that have no vector yet, newest first.

    Returns the whole table with ``backfill`` per row: ``embedded``,
    ``failed`` (the vector stays NULL) or NULL when the row was not due.  The
    table is read once; with a ``limit`` only the ids of the newest due rows
    are joined back.
    """
    due = F.col(target).isNull() & recent(F.col(time_ms), as_of_ms, days)
    if limit is None:
        marked = df.withColumn("_due", due)
    else:
        newest = (
            df.filter(due).orderBy(F.desc(time_ms), key).limit(limit).select(key)
        ).withColumn("_due", F.lit(True))
        marked = df.join(newest, key, "left").withColumn(
            "_due", F.coalesce(F.col("_due"), F.lit(False))
        )
    source = article_text(F.col(title), F.col(content), max_chars)
    # A model column runs for every row, so rows not due hand it a NULL.
    made = embedder.column(F.when(F.col("_due"), source))
    filled = marked.withColumn("_new", made).withColumn(target, F.coalesce(target, "_new")).drop("_new")
    outcome = F.when(
        F.col("_due"),
        F.when(F.col(target).isNotNull(), F.lit("embedded")).otherwise(F.lit("failed")),
    )
    return filled.withColumn("backfill", outcome).drop("_due")


def backfill_counts(filled: DataFrame) -> DataFrame:
    """How many rows were due, embedded and failed."""
    return filled.agg(
        F.count("backfill").alias("due"),
        F.count_if(F.col("backfill") == "embedded").alias("embedded"),
        F.count_if(F.col("backfill") == "failed").alias("failed"),
    )


def dimension_agreement(df: DataFrame, column: str, expected: int) -> DataFrame:
    """Rows per vector length, and whether it is the expected one."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(vector.dims(F.col(column)).alias("dims"))
        .agg(F.count("*").alias("n_rows"))
        .withColumn("agrees", F.col("dims") == expected)
    )
