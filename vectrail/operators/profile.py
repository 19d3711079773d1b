"""Profiles of tables and vector columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectrail.functions import vector


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def table_profile(tables: Mapping[str, DataFrame], distinct: str | None = "approx") -> DataFrame:
    """One row per column: type, place, rows, filled, NULL and distinct values.

    ``distinct`` is ``approx`` (a sketch, one scan and no shuffle of values), ``exact`` (128-bit
    digests of the values, counted in each task before they are shuffled) or None.  A profile that
    is kept up to date as files come is made by ``sketch_files`` and ``profile_of_sketches``.
    """
    one = _exact_one if distinct == "exact" else _profile_one
    return _union([one(name, df, distinct) for name, df in tables.items()])


def _described(name: str, field: T.StructField, i: int, rows: Column, filled: Column, distinct: Column) -> Column:
    return F.struct(
        F.lit(name).alias("table_name"),
        F.lit(field.name).alias("column_name"),
        F.lit(field.dataType.simpleString()).alias("data_type"),
        F.lit(field.nullable).alias("nullable"),
        F.lit(i + 1).alias("position"),
        rows.alias("n_rows"),
        filled.alias("n_filled"),
        (rows - filled).alias("n_null"),
        distinct.alias("n_distinct"),
    )


def _exact_one(name: str, df: DataFrame, distinct: str | None) -> DataFrame:
    """Exact counts by (column, digest of the value) pairs; each pair leaves a task once."""
    cells = []
    for i, field in enumerate(df.schema):
        column = F.col(f"`{field.name}`")
        digest = F.when(column.isNotNull(), F.struct(F.xxhash64(column).alias("a"), F.xxhash64(F.lit(1), column).alias("b")))
        cells.append(F.struct(F.lit(i).alias("i"), digest["a"].alias("a"), digest["b"].alias("b")))
    values = df.select(F.inline(F.array(*cells))).groupBy("i", "a", "b").agg(F.count("*").alias("n"))
    counted = values.groupBy("i").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(F.col("a").isNotNull(), F.col("n"))), F.lit(0)).alias("filled"),
        F.count("a").alias("d"),
    )
    # A row per column of the table: all columns have one, those of an empty table too.
    found = counted.agg(F.map_from_entries(F.collect_list(F.struct("i", F.struct("rows", "filled", "d")))).alias("m"))
    none = F.struct(*[F.lit(0).cast("long").alias(c) for c in ("rows", "filled", "d")])
    rows = []
    for i, field in enumerate(df.schema):
        at = F.coalesce(F.try_element_at("m", F.lit(i)), none)
        rows.append(_described(name, field, i, at["rows"], at["filled"], at["d"]))
    return found.select(F.inline(F.array(*rows)))


def _profile_one(name: str, df: DataFrame, distinct: str | None) -> DataFrame:
    counters = [F.count("*").alias("rows")]
    for i, field in enumerate(df.schema):
        column = F.col(f"`{field.name}`")
        counters.append(F.count(column).alias(f"n{i}"))
        if distinct == "approx":
            counters.append(F.approx_count_distinct(column).alias(f"d{i}"))
    rows = [
        _described(
            name, field, i, F.col("rows"), F.col(f"n{i}"), F.col(f"d{i}") if distinct else F.lit(None).cast("long")
        )
        for i, field in enumerate(df.schema)
    ]
    return df.agg(*counters).select(F.inline(F.array(*rows)))


def sketch_files(spark: SparkSession, path: str, store: str, lg_k: int = 14) -> int:
    """Sketch the files of a parquet table that ``store`` does not know yet; how many they were.

    ``store`` gains a row per file and column: rows, filled rows and a mergeable sketch of the
    different values.  Files that are known are not read again, so a profile costs what is new.
    """
    files = sorted(spark.read.parquet(path).inputFiles())
    try:
        known = {r["file"] for r in spark.read.parquet(store).select("file").distinct().collect()}  # a row per file
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        known = set()
    fresh = [f for f in files if f not in known]
    if not fresh:
        return 0
    df = spark.read.parquet(*fresh)
    cells = []
    for i, field in enumerate(df.schema):
        column = F.col(f"`{field.name}`")
        cells.append(
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(i + 1).alias("position"),
                F.when(column.isNotNull(), F.xxhash64(column)).alias("digest"),
            )
        )
    (
        df.select(F.input_file_name().alias("file"), F.inline(F.array(*cells)))
        .groupBy("file", "column_name", "position")
        .agg(
            F.count("*").alias("n_rows"),
            F.count("digest").alias("n_filled"),
            F.hll_sketch_agg("digest", F.lit(lg_k)).alias("sketch"),
        )
        .write.mode("append")
        .parquet(store)
    )
    return len(fresh)


def profile_of_sketches(spark: SparkSession, store: str, name: str) -> DataFrame:
    """The profile of all files that ``store`` knows, from their sketches alone."""
    return (
        spark.read.parquet(store)
        .groupBy("column_name", "position")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            F.sum("n_filled").alias("n_filled"),
            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"),
        )
        .select(
            F.lit(name).alias("table_name"), "column_name", "position", "n_rows", "n_filled",
            (F.col("n_rows") - F.col("n_filled")).alias("n_null"), "n_distinct",
        )
    )


def table_overview(profile: DataFrame) -> DataFrame:
    """Columns and rows per table, by name."""
    return (
        profile.groupBy("table_name")
        .agg(F.count("*").alias("n_columns"), F.max("n_rows").alias("n_rows"))
        .withColumn("kind", F.lit("table"))
        .orderBy("table_name")
    )


def is_vector(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.ArrayType) and isinstance(
        field.dataType.elementType, (T.FloatType, T.DoubleType)
    )


def vector_stats(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows with and without a vector."""
    v = F.col(column)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count(v).alias("n_filled"),
        F.count_if(v.isNull()).alias("n_null"),
    )


def dimension_stats(df: DataFrame, column: str = "embedding") -> DataFrame:
    """Number of vectors and their mean length."""
    v = F.col(column)
    return df.filter(v.isNotNull()).agg(
        F.count("*").alias("n_rows"), F.avg(vector.dims(v)).alias("avg_dims")
    )


def vector_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every vector column with its lengths and the share of rows filled."""
    found = [
        df.agg(
            F.count("*").alias("n_rows"),
            F.count(f.name).alias("n_filled"),
            F.avg(vector.dims(F.col(f.name))).alias("avg_dims"),
            F.min(vector.dims(F.col(f.name))).alias("min_dims"),
            F.max(vector.dims(F.col(f.name))).alias("max_dims"),
        ).select(
            F.lit(name).alias("table_name"),
            F.lit(f.name).alias("column_name"),
            "avg_dims",
            "min_dims",
            "max_dims",
            F.try_divide(F.col("n_filled"), F.col("n_rows")).alias("filled_share"),
        )
        for name, df in tables.items()
        for f in df.schema
        if is_vector(f)
    ]
    if not found:
        raise ValueError("no table has a vector column")
    return _union(found)


def expected_dims(field: T.StructField) -> int | None:
    """Vector length declared in the column metadata."""
    return field.metadata.get("vector_dim")


def vector_flags(df: DataFrame, column: str = "embedding", expected: int | None = None) -> DataFrame:
    """Add what is wrong with each vector as booleans, and ``n_dims``."""
    v = F.col(column)
    filled = F.size(v) > 0
    flags: dict[str, Column] = {
        "n_dims": vector.dims(v),
        "is_null": v.isNull(),
        "is_empty": F.coalesce(F.size(v) == 0, F.lit(False)),
        "has_null": F.coalesce(F.exists(v, lambda x: x.isNull()), F.lit(False)),
        "has_nan": F.coalesce(vector.has_nan(v), F.lit(False)),
        "has_infinity": F.coalesce(vector.has_infinity(v), F.lit(False)),
        "wrong_dims": (
            F.coalesce(filled & (F.size(v) != expected), F.lit(False))
            if expected is not None
            else F.lit(False)
        ),
    }
    return df.withColumns(flags)


def validate_vectors(
    df: DataFrame, column: str = "embedding", expected: int | None = None
) -> DataFrame:
    """One row on a set of vectors: counts per fault, lengths seen, ``compatible``.

    ``expected`` falls back to the length in the column metadata, then to the most
    frequent length.  NULLs and empty vectors count apart from NaN and infinity, per vector.
    """
    if expected is None:
        expected = expected_dims(df.schema[column])
    flagged = vector_flags(df, column, expected)
    # Grouping by the length first keeps the list of lengths out of the tasks.
    per_length = flagged.groupBy("n_dims").agg(
        F.count("*").alias("n"),
        F.count_if("is_null").alias("nulls"),
        F.count_if("is_empty").alias("empties"),
        F.count_if("has_null").alias("with_null"),
        F.count_if("has_nan").alias("nans"),
        F.count_if("has_infinity").alias("infinities"),
        F.count_if("wrong_dims").alias("wrong"),
    )
    if expected is None:
        # All vectors that have elements but not the most frequent number of them.
        some = F.col("n_dims") > 0
        most = F.sum(F.when(some, F.col("n"))) - F.max(F.when(some, F.col("n")))
        odd = F.coalesce(most, F.lit(0)).alias("n_wrong_dims")
    else:
        odd = F.coalesce(F.sum("wrong"), F.lit(0)).alias("n_wrong_dims")
    total = {
        "n_vectors": "n", "n_null": "nulls", "n_empty": "empties", "n_with_null": "with_null",
        "n_nan": "nans", "n_infinity": "infinities",
    }
    summed = per_length.agg(
        *[F.coalesce(F.sum(source), F.lit(0)).alias(name) for name, source in total.items()],
        odd,
        F.count_if(F.col("n_dims") > 0).alias("n_lengths"),
        F.min(F.when(F.col("n_dims") > 0, F.col("n_dims"))).alias("min_dims"),
        F.max(F.when(F.col("n_dims") > 0, F.col("n_dims"))).alias("max_dims"),
    )
    faults = [F.col(n) == 0 for n in [*total, "n_wrong_dims"] if n not in ("n_vectors", "n_null")]
    fine = (F.col("n_vectors") > 0) & (F.col("n_lengths") == 1)
    for fault in faults:
        fine = fine & fault
    return summed.withColumn("compatible", fine)


def require_valid(df: DataFrame, column: str = "embedding", expected: int | None = None) -> DataFrame:
    """``df`` itself, or an error when ``validate_vectors`` finds a fault."""
    report = validate_vectors(df, column, expected).first()
    if not report["compatible"]:
        raise ValueError(f"vectors of {column!r} failed validation: {report.asDict()}")
    return df


def diagnose(
    df: DataFrame | None,
    column: str = "embedding",
    support: Sequence[str] = ("content", "id", "metadata"),
) -> DataFrame:
    """Checks on a vector table as rows ``check, ok, detail, suggestion``.

    Without a table only that check is given.
    """
    if df is None:
        raise ValueError("the table does not exist; create it with create_vector_table")
    present = column in df.columns
    have = [name for name in sorted(support) if name in df.columns]
    stats = (
        df.agg(
            F.count("*").alias("n"),
            F.count(column).alias("filled"),
            F.max(vector.dims(F.col(column))).alias("width"),
        )
        if present
        else df.agg(F.count("*").alias("n")).withColumns(
            {"filled": F.lit(0).cast("long"), "width": F.lit(None).cast("int")}
        )
    )
    nulls = F.col("n") - F.col("filled")
    model = vector.model_for(F.col("width"), vector.STANDARD_DIMENSIONS)
    checks = [
        _check("vector column", F.lit(present), F.lit(column),
               "add it with add_vector_column"),
        _check("support columns", F.lit(bool(have)), F.lit(", ".join(have)), "add content or metadata"),
        _check("row count", F.col("n") > 0, F.col("n").cast("string"), "append rows"),
        _check("null vectors", F.lit(present) & (nulls == 0), nulls.cast("string"), "run backfill"),
        _check("standard dimension", model.isNotNull(),
               F.concat_ws(" ", F.col("width").cast("string"), model), "check the model in use"),
    ]
    return stats.select(F.inline(F.array(*checks)))


def _check(name: str, ok: Column, detail: Column, suggestion: str) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
        F.coalesce(detail, F.lit("")).alias("detail"),
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(suggestion)).alias("suggestion"),
    )
