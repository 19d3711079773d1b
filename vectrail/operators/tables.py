"""Create, extend, append to, update and delete from vector tables.

Parquet files do not change in place.  Each operator returns the new table;
``sources.tables.write_table`` stores it under a new path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectrail.functions import vector
from vectrail.operators.embedding import Embedder
from vectrail.operators.skew import number_rows


def vector_field(name: str, dims: int) -> T.StructField:
    """A vector column; its length is kept in the metadata."""
    return T.StructField(name, T.ArrayType(T.FloatType()), True, {"vector_dim": dims})


def create_vector_table(
    spark: SparkSession,
    path: str,
    dims: int = 1536,
    column: str = "embedding",
    key: str = "id",
    extra: T.StructType | None = None,
) -> DataFrame:
    """Create an empty table: key, vector, creation time and extra columns.

    A table already at ``path`` is left as it is.
    """
    schema = T.StructType(
        [T.StructField(key, T.LongType(), True), vector_field(column, dims)]
        + (list(extra) if extra else [])
        + [T.StructField("created_at", T.TimestampType(), True)]
    )
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.parquet(path)


def add_vector_column(df: DataFrame, column: str = "embedding", dims: int = 1536) -> DataFrame:
    """Add an empty vector column; refuses when the column is there."""
    if column in df.columns:
        raise ValueError(f"column {column!r} already exists")
    return df.withColumn(column, F.lit(None).cast("array<float>")).withMetadata(
        column, {"vector_dim": dims}
    )


def change_dimension(
    df: DataFrame, column: str, dims: int, on_mismatch: str = "error"
) -> DataFrame:
    """Declare another vector length.

    Vectors of a different length raise an error, or with ``"null"`` become
    NULL so that a backfill embeds them again; none is padded or cut.
    """
    v = F.col(column)
    wrong = F.size(v) != dims
    if on_mismatch == "error":
        message = F.concat(
            F.lit(f"{column}: expected {dims} dimensions, not "), F.size(v).cast("string")
        )
        kept = F.when(wrong, F.raise_error(message).cast("array<float>")).otherwise(v)
    elif on_mismatch == "null":
        kept = F.when(~wrong, v)
    else:
        raise ValueError(f"on_mismatch must be error or null, not {on_mismatch!r}")
    return df.withColumn(column, kept).withMetadata(column, {"vector_dim": dims})


def _sorts(kind: T.DataType) -> bool:
    return isinstance(
        kind, (T.NumericType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)
    )


def append_rows(
    base: DataFrame,
    new: DataFrame,
    key: str = "id",
    order_by: str | None = None,
    defaults: Mapping[str, Column] | None = None,
    extend: bool = False,
) -> DataFrame:
    """Append rows; absent columns are NULL or take their default.

    See ``new_rows`` for keys and unknown columns.
    """
    added = new_rows(base, new, key, order_by, defaults, extend)
    return base.unionByName(added, allowMissingColumns=True)


def new_rows(
    base: DataFrame,
    new: DataFrame,
    key: str = "id",
    order_by: str | None = None,
    defaults: Mapping[str, Column] | None = None,
    extend: bool = False,
) -> DataFrame:
    """The rows that ``append_rows`` adds, with their keys.

    Rows without a key column get the next ones after the largest of ``base``,
    in the order of ``order_by`` and then of the plain columns.  ``order_by`` itself is
    stored only if the table has it.  A column that the table does not have is an
    error, or with ``extend`` becomes a new column of the table.
    """
    unknown = [c for c in new.columns if c not in base.columns and c not in (key, order_by)]
    if unknown and not extend:
        raise ValueError(f"the table has no column {', '.join(unknown)}")
    if key not in new.columns:
        if order_by is None:
            raise ValueError("order_by is needed to number rows that have no key")
        top = base.agg(F.max(key).alias("m")).first()["m"]
        ties = [f.name for f in new.schema if f.name != order_by and _sorts(f.dataType)]
        new = number_rows(new, order_by, ties, (-1 if top is None else top) + 1, name=key)
    for name, value in (defaults or {}).items():
        if name not in new.columns:
            new = new.withColumn(name, value)
    if order_by is not None and order_by != key and order_by not in base.columns:
        new = new.drop(order_by)
    return new


def append_vectors(
    base: DataFrame,
    items: DataFrame,
    vector_column: str = "embedding",
    key: str = "id",
    order_by: str = "item",
    optional: Sequence[str] = ("content", "metadata"),
) -> DataFrame:
    """Append a batch of vectors.

    An optional column is stored only when every item of the batch has it; a
    metadata map or struct is stored as JSON text.
    """
    present = [c for c in optional if c in items.columns]
    kept = present
    if present:
        every = items.agg(*[F.every(F.col(c).isNotNull()).alias(c) for c in present]).first()
        kept = [c for c in present if every[c]]
    batch = items.select(order_by, F.col(vector_column), *kept)
    for name in kept:
        if isinstance(items.schema[name].dataType, (T.MapType, T.StructType)):
            batch = batch.withColumn(name, F.to_json(name))
    return append_rows(base, batch, key, order_by)


def append_with_embedding(
    base: DataFrame,
    records: DataFrame,
    source: Column,
    embedder: Embedder,
    vector_column: str = "embedding",
    key: str = "id",
    order_by: str = "item",
    extend: bool = False,
) -> DataFrame:
    """Append records together with the embedding of their text."""
    made = records.withColumn(vector_column, embedder.column(source))
    return append_rows(base, made, key, order_by, extend=extend)


def update_where(
    df: DataFrame, predicate: str, values: Mapping[str, Column]
) -> DataFrame:
    """Set columns on the rows where the predicate holds."""
    hit = F.coalesce(F.expr(predicate), F.lit(False))
    return df.withColumns(
        {name: F.when(hit, value).otherwise(F.col(name)) for name, value in values.items()}
    )


def delete_where(df: DataFrame, predicate: str) -> DataFrame:
    """Keep the rows where the predicate is false or NULL."""
    return df.filter(~F.coalesce(F.expr(predicate), F.lit(False)))


def affected(df: DataFrame, predicate: str) -> DataFrame:
    """How many rows an update or delete touches and leaves; one pass."""
    hit = F.coalesce(F.expr(predicate), F.lit(False))
    return df.agg(F.count_if(hit).alias("n_affected"), F.count_if(~hit).alias("n_remaining"))


def vector_update(df: DataFrame, new: Sequence[float], predicate: str, column: str = "embedding"):
    """Replace the vector of the rows where the predicate holds."""
    return update_where(df, predicate, {column: vector.literal(new).cast("array<float>")})
