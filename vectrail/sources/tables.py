"""Table scans and sinks.

Scans stay lazy and declarative, so column pruning and filters reach parquet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] | None = None,
    where: str | None = None,
) -> DataFrame:
    """Scan a table by path or by catalog name.

    ``where`` is a predicate text and ``columns`` a list of select expressions,
    both in Spark SQL.
    """
    df = spark.read.parquet(name) if "/" in name else spark.table(name)
    if where:
        df = df.filter(F.expr(where))
    return df.selectExpr(*columns) if columns else df


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Scan ``<folder>/<table>.parquet``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def corpus(documents: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Documents with their vector, NULL where none exists yet."""
    vectors = embeddings.select(F.col("vec_id").alias("id"), "embedding")
    texts = documents.select(F.col("doc_id").alias("id"), F.col("text").alias("content"), "lang")
    return texts.join(vectors, "id", "left")


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "errorifexists", **options: str
) -> DataFrame:
    """Write ``df`` and return a scan of what was written.

    The default mode never overwrites, so a changed table cannot replace the
    files it is being read from.  The returned scan has no lineage behind it.
    ``options`` go to the writer.
    """
    df.write.mode(mode).options(**options).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
