"""Registry of queries and helpers to write them next to their SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrail.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL that must agree with it."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def tidy(value: Column, places: int = 6) -> Column:
    """Round for comparison; adding zero turns a negative zero into zero."""
    return F.round(value, places) + F.lit(0.0)


def tidy_sql(value: str, places: int = 6) -> str:
    """``tidy`` in SQL."""
    return f"CASE WHEN round({value}, {places}) = 0 THEN 0.0::DOUBLE ELSE round({value}, {places}) END"


def probe_vector(spark: SparkSession, folder: str, vec_id: int = 7) -> list[float]:
    """The stored vector used as query; one row."""
    row = load(spark, folder, "embeddings").filter(F.col("vec_id") == vec_id).first()
    return list(row["embedding"])


PROBE_SQL = "(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 7)"


def longs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast counters to bigint."""
    return df.withColumns({c: F.col(c).cast("long") for c in columns})
