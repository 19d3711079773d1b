"""Read-only SQL with an automatic limit."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Refused words and allowed first words.
REFUSED = ("INSERT", "UPDATE", "DELETE", "DROP", "CREATE", "ALTER", "TRUNCATE")
ALLOWED = ("SELECT", "WITH", "SHOW", "DESCRIBE", "EXPLAIN", "VALUES")
LIMITED = ("SELECT", "WITH")


class RefusedStatement(ValueError):
    """The statement is not read-only."""


def check_read_only(sql: str) -> str:
    """First word of a read-only statement in upper case; raises otherwise.

    A refused word counts anywhere, inside literals too.
    """
    found = re.search(rf"\b({'|'.join(REFUSED)})\b", sql, re.IGNORECASE)
    if found:
        raise RefusedStatement(f"{found.group(1).upper()} is not read-only")
    first = (sql.split() or [""])[0].upper()
    if first not in ALLOWED:
        raise RefusedStatement(f"a statement cannot start with {first!r}; use {', '.join(ALLOWED)}")
    return first


def run_sql(spark: SparkSession, sql: str, limit: int = 100) -> DataFrame:
    """Run a read-only statement; SELECT and WITH without LIMIT get one."""
    statement = sql.strip().rstrip(";").rstrip()
    first = check_read_only(statement)
    result = spark.sql(statement)
    if first in LIMITED and not re.search(r"\bLIMIT\b", statement, re.IGNORECASE):
        return result.limit(limit)
    return result
