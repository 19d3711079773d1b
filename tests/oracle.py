"""Run registered queries against DuckDB on the same tables.

    python -m tests.oracle [--sf DIR] [name part ...]
"""

from __future__ import annotations

import argparse
import math
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

# DuckDB type names next to those of Spark.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """Number of rows and the first difference, if any."""
    relation = con.sql(sql)
    expected = dict(zip(relation.columns, (str(t) for t in relation.types)))
    actual = dict(df.dtypes)
    if set(expected) != set(actual):
        return 0, f"columns {sorted(actual)} against {sorted(expected)}"
    for name, kind in expected.items():
        if TYPES.get(kind) != actual[name]:
            return 0, f"type of {name}: {actual[name]} against {kind}"
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(relation.columns, relation.fetchall())
    if len(ours) != len(theirs):
        return len(ours), f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            n = sum(x != y for x, y in zip(ours, theirs))
            return len(ours), f"{n} rows differ, first {a} against {b}"
    return len(ours), None


def main() -> None:
    from vectrail.plans import ORACLES, QUERIES
    from vectrail.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    con = connect(args.sf)
    bad = 0
    for name, run in QUERIES.items():
        if args.names and not any(part in name for part in args.names):
            continue
        start = time.time()
        try:
            df = run(spark, args.sf)
            if name in ORACLES:
                n, fault = compare(df, con, ORACLES[name])
            else:
                n, fault = len(df.collect()), None
        except Exception as error:  # noqa: BLE001
            n, fault = 0, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += fault is not None
        mark = "FAIL" if fault else ("ok" if name in ORACLES else "rows")
        print(f"{mark:5}{name:45}{n:>8} rows {time.time() - start:7.2f}s {fault or ''}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
