"""Queries over workload statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from vectrail.operators import workload as W
from vectrail.plans.registry import longs, query, tidy, tidy_sql
from vectrail.sources.tables import load


def _log(spark, folder):
    return load(spark, folder, "events").select(
        F.col("event_type").alias("statement"),
        F.col("user_id"),
        F.col("value").alias("ms"),
        F.get_json_object("props", "$.k").cast("long").alias("rows"),
    )


_LOG_SQL = """
    SELECT event_type AS statement, user_id, value AS ms,
           json_extract_string(props, '$.k')::BIGINT AS "rows" FROM events
"""

_TIMES = ("total_ms", "mean_ms", "max_ms", "stddev_ms")


def _slow_sql(group: str, min_calls: int, order: str, limit: int) -> str:
    return f"""
        SELECT {group}, count(*) AS calls, {tidy_sql('sum(ms)', 4)} AS total_ms,
               {tidy_sql('avg(ms)', 4)} AS mean_ms, {tidy_sql('max(ms)', 4)} AS max_ms,
               {tidy_sql('stddev_pop(ms)', 4)} AS stddev_ms, sum("rows")::BIGINT AS "rows"
        FROM ({_LOG_SQL}) GROUP BY {group} HAVING count(*) >= {min_calls}
        ORDER BY {order} DESC, {group} LIMIT {limit}
    """


def _shown(df, group):
    return df.select(group, "calls", *[tidy(F.col(c), 4).alias(c) for c in _TIMES], "rows")


def _register_slow(order: str) -> None:
    sql_order = {"total_ms": "sum(ms)", "mean_ms": "avg(ms)", "calls": "count(*)"}[order]

    @query(f"t1_slow_statements_by_{order}", _slow_sql("statement", 5, sql_order, 20))
    def run(spark, folder):
        found = W.slow_statements(_log(spark, folder), rows="rows", order_by=order)
        return _shown(found, "statement")


for _order in W.ORDERS:
    _register_slow(_order)


@query("t1_e7_slowest_by_mean", _slow_sql("user_id", 0, "avg(ms)", 10))
def slowest_by_mean(spark, folder):
    found = W.slow_statements(
        _log(spark, folder), "user_id", rows="rows", min_calls=0, order_by="mean_ms", limit=10
    )
    return _shown(found, "user_id")


_COUNTERS_SQL = """
    SELECT user_id, count(*) FILTER (event_type = 'view') AS heap_hit,
           count(*) FILTER (event_type = 'error') AS heap_read,
           count(*) FILTER (event_type IN ('click', 'purchase')) AS idx_hit,
           count(*) FILTER (event_type = 'none') AS idx_read,
           count(*) FILTER (event_type <> 'error') AS live,
           count(*) FILTER (event_type = 'error') AS dead
    FROM events GROUP BY user_id
"""


def _counters(spark, folder):
    kind = F.col("event_type")
    return (
        load(spark, folder, "events")
        .groupBy("user_id")
        .agg(
            F.count_if(kind == "view").alias("heap_hit"),
            F.count_if(kind == "error").alias("heap_read"),
            F.count_if(kind.isin("click", "purchase")).alias("idx_hit"),
            F.count_if(kind == "none").alias("idx_read"),
            F.count_if(kind != "error").alias("live"),
            F.count_if(kind == "error").alias("dead"),
        )
    )


@query(
    "t2_e4_hit_ratio",
    f"""
    SELECT sum(heap_read)::BIGINT AS heap_read, sum(heap_hit)::BIGINT AS heap_hit,
           sum(idx_read)::BIGINT AS idx_read, sum(idx_hit)::BIGINT AS idx_hit,
           {tidy_sql('sum(heap_hit)::DOUBLE / nullif(sum(heap_hit) + sum(heap_read), 0)')} AS heap_ratio,
           coalesce(sum(heap_hit)::DOUBLE / nullif(sum(heap_hit) + sum(heap_read), 0) < 0.95, false) AS heap_below,
           {tidy_sql('sum(idx_hit)::DOUBLE / nullif(sum(idx_hit) + sum(idx_read), 0)')} AS idx_ratio,
           coalesce(sum(idx_hit)::DOUBLE / nullif(sum(idx_hit) + sum(idx_read), 0) < 0.95, false) AS idx_below
    FROM ({_COUNTERS_SQL})
    """,
)
def hit_ratio(spark, folder):
    found = W.hit_ratio(
        _counters(spark, folder), [("heap", "heap_read", "heap_hit"), ("idx", "idx_read", "idx_hit")]
    )
    return found.withColumns({c: tidy(F.col(c)) for c in ("heap_ratio", "idx_ratio")})


@query(
    "t3_unused_members",
    "SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def unused_members(spark, folder):
    return W.unused_members(
        load(spark, folder, "documents"), load(spark, folder, "labels"), "doc_id", "n_chars"
    )


@query(
    "t3_member_usage",
    """
    SELECT p_partkey, p_retailprice, count(l_partkey) AS n_uses
    FROM part LEFT JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey, p_retailprice
    """,
)
def member_usage(spark, folder):
    usage = load(spark, folder, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return W.member_usage(load(spark, folder, "part"), usage, "p_partkey", "p_retailprice")


def _stale_sql(where: str) -> str:
    return f"""
        SELECT user_id, live, dead, round(dead / greatest(live + dead, 1) * 100, 2) AS dead_pct
        FROM (SELECT user_id, live, dead FROM ({_COUNTERS_SQL})) {where}
    """


@query("t4_stale_ratio", _stale_sql("WHERE dead > 10 AND dead / greatest(live + dead, 1) > 0.1"))
def stale_ratio(spark, folder):
    counters = _counters(spark, folder).select("user_id", "live", "dead")
    return W.stale_ratio(counters, "user_id", min_dead=10)


@query("t4_all_counters_by_ratio", _stale_sql(""))
def all_counters(spark, folder):
    counters = _counters(spark, folder).select("user_id", "live", "dead")
    return W.stale_ratio(counters, "user_id", min_dead=None, min_share=None)


@query(
    "x11_rounded_percent",
    """
    SELECT l_returnflag, round(sqrt(abs(sum(l_quantity))), 4) AS root,
           round(100.0 * count(*) FILTER (l_discount > 0.05) / count(*), 2)::DOUBLE AS pct,
           least(min(l_tax), 1.0)::DOUBLE AS low, greatest(max(l_tax), 0.0)::DOUBLE AS high
    FROM lineitem GROUP BY l_returnflag
    """,
)
def rounded_percent(spark, folder):
    return (
        load(spark, folder, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            F.round(F.sqrt(F.abs(F.sum("l_quantity"))), 4).alias("root"),
            F.round(F.count_if(F.col("l_discount") > 0.05) * 100.0 / F.count("*"), 2)
            .cast("double")
            .alias("pct"),
            F.least(F.min("l_tax"), F.lit(1.0)).alias("low"),
            F.greatest(F.max("l_tax"), F.lit(0.0)).alias("high"),
        )
    )
