"""Statistics over a statement log and over counter tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ORDERS = ("total_ms", "mean_ms", "calls")


def slow_statements(
    log: DataFrame,
    statement: str = "statement",
    ms: str = "ms",
    rows: str | None = None,
    min_calls: int = 5,
    order_by: str = "total_ms",
    limit: int = 20,
) -> DataFrame:
    """Calls and times per statement, the heaviest first."""
    if order_by not in ORDERS:
        raise ValueError(f"order_by must be one of {ORDERS}, not {order_by!r}")
    measures = [
        F.count("*").alias("calls"),
        F.sum(ms).alias("total_ms"),
        F.avg(ms).alias("mean_ms"),
        F.max(ms).alias("max_ms"),
        F.stddev_pop(ms).alias("stddev_ms"),
    ]
    if rows:
        measures.append(F.sum(rows).alias("rows"))
    return (
        log.groupBy(statement)
        .agg(*measures)
        .filter(F.col("calls") >= min_calls)
        .orderBy(F.desc(order_by), statement)
        .limit(limit)
    )


def _share(part: Column, rest: Column) -> Column:
    return F.try_divide(part.cast("double"), (part + rest).cast("double"))


def hit_ratio(
    counters: DataFrame, pairs: Sequence[tuple[str, str, str]], target: float = 0.95
) -> DataFrame:
    """Read and hit sums, their ratio and whether it is below the target.

    ``pairs`` holds (name, read column, hit column); one row comes back.
    """
    sums = counters.agg(
        *[F.sum(read).alias(f"{name}_read") for name, read, _ in pairs],
        *[F.sum(hit).alias(f"{name}_hit") for name, _, hit in pairs],
    )
    for name, _, _ in pairs:
        ratio = _share(F.col(f"{name}_hit"), F.col(f"{name}_read"))
        sums = sums.withColumn(f"{name}_ratio", ratio).withColumn(
            f"{name}_below", F.coalesce(F.col(f"{name}_ratio") < target, F.lit(False))
        )
    return sums


def member_usage(
    objects: DataFrame, usage: DataFrame, key: str, size: str
) -> DataFrame:
    """Uses per object, the least used and then the largest first."""
    counts = usage.groupBy(key).agg(F.count("*").alias("n_uses"))
    return (
        objects.select(key, size)
        .join(counts, key, "left")
        .withColumn("n_uses", F.coalesce("n_uses", F.lit(0)))
        .orderBy(F.asc("n_uses"), F.desc(size), key)
    )


def unused_members(objects: DataFrame, usage: DataFrame, key: str, size: str) -> DataFrame:
    """Objects never used, the largest first."""
    return (
        objects.select(key, size)
        .join(usage.select(key), key, "left_anti")
        .orderBy(F.desc(size), key)
    )


def dead_share(live: Column, dead: Column) -> Column:
    return dead.cast("double") / F.greatest(live + dead, F.lit(1)).cast("double")


def stale_ratio(
    counters: DataFrame,
    key: str,
    live: str = "live",
    dead: str = "dead",
    min_dead: int | None = 1000,
    min_share: float | None = 0.1,
) -> DataFrame:
    """Share of dead rows per table in percent, the worst first.

    Without the two floors every table is listed.
    """
    shared = counters.withColumn("dead_share", dead_share(F.col(live), F.col(dead)))
    if min_dead is not None:
        shared = shared.filter(F.col(dead) > min_dead)
    if min_share is not None:
        shared = shared.filter(F.col("dead_share") > min_share)
    return (
        shared.withColumn("dead_pct", F.round(F.col("dead_share") * 100, 2))
        .orderBy(F.desc("dead_share"), key)
        .drop("dead_share")
    )
