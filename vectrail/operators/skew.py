"""Building blocks that stay even when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectrail.session import work_path
from vectrail.sources.tables import write_table

# A key with more rows than this is not left to one task.
ROWS_PER_KEY = 1_000_000


def null_safe_join(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Inner join that also pairs NULL with NULL, so that a NULL key is kept."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in columns})
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns]
    return left.join(renamed, on).drop(*[f"_r_{c}" for c in columns])


def salted_lookup(
    big: DataFrame,
    small: DataFrame,
    key: str,
    copies: str,
    spread_by: str,
    rows_per_task: int = 1_000_000,
    how: str = "left",
) -> DataFrame:
    """Join ``big`` with the unique rows of ``small``, splitting hot keys.

    ``small`` has one row per ``key`` and, in ``copies``, how many rows of
    ``big`` carry it.  A key above ``rows_per_task`` is spread over as many
    salts as it fills tasks; every other key keeps one.  There are fewer hot keys than
    the rows of ``big`` fill tasks; Spark picks the join with them by their size.
    """
    hot = small.filter(F.col(copies) > rows_per_task).select(
        key, F.ceil(F.col(copies) / rows_per_task).cast("int").alias("_salts")
    )
    one = F.coalesce(F.col("_salts"), F.lit(1))
    left = (
        big.join(hot, key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread_by), one).cast("int"))
        .drop("_salts")
    )
    right = (
        small.join(hot, key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), one - 1)))
        .drop("_salts", copies)
    )
    return left.join(right, [key, "_salt"], how).drop("_salt")


def number_rows(
    df: DataFrame, order: str, ties: Sequence[str] = (), start: int = 1, buckets: int | None = None,
    name: str = "position",
) -> DataFrame:
    """Dense numbers in the order of ``order`` and ``ties``, without one big sort task.

    One shuffle: the rows are range-partitioned, sorted within their partition and stored with
    their place in it.  The sizes of the partitions, a row each, give where every partition
    begins.  ``buckets`` is the number of partitions, by default that of shuffles, fitted to the
    data.  A value of ``order`` with very many rows is split by the ties.
    """
    columns = [order, *ties]
    dealt = df.repartitionByRange(buckets, *columns) if buckets else df.repartitionByRange(*columns)
    # Number of the partition times 2^33, plus the place of the row in it.  Stored, so it stays.
    placed = dealt.sortWithinPartitions(*columns).withColumn("_id", F.monotonically_increasing_id())
    stored = write_table(placed, work_path(df.sparkSession, "numbered")).withColumn("_bucket", F.shiftright("_id", 33))
    sizes = stored.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)  # a row per partition
    begins = sizes.select("_bucket", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + start).alias("_begin"))
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.join(F.broadcast(begins), "_bucket")
        .withColumn(name, (F.col("_begin") + place).cast("long"))
        .drop("_bucket", "_begin", "_id")
    )


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, name: str = "position"
) -> DataFrame:
    """First k rows of every group.

    The filter on ``row_number`` lets Spark cut each map task to k rows per
    group before the shuffle, so a hot group never travels whole.
    """
    window = W.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)


def windowed(
    df: DataFrame,
    key: str,
    plain: Callable[[DataFrame], DataFrame],
    sliced: Callable[[DataFrame], DataFrame],
    rows_per_key: int = ROWS_PER_KEY,
) -> DataFrame:
    """``plain`` for keys of ordinary size, ``sliced`` for keys counted above ``rows_per_key``.

    Both give the same columns; an ordinary window over the key is the plain way, and
    what it shuffles is all that is shuffled where no key is hot.
    """
    counted = df.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_key)
    hot = write_table(counted.select(F.col(key).alias("_hot")), work_path(df.sparkSession, "hot-keys"))
    if hot.isEmpty():
        return plain(df)
    marked = df.join(hot.withColumn("_is_hot", F.lit(True)), F.col(key).eqNullSafe(F.col("_hot")), "left")
    few = marked.filter("_is_hot IS NULL").drop("_hot", "_is_hot")
    many = marked.filter("_is_hot").drop("_hot", "_is_hot")
    return plain(few).unionByName(sliced(many))


def running_windows(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    slice_of: Column,
    rows_per_key: int = ROWS_PER_KEY,
) -> DataFrame:
    """Running total, position and previous value per key.

    Adds ``position``, ``running_total`` and ``previous``.  A hot key is cut into slices:
    ``slice_of`` must not decrease along ``order`` (a day of the time column, say).
    """

    def plain(rows: DataFrame) -> DataFrame:
        window = W.partitionBy(key).orderBy(*order)
        running = window.rowsBetween(W.unboundedPreceding, W.currentRow)
        return rows.withColumns(
            {
                "position": F.row_number().over(window).cast("long"),
                "running_total": F.sum(value).over(running),
                "previous": F.lag(value).over(window),
            }
        )

    def sliced(rows: DataFrame) -> DataFrame:
        done = sliced_running(rows, key, order, value, slice_of)
        return done.withColumn("position", F.col("position").cast("long"))

    return windowed(df, key, plain, sliced, rows_per_key)


def sliced_running(
    df: DataFrame, key: str, order: Sequence[str], value: str, slice_of: Column
) -> DataFrame:
    """``running_windows`` slice by slice.

    Each task sorts one slice of one key; the slices are chained through one small row
    each, so a key with a third of all rows is not sorted in one task.
    """
    cut = df.withColumn("_slice", slice_of)
    ends = cut.groupBy(key, "_slice").agg(
        F.count("*").alias("_n"),
        F.sum(value).alias("_sum"),
        F.max_by(value, F.struct(*order)).alias("_last"),
    )
    chain = W.partitionBy(key).orderBy("_slice")
    before = chain.rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        F.col(key),
        F.col("_slice"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum0"),
        F.lag("_last").over(chain).alias("_last0"),
    )
    inside = W.partitionBy(key, "_slice").orderBy(*order)
    running = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = (
        cut.withColumn("_pos", F.row_number().over(inside))
        .withColumn("_run", F.sum(value).over(running))
        .withColumn("_prev", F.lag(value).over(inside))
    )
    return (
        null_safe_join(placed, carried, [key, "_slice"])
        .withColumn("position", F.col("_pos") + F.col("_n0"))
        .withColumn("running_total", F.col("_run") + F.col("_sum0"))
        .withColumn("previous", F.when(F.col("_pos") > 1, F.col("_prev")).otherwise(F.col("_last0")))
        .drop("_slice", "_pos", "_run", "_prev", "_n0", "_sum0", "_last0")
    )


def framed_mean(
    df: DataFrame, key: str, position: str, value: str, preceding: int, name: str = "mean",
    rows_per_key: int = ROWS_PER_KEY,
) -> DataFrame:
    """Mean over a row and the ``preceding`` rows before it, per key.

    ``position`` is a dense number per key.  Every row of a hot key adds its value to the
    frames it belongs to, and the frames are summed by key and position, so that key
    is not gathered in one task.
    """

    def plain(rows: DataFrame) -> DataFrame:
        window = W.partitionBy(key).orderBy(position).rowsBetween(-preceding, W.currentRow)
        return rows.withColumn(name, F.avg(value).over(window))

    def sliced(rows: DataFrame) -> DataFrame:
        places = F.sequence(F.col(position), F.col(position) + preceding)
        sums = (
            rows.select(key, F.col(value).alias("_v"), F.explode(places).alias(position))
            .groupBy(key, position)
            .agg(F.avg("_v").alias(name))
        )
        return null_safe_join(rows, sums, [key, position])

    return windowed(df, key, plain, sliced, rows_per_key)


def sliced_ranks(df: DataFrame, key: str, order: Sequence[str], slice_of: Column) -> DataFrame:
    """Add ``rank`` and ``dense_rank`` of the first of ``order`` per key, slice by slice.

    Equal values are counted before they are ranked.  See ``running_windows``
    for ``slice_of``.  This is the way for hot keys; see ``windowed``.
    """
    lead = order[0]
    counted = df.groupBy(key, lead).agg(F.count("*").alias("_copies"))
    ranked = sliced_running(counted, key, [lead], "_copies", slice_of).select(
        key,
        lead,
        (F.col("running_total") - F.col("_copies") + 1).alias("rank"),
        F.col("position").alias("dense_rank"),
    )
    return null_safe_join(df, ranked, [key, lead])
