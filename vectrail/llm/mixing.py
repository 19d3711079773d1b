"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, the expected number of its copies.  Among all rates
that give each source its target of words, entropy balancing takes those nearest
to one in relative entropy: ``min(max_copies, exp(lambda * x))``, ``x`` the size
of the document and ``lambda`` one multiplier per source.  The multipliers solve
a convex dual; Newton steps, one Spark job for all sources at once, find them.
The rates are then rounded into whole copies so that the sums stay on target.

The steps work on counts per (source, size), not on documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectrail.llm.texts import free_prefix
from vectrail.session import work_path
from vectrail.sources.tables import write_table

WEIGHTS = (3, 1, 2)
NEWTON_STEPS = 30
HASH_BITS = 10  # documents of one source and size are cut into 2**10 parts by hash


def word_count(text: Column) -> Column:
    """Number of runs without ASCII space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, max_copies: int = 2) -> DataFrame:
    """Adds ``target`` to a table of ``_source``, ``_size_sum`` (one row per source).

    The sources in code point order, NULL last, weigh ``weights``, repeating, and
    share ``share`` of all words.  A target stops at ``max_copies`` times the words
    of its source; what is above goes to the others by weight until none is above.
    That is one water level: ``min(limit, level * weight)``.
    """
    everything = W.partitionBy()  # one row per source
    place = F.row_number().over(W.orderBy(F.asc_nulls_last("_source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place, F.lit(len(weights))) + 1)
    limit = F.col("_size_sum").cast("double") * max_copies
    # A source is full where the level at which it fills up does not use up the total.
    upto = W.orderBy("_fills").rangeBetween(W.unboundedPreceding, W.currentRow)
    table = (
        sizes.withColumn("_weight", weight)
        .withColumn("_limit", limit)
        .withColumn("_fills", F.col("_limit") / F.col("_weight"))
        .withColumn("_total", F.sum("_size_sum").over(everything) * F.lit(share))
        .withColumn("_all", F.sum("_weight").over(everything))
    )
    used = F.sum("_limit").over(upto) + F.col("_fills") * (F.col("_all") - F.sum("_weight").over(upto))
    table = table.withColumn("_full", used <= F.col("_total"))
    open_weight = F.sum(F.when(~F.col("_full"), F.col("_weight"))).over(everything)
    taken = F.sum(F.when(F.col("_full"), F.col("_limit")).otherwise(0.0)).over(everything)
    level = (F.col("_total") - taken) / open_weight
    return table.withColumn(
        "target", F.when(F.col("_full"), F.col("_limit")).otherwise(level * F.col("_weight"))
    ).select("_source", "_size_sum", "target")


def _rate(max_copies: int) -> Column:
    tilted = F.exp(F.least(F.col("_lambda") * F.col("_size") / F.col("_largest"), F.lit(700.0)))
    return F.when(F.col("_done_full"), F.lit(float(max_copies))).otherwise(
        F.least(F.lit(float(max_copies)), tilted)
    )


def balance(
    histogram: DataFrame, goals: DataFrame, max_copies: int = 2, tolerance: float = 0.25, max_steps: int = 100
) -> DataFrame:
    """Multipliers per source: ``goals`` with ``_lambda`` and ``_done_full``.

    ``histogram`` has ``_source``, ``_size``, ``_n``.  Newton steps on the dual,
    kept inside a bracket (halved where a step would leave it).  It ends when
    every source is within ``tolerance`` words of its target, or has no words.
    """
    spark = histogram.sparkSession
    size = F.col("_size").cast("double")
    most = histogram.groupBy("_source").agg(F.max("_size").cast("double").alias("_largest"))
    state = _same_source(goals, most).withColumns(
        {
            "_lambda": F.lit(0.0),
            "_low": F.lit(None).cast("double"),
            "_high": F.lit(None).cast("double"),
            # No finite multiplier reaches the limit itself.
            "_done_full": F.col("target") >= F.col("_size_sum") * float(max_copies) * (1 - 1e-12),
            "_open": F.lit(True),
        }
    )
    state = write_table(state, work_path(spark, "balance"))
    for turn in range(max_steps):
        at = _same_source(histogram, state.filter("_open AND NOT _done_full AND _largest > 0"))
        rate = _rate(max_copies)
        words = F.col("_n") * size * rate
        slope = F.when(rate < max_copies, words * size / F.col("_largest")).otherwise(0.0)
        sums = at.groupBy("_source").agg(F.sum(words).alias("_words"), F.sum(slope).alias("_slope"))
        moved = _same_source(state, sums, "left")
        gap = F.col("_words") - F.col("target")
        # A bracket that doubles can't split any further ends the search too.
        narrow = F.coalesce(F.col("_high") - F.col("_low") <= 1e-15 * (F.abs("_high") + F.abs("_low")), F.lit(False))
        settled = F.coalesce(F.abs(gap) <= tolerance, F.lit(True)) | narrow
        low = F.when(gap < 0, F.col("_lambda")).otherwise(F.col("_low"))
        high = F.when(gap > 0, F.col("_lambda")).otherwise(F.col("_high"))
        newton = F.col("_lambda") - gap / F.nullif(F.col("_slope"), F.lit(0.0))
        moved = moved.withColumns({"_low2": low, "_high2": high, "_newton": newton})
        inside = (F.coalesce(F.col("_newton") > F.col("_low2"), F.col("_low2").isNull())) & (
            F.coalesce(F.col("_newton") < F.col("_high2"), F.col("_high2").isNull())
        )
        wide = F.abs(F.col("_lambda")) * 2 + 1
        other = F.coalesce(
            (F.col("_low2") + F.col("_high2")) / 2,
            F.when(F.col("_low2").isNull(), F.col("_lambda") - wide).otherwise(F.col("_lambda") + wide),
        )
        # Newton settles in a few steps; where it does not, halving the bracket does.
        newton_step = F.col("_newton").isNotNull() & inside & F.lit(turn < NEWTON_STEPS)
        step = F.when(newton_step, F.col("_newton")).otherwise(other)
        moved = moved.select(
            "_source",
            "_size_sum",
            "target",
            "_largest",
            F.when(settled, F.col("_lambda")).otherwise(step).alias("_lambda"),
            F.col("_low2").alias("_low"),
            F.col("_high2").alias("_high"),
            "_done_full",
            (~settled).alias("_open"),
        )
        state = write_table(moved, work_path(spark, "balance"))
        if state.filter("_open").isEmpty():
            return state
    raise RuntimeError(f"the mix did not settle in {max_steps} steps")


def _same_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on ``_source``, NULL being a source of its own."""
    other = right.withColumnRenamed("_source", "_source_2")
    return left.join(other, F.col("_source").eqNullSafe(F.col("_source_2")), how).drop("_source_2")


def _whole_copies(groups: DataFrame, max_copies: int, passes: int = 3) -> DataFrame:
    """Adds ``_copies``, the copies that all documents of a (source, size) get together.

    The running sum of the rates, longest documents first, is rounded, so sums
    miss their target by half of the longest document at most.  Each pass then
    adds or takes one copy of the size nearest to what is still missing.
    """
    order = W.partitionBy("_source").orderBy(F.desc("_size")).rowsBetween(W.unboundedPreceding, W.currentRow)
    rates = F.col("_n") * F.col("_rate")
    after = F.sum(rates).over(order)
    table = groups.withColumn("_after", after)
    place = W.partitionBy("_source").orderBy(F.desc("_size"))
    before = F.coalesce(F.lag("_after").over(place), F.lit(0.0))
    copies = F.floor(F.col("_after") + 0.5) - F.floor(before + 0.5)
    limit = F.col("_n") * max_copies
    table = table.withColumn("_copies", F.greatest(F.lit(0), F.least(copies, limit))).drop("_after")
    for _ in range(passes):
        whole = W.partitionBy("_source")
        missing = F.round(F.col("target") - F.sum(F.col("_copies") * F.col("_size")).over(whole)).cast("long")
        table = table.withColumn("_missing", missing)
        can = F.when(F.col("_missing") > 0, F.col("_copies") < limit).otherwise(F.col("_copies") > 0)
        off = F.abs(F.abs("_missing") - F.col("_size"))
        better = can & (off < F.abs("_missing"))
        table = table.withColumn("_try", F.when(better, F.struct(off.alias("off"), F.col("_size").alias("at"))))
        chosen = F.min("_try").over(whole)["at"] == F.col("_size")
        change = F.when(chosen, F.signum(F.col("_missing").cast("double")).cast("long")).otherwise(F.lit(0))
        table = table.withColumn("_copies", F.col("_copies") + F.coalesce(change, F.lit(0))).drop("_missing", "_try")
    return table


def mix(
    documents: DataFrame,
    weights=WEIGHTS,
    share: float = 1.5,
    max_copies: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    prefix: str = "_mix",
) -> DataFrame:
    """All rows and columns of ``documents`` with their part in the mix.

    Adds ``<prefix>_size`` (words), ``<prefix>_source_size``, ``<prefix>_target``
    (of the source, in words), ``<prefix>_rate`` and ``<prefix>_copies`` (0 to
    ``max_copies``).  Among documents of the same source and size a hash of the id
    decides who gets one copy more, so that reruns agree.

    A NULL source is a source of its own, a NULL text has no words.  Documents
    without words keep one copy or more, at no cost.  Repeated rows are decided
    alike.  With no words at all every target is 0.  Where columns begin with the prefix, it
    gets underscores appended (``texts.free_prefix``).
    """
    spark = documents.sparkSession
    prefix = free_prefix(documents, prefix)
    size = word_count(F.col(text_column))
    mark = F.xxhash64(F.lit("mix"), id_column)
    light = write_table(
        documents.select(F.col(source_column).alias("_source"), size.alias("_size"), mark.alias("_mark")),
        work_path(spark, "mix-sizes"),
    )
    parts = (
        light.groupBy("_source", "_size", F.shiftrightunsigned("_mark", 64 - HASH_BITS).alias("_part"))
        .agg(F.count("*").alias("_in"))
    )
    parts = write_table(parts, work_path(spark, "mix-parts"))
    histogram = parts.groupBy("_source", "_size").agg(F.sum("_in").alias("_n"))
    sums = histogram.groupBy("_source").agg(F.sum(F.col("_n") * F.col("_size")).alias("_size_sum"))
    goals = targets(sums, weights, share, max_copies)
    state = balance(histogram, goals, max_copies)
    rated = _same_source(histogram, state).withColumn(
        "_rate", F.when(F.col("_largest") > 0, _rate(max_copies)).otherwise(F.lit(1.0))
    )
    rated = rated.withColumn("_rate", F.when(F.col("_size") == 0, F.lit(1.0)).otherwise(F.col("_rate")))
    groups = write_table(
        _whole_copies(rated, max_copies).select(
            "_source", "_size", "_size_sum", "target", "_rate",
            F.expr("_copies DIV _n").alias("_each"),
            (F.col("_copies") % F.col("_n")).alias("_extra"),
        ),
        work_path(spark, "mix-groups"),
    )
    # The extra copies go to the smallest hashes.  The part that holds the last of
    # them is found from the counts, and only its few rows are put in order.
    key = ["_source", "_size"]
    running = W.partitionBy(*key).orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)
    located = (
        _same_group(parts, groups.filter("_extra > 0").select(*key, "_extra"))
        .withColumn("_upto", F.sum("_in").over(running))
        .filter((F.col("_upto") >= F.col("_extra")) & (F.col("_upto") - F.col("_in") < F.col("_extra")))
        .select(*key, "_part", (F.col("_extra") - (F.col("_upto") - F.col("_in"))).alias("_nth"))
    )
    inside = light.withColumn("_part", F.shiftrightunsigned("_mark", 64 - HASH_BITS))
    last = (
        _same_group(inside, located, ["_part"])
        .withColumn("_place", F.row_number().over(W.partitionBy(*key, "_part").orderBy("_mark")))
        .filter(F.col("_place") == F.col("_nth"))
        .select(*key, F.col("_mark").alias("_last"))
    )
    table = _same_group(groups, last, how="left").select(
        F.col("_source").alias(f"{prefix}_source"),
        F.col("_size").alias(f"{prefix}_words"),
        F.col("_size_sum").alias(f"{prefix}_source_size"),
        F.col("target").alias(f"{prefix}_target"),
        F.col("_rate").alias(f"{prefix}_rate"),
        F.col("_each").alias(f"{prefix}_each"),
        F.col("_last").alias(f"{prefix}_last"),
    )
    sized = documents.withColumn(f"{prefix}_size", size)
    joined = sized.join(
        table,
        sized[source_column].eqNullSafe(F.col(f"{prefix}_source"))
        & (F.col(f"{prefix}_size") == F.col(f"{prefix}_words")),
    )
    # Hashes are ordered by their parts, which read them without a sign.
    flip = F.lit(-(1 << 63))
    extra = F.coalesce(mark.bitwiseXOR(flip) <= F.col(f"{prefix}_last").bitwiseXOR(flip), F.lit(False))
    return joined.withColumn(f"{prefix}_copies", F.col(f"{prefix}_each") + extra.cast("long")).drop(
        f"{prefix}_source", f"{prefix}_words", f"{prefix}_each", f"{prefix}_last"
    )


def _same_group(left: DataFrame, right: DataFrame, more=(), how: str = "inner") -> DataFrame:
    """Join on source (NULL-safe), size and ``more``."""
    names = ["_size", *more]
    other = right.withColumnsRenamed({c: f"{c}_2" for c in ["_source", *names]})
    on = F.col("_source").eqNullSafe(F.col("_source_2"))
    for name in names:
        on = on & (F.col(name) == F.col(f"{name}_2"))
    return left.join(other, on, how).drop("_source_2", *[f"{c}_2" for c in names])


def copies_of(mixed: DataFrame, prefix: str = "_mix") -> DataFrame:
    """The mix itself: every row as often as its copies say, without the added columns."""
    added = [f"{prefix}_{c}" for c in ("size", "source_size", "target", "rate", "copies")]
    times = F.expr(f"explode(sequence(1, CAST({prefix}_copies AS INT)))")
    return mixed.filter(F.col(f"{prefix}_copies") > 0).withColumn(f"{prefix}_i", times).drop(*added, f"{prefix}_i")
