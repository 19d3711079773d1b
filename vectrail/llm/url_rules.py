"""URL filters: which rule of a list fits each url, by a sort-merge range join.

The labels of a host are written in reverse, each closed by a dot (``net.example.``).
A host then stands, with all its subdomains, in one interval of sorted keys: the keys that
begin with it.  Rules and urls are sorted together and swept once.  The sweep keeps a
stack: one slot per number of labels, holding the last rule host of that many labels.
A slot is active where its key begins the url's key.  No other host of as many labels
can lie between the two, so the last one is enough.

The sorted keys are range-partitioned.  What a partition needs of those before it is one
stack, carried over by a table of a row per partition.  Urls with equal hosts are dealt
over several partitions.  Everything is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectrail.llm.line_dedup import UPPER
from vectrail.session import work_path
from vectrail.sources.tables import write_table

SLOTS = 32  # slots of one sweep; more take further sweeps


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path of a url, both empty for NULL or without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def host_key(host: Column) -> Column:
    """``www.example.net`` as ``net.example.www.``."""
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.", -1)), "."), F.lit("."))


def _spread(df: DataFrame) -> Column:
    """A hash of the columns that can be hashed, to deal out rows with equal keys."""
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(f"`{c}`") for c in plain]) if plain else F.lit(0).cast("long")


def sweep(entries: DataFrame, probes: DataFrame, slots: Sequence[int]) -> DataFrame:
    """The stack of active entries of every probe, ``_stack``, longest key last.

    ``entries`` has ``_key``, ``_slot`` and ``_entry`` (any type that can be ordered); two
    entries with the same slot never begin with one another.  ``probes`` has ``_key``,
    ``_spread`` (a long that deals out probes with equal keys) and ``_row`` (any type).  An
    element of the stack has ``key`` and ``entry``.
    """
    spark = probes.sparkSession
    row = probes.schema["_row"].dataType
    entry = entries.schema["_entry"].dataType
    # An entry comes before the probes with its own key.
    both = entries.select(
        "_key", F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_spread"), "_slot", "_entry",
        F.lit(None).cast(row).alias("_row"),
    ).unionByName(
        probes.select(
            "_key", F.lit(1).alias("_kind"), "_spread", F.lit(None).cast("int").alias("_slot"),
            F.lit(None).cast(entry).alias("_entry"), "_row",
        )
    )
    dealt = both.repartitionByRange("_key", "_kind", "_spread").withColumn("_part", F.spark_partition_id())
    dealt = write_table(dealt, work_path(spark, "sweep"))

    def held(slot: int) -> Column:
        return F.when(F.col("_slot") == slot, F.struct(F.col("_key").alias("key"), F.col("_entry").alias("entry")))

    names = {slot: f"_slot_{slot}" for slot in slots}
    # One row per partition: the stack that the partitions before it leave.
    ends = dealt.groupBy("_part").agg(*[F.max(held(s)).alias(n) for s, n in names.items()])
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        F.col("_part"), *[F.last(n, ignorenulls=True).over(before).alias(f"_before{n}") for n in names.values()]
    )
    so_far = W.partitionBy("_part").orderBy("_key", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    swept = dealt.select(
        "_part", "_key", "_kind", "_row",
        *[F.last(held(s), ignorenulls=True).over(so_far).alias(n) for s, n in names.items()],
    ).filter("_kind = 1")
    # As many rows as range partitions: small enough for every task.
    swept = swept.join(F.broadcast(carried), "_part")
    slots_now = F.array(*[F.coalesce(n, f"_before{n}") for n in names.values()])
    active = F.filter(slots_now, lambda s: s.isNotNull() & F.startswith(F.col("_key"), s["key"]))
    return swept.select("_key", "_row", active.alias("_stack"))


_BEST = "struct<n:int,host_n:int,verdict:string,rule:string>"
_PATHS = "array<struct<path:string,verdict:string>>"
_HOSTS = "array<struct<key:string,host:string,labels:int>>"


def _ranked(host: Column, path: Column, verdict: Column) -> Column:
    """What decides between fitting rules: the longest, then the longer host, then the later verdict."""
    return F.struct(
        (F.char_length(host) + F.char_length(path)).cast("int").alias("n"),
        F.char_length(host).cast("int").alias("host_n"),
        verdict.alias("verdict"),
        F.concat(host, path).alias("rule"),
    )


def _batches(slots: Sequence[int]) -> list[Sequence[int]]:
    return [slots[i : i + SLOTS] for i in range(0, len(slots), SLOTS)]


def judge_urls(
    urls: DataFrame, rules: DataFrame, url_column: str = "url", default: str = "allow", paths_per_host: int = 64
) -> DataFrame:
    """Which rule fits every url: ``row`` (all its columns), ``host``, ``path``, ``rule``, ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict``.  A rule fits its host and all subdomains where
    the url's path begins with the rule's.  The longest (host and path together) wins, then the
    longer host; of the same rule given twice the verdict that sorts last (``block``) counts.
    Where none fits, ``rule`` is NULL and ``verdict`` is ``default``.

    Up to ``paths_per_host`` paths of a host travel in the stack itself; the paths of a host with
    more are intervals of a second sweep, so that no row carries a long list.

    A NULL url, or one without ``://``, has an empty host and path, which no rule fits.  Rules with
    a NULL or empty host or a NULL verdict are left out; a NULL path is empty.  Repeated urls
    are judged each.  An empty table of urls gives no rows, one of rules gives ``default``.  The columns
    of ``urls`` come back inside ``row``, so their names can't clash.
    """
    spark = urls.sparkSession
    clean = (
        rules.select(
            F.translate("host", UPPER, UPPER.lower()).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            "verdict",
        )
        .filter("host IS NOT NULL AND host <> '' AND verdict IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("key", host_key(F.col("host")))
        .withColumn("labels", F.size(F.split("host", "\\.", -1)))
    )
    clean = write_table(clean, work_path(spark, "url-rules"))
    counts = clean.groupBy("host").agg(F.count("*").alias("n"))
    large = clean.join(counts.filter(F.col("n") > paths_per_host), "host", "left_semi")
    listed = (
        clean.join(counts.filter(F.col("n") <= paths_per_host), "host", "left_semi")
        .groupBy("host", "key", "labels")
        .agg(F.sort_array(F.collect_list(F.struct("path", "verdict"))).alias("rules"))
    )
    hosts = listed.unionByName(large.select("host", "key", "labels").distinct(), allowMissingColumns=True)
    entries = hosts.select(
        F.col("key").alias("_key"), F.col("labels").alias("_slot"), F.struct("host", "labels", "rules").alias("_entry")
    )

    row = F.struct(*[F.col(f"`{c}`") for c in urls.columns])
    split = urls.select(row.alias("row"), F.col(f"`{url_column}`").alias("url"), _spread(urls).alias("spread"))
    host, path = host_and_path(F.col("url"))
    found = split.select(
        F.struct(
            "row", "spread", host.alias("host"), path.alias("path"),
            F.lit(None).cast(_BEST).alias("best"), F.array().cast(_HOSTS).alias("large"),
        ).alias("_row")
    )
    for slots in _batches(_values(entries, "_slot")):  # numbers of labels
        probes = found.select(host_key(F.col("_row.host")).alias("_key"), F.col("_row.spread").alias("_spread"), "_row")
        fits = F.flatten(
            F.transform(
                "_stack",
                lambda s: F.transform(
                    F.filter(
                        F.coalesce(s["entry"]["rules"], F.array().cast(_PATHS)),
                        lambda r: F.startswith(F.col("_row.path"), r["path"]),
                    ),
                    lambda r: _ranked(s["entry"]["host"], r["path"], r["verdict"]),
                ),
            )
        )
        under = F.transform(
            F.filter("_stack", lambda s: s["entry"]["rules"].isNull()),
            lambda s: F.struct(s["key"], s["entry"]["host"].alias("host"), s["entry"]["labels"].alias("labels")),
        )
        found = sweep(entries, probes, slots).select(
            F.col("_row")
            .withField("best", F.greatest("_row.best", F.array_max(fits)))
            .withField("large", F.concat("_row.large", under))
            .alias("_row")
        )
    if not large.isEmpty():
        found = _many_paths(large, found)
    return found.select(
        F.col("_row.row").alias("row"),
        F.col("_row.host").alias("host"),
        F.col("_row.path").alias("path"),
        F.col("_row.best.rule").alias("rule"),
        F.coalesce("_row.best.verdict", F.lit(default)).alias("verdict"),
    )


def _values(df: DataFrame, column: str) -> list[int]:
    """The different values of a column of lengths: no more than the longest key has characters."""
    return sorted(r[0] for r in df.select(column).distinct().collect())


def _many_paths(large: DataFrame, found: DataFrame) -> DataFrame:
    """The best rule of urls under hosts with many paths: the same sweep over host and path."""
    for labels in _values(large, "labels"):  # a url lies under at most one host of so many labels
        entries = large.filter(F.col("labels") == labels).select(
            F.concat("key", "path").alias("_key"),
            F.char_length("path").alias("_slot"),
            F.struct("host", "path", "verdict").alias("_entry"),
        )
        own = F.try_element_at(F.filter("_row.large", lambda s: s["labels"] == labels), F.lit(1))
        for slots in _batches(_values(entries, "_slot")):
            probes = found.select("_row", own.alias("own")).select(
                F.concat(F.coalesce("own.key", F.lit("")), F.col("_row.path")).alias("_key"),
                F.col("_row.spread").alias("_spread"),
                "_row",
            )
            top = F.array_max(
                F.transform("_stack", lambda s: _ranked(s["entry"]["host"], s["entry"]["path"], s["entry"]["verdict"]))
            )
            swept = sweep(entries.filter(F.col("_slot").isin(list(slots))), probes, slots)
            found = swept.select(F.col("_row").withField("best", F.greatest("_row.best", top)).alias("_row"))
    return found
