"""Spelling variants: words one edit apart, found by a relational trie frontier.

The trie of the vocabulary is a table of edges: node (a prefix), next character, and the
characters that may follow it.  States (word, position, node, edits) are joined with
it level by level, a level being a length of nodes.  A state without an edit meets all
edges of its node and becomes states with one edit; a state with one edit follows the edge
of its word's next character.  States that reach the end of a word are neighbours.

An edit is placed where the two words first differ, so each neighbour is reached
once.  Edits in the first half of a word would meet the crowded upper levels of the trie,
so they are sought in the trie of the reversed words, where they lie deep.  Edges carry the
characters that follow, so a state that would die within a few levels is never made.

Words above ``LONG`` characters would need as many levels.  They meet by digests of the
word with each character left out instead: also exact, and linear in their length.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectrail.llm.line_dedup import UPPER
from vectrail.session import work_path
from vectrail.sources.tables import write_table

LONG = 64  # characters of a word that the trie takes
END = "$"  # closes a word; no run holds it
AHEAD = 3  # characters after an edge that it carries


def word_counts(
    documents: DataFrame,
    min_chars: int = 7,
    min_count: int = 2,
    noise_every: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Words and how often they occur: ``word``, ``n``.

    A word is a maximal run of letters (A-Z, a-z, U+00C0 to U+00FF) with A-Z lower-cased.  With
    ``noise_every``, a run loses the character at ``h % length`` where ``noise_every`` divides h, the
    crc32 of ``<id>:<run>``; this plants variants.  Words below ``min_chars`` characters or
    ``min_count`` occurrences are left out.

    A NULL text has no words, a NULL id counts as empty text.  Repeated rows count each.
    """
    pattern = "[A-Za-z\\u00C0-\\u00FF]{%d,}" % min_chars  # greedy, so a run is taken whole
    run = F.col("run")
    bare = F.when(F.octet_length(run) == F.char_length(run), F.lower(run)).otherwise(
        F.translate(run, UPPER, UPPER.lower())
    )
    runs = documents.select(
        F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(f"`{text_column}`"), F.lit(pattern), F.lit(0))).alias("run"),
    ).select("id", bare.alias("word"))
    if noise_every:
        h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
        at = F.col("h") % F.char_length("word")
        cut = F.concat(F.substr("word", F.lit(1), at.cast("int")), F.substr("word", (at + 2).cast("int")))
        runs = runs.withColumn("h", h).select(F.when(F.col("h") % noise_every == 0, cut).otherwise(F.col("word")).alias("word"))
        runs = runs.filter(F.char_length("word") >= min_chars)
    return runs.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _piece(text: Column, start, length: int) -> Column:
    """``length`` characters from position ``start`` (from 0) of a word and its end marks."""
    return F.substr(F.concat(text, F.lit(END * (AHEAD + 1))), (start + 1).cast("int"), F.lit(length))


def _requests(states: DataFrame) -> DataFrame:
    """What states of one level ask of the edges: each a node and the characters after the edge.

    ``pos`` is the position behind the edge.  ``want`` is the character of the edge; NULL takes all
    but ``skip`` and the end.
    """
    pos = F.col("pos")
    none = F.lit(None).cast("string")
    # All that is asked about lies within a few characters; they are cut out of the word once.
    states = states.select("way", "word", "node", "pos", "edits", _piece(F.col("word"), pos, AHEAD + 2).alias("tail"))

    def part(start, length):
        return F.substr("tail", F.lit(start + 1), F.lit(length))

    def ask(step, want, skip):
        return F.struct(
            (pos + step).cast("int").alias("pos"), part(step, AHEAD).alias("ahead"), want.alias("want"), skip.alias("skip")
        )

    here, after = part(0, 1), part(1, 1)
    # In a run of equal characters the last one is taken as deleted or inserted.
    replaced = F.when(here != END, ask(1, none, here))
    inserted = ask(0, none, here)
    deleted = F.when((here != END) & (here != after), ask(2, after, none))
    followed = ask(1, here, none)
    asks = F.when(F.col("edits") == 0, F.array(replaced, inserted, deleted)).otherwise(F.array(followed))
    return states.select("way", "word", "node", F.explode(asks).alias("ask")).filter("ask IS NOT NULL").select(
        "way", "word", "node", "ask.*"
    )


def _by_trie(words: DataFrame) -> DataFrame:
    """Pairs ``word``, ``near`` of words up to LONG characters that are one edit apart."""
    spark = words.sparkSession
    n = F.char_length("word")
    half = F.floor(n / 2).cast("int")
    # Forward, edits begin at ``half``; backward, with the rest of the word behind them.  Edges begin
    # where a word one character longer would begin to look.
    ways = F.array(
        F.struct(F.lit(0).alias("way"), F.col("word").alias("word"), half.alias("start"), F.floor((n - 1) / 2).cast("int").alias("low")),
        F.struct(F.lit(1).alias("way"), F.reverse("word").alias("word"), (n - half).cast("int").alias("start"), half.alias("low")),
    )
    spelled = words.select(F.explode(ways).alias("w")).select("w.*")
    rows = spelled.select("way", "word", F.explode(F.sequence("low", F.char_length("word"))).alias("depth"))
    # An edge's own character and those that follow are one column while they are made distinct.
    edges = rows.select(
        "way",
        F.substr("word", F.lit(1), F.col("depth")).alias("node"),
        _piece(F.col("word"), F.col("depth"), AHEAD + 1).alias("tail"),
    ).distinct()
    edges = edges.select(
        "way",
        "node",
        F.substr("tail", F.lit(2), F.lit(AHEAD)).alias("ahead"),
        F.substr("tail", F.lit(1), F.lit(1)).alias("next"),
        F.char_length("node").alias("depth"),
    )
    edges = write_table(edges, work_path(spark, "trie-edges"), partition_by=["depth"])
    spelled = write_table(spelled, work_path(spark, "trie-words"))
    reach = spelled.agg(F.min("low").alias("low"), F.max(F.char_length("word")).alias("high")).first()
    found = []
    edited = None
    for depth in range(reach["low"] or 0, (reach["high"] or -1) + 2):
        at_start = spelled.filter(F.lit(depth).between(F.col("start"), F.char_length("word"))).select(
            "way", "word", F.lit(depth).alias("pos"), F.substr("word", F.lit(1), F.lit(depth)).alias("node"), F.lit(0).alias("edits")
        )
        states = at_start if edited is None else at_start.unionByName(edited)
        asked = _requests(states)
        here = edges.filter(F.col("depth") == depth).drop("depth")
        fits = F.when(F.col("want").isNull(), ~F.col("next").isin(END) & (F.col("next") != F.col("skip"))).otherwise(
            F.col("next") == F.col("want")
        )
        # The node comes first: rows are sorted by the first bytes of the first column, and ``way`` is 0 or 1.
        level = asked.join(here, ["node", "ahead", "way"]).filter(fits).select(
            "way", "word", "pos",
            F.when(F.col("next") == END, F.col("node")).otherwise(F.concat("node", "next")).alias("node"),
            (F.col("next") == END).alias("ended"),
        )
        level = write_table(level, work_path(spark, f"trie-level-{depth}"))
        found.append(level.filter("ended").select("way", "word", "node"))
        edited = level.filter("NOT ended").select("way", "word", "pos", "node", F.lit(1).alias("edits"))
    if not found:
        return words.select("word", F.col("word").alias("near")).limit(0)
    met = reduce(DataFrame.unionByName, found)
    forward = met.filter("way = 0").select("word", F.col("node").alias("near"))
    half_of = lambda c: F.substr(c, F.lit(1), F.floor(F.char_length("word") / 2).cast("int"))
    backward = (
        met.filter("way = 1")
        .select(F.reverse("word").alias("word"), F.reverse("node").alias("near"))
        .filter(half_of("word") != half_of("near"))  # the others are found forward
    )
    return forward.unionByName(backward)


# A prime and bases of the digests; four digests make 124 bits.
_PRIME = (1 << 31) - 1
_BASES = (910_111_387, 1_390_208_809, 536_869_909, 1_765_432_127)


def _left_out(word: str) -> tuple[np.ndarray, np.ndarray]:
    """Digests (two longs) of a word with each character left out; the last row is the whole word."""
    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.int64)
    n = len(codes)
    out = []
    for base in _BASES:
        power = np.ones(1, np.int64)
        while len(power) < n:
            power = np.concatenate([power, power * pow(base, len(power), _PRIME) % _PRIME])
        sums = np.concatenate([[0], np.cumsum(codes * power[:n] % _PRIME)])
        behind = (sums[n] - sums[1:]) % _PRIME * pow(base, -1, _PRIME) % _PRIME
        out.append(np.append((sums[:n] + behind) % _PRIME, sums[n] % _PRIME))
    return out[0] << 31 | out[1], out[2] << 31 | out[3]


def _gaps(batches):
    for batch in batches:
        for key, word in zip(batch.column("key").to_pylist(), batch.column("word").to_pylist()):
            d1, d2 = _left_out(word)
            codes = np.frombuffer(word.encode("utf-32-le"), np.uint32)
            # Of a run of equal characters any gap gives the same word; the last one stands for them.
            last = np.append(np.append(codes[1:] != codes[:-1], True), True)
            gap = np.append(np.arange(len(codes), dtype=np.int32), np.int32(-1))
            for at in range(0, len(gap), 100_000):
                cut = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(gap[cut]), key)),
                        pa.array(gap[cut]), pa.array(last[cut]), pa.array(d1[cut]), pa.array(d2[cut]),
                    ],
                    ["key", "gap", "last", "d1", "d2"],
                )


def _by_gaps(words: DataFrame) -> DataFrame:
    """Pairs ``word``, ``near`` one edit apart, of words of at least LONG characters."""
    keyed = words.select(F.xxhash64("word").alias("key"), "word")
    gaps = keyed.mapInArrow(_gaps, "key long, gap int, last boolean, d1 long, d2 long")
    gaps = write_table(gaps, work_path(words.sparkSession, "spelling-gaps"))
    one = gaps.select("key", "gap", "last", "d1", "d2")
    two = gaps.select(F.col("key").alias("near_key"), "gap", "d1", "d2")
    replaced = one.filter("gap >= 0").join(two, ["gap", "d1", "d2"]).filter("key <> near_key").select("key", "near_key")
    whole = two.filter("gap = -1").drop("gap")
    shorter = one.filter("gap >= 0 AND last").join(whole, ["d1", "d2"]).select("key", "near_key")
    longer = shorter.select(F.col("near_key").alias("key"), F.col("key").alias("near_key"))
    pairs = replaced.unionByName(shorter).unionByName(longer)
    near = keyed.select(F.col("key").alias("near_key"), F.col("word").alias("near"))
    # Digests are checked against the words themselves.
    return pairs.join(keyed, "key").join(near, "near_key").filter(F.levenshtein("word", "near", 1) == 1).select("word", "near")


def near_words(words: DataFrame) -> DataFrame:
    """All pairs ``word``, ``near`` of different words one inserted, deleted or replaced character apart.

    Both orders of a pair are given, each once.  ``words`` has different values of ``word``; a NULL
    or empty one is near to nothing.
    """
    plain = words.select("word").filter("word <> ''")
    n = F.char_length("word")
    long = _by_gaps(plain.filter(n >= LONG)).filter(
        (F.char_length("word") > LONG) | (F.char_length("near") > LONG)
    )
    return _by_trie(plain.filter(n <= LONG)).unionByName(long)


def variants(counts: DataFrame, times: int = 10) -> DataFrame:
    """The form that each word is a variant of: ``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root``.

    ``counts`` has ``word`` and ``n``, each word once.  A word's form is its near word of the largest
    ``n`` (ties: the first in code-point order) where that is at least ``times`` its own; else NULL.
    ``root`` follows the forms to the last one; a word without a form is its own.
    ``n_near`` counts near words.  An empty table gives no rows.
    """
    spark = counts.sparkSession
    counts = write_table(counts.select("word", F.col("n").cast("long").alias("n")), work_path(spark, "spelling-counts"))
    pairs = write_table(near_words(counts), work_path(spark, "spelling-pairs"))
    other = counts.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    summed = pairs.join(other, "near").groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("first")
    )
    joined = counts.join(summed, "word", "left")
    has = -F.col("first.minus") >= times * F.col("n")
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("first.near")).alias("form"), F.when(has, -F.col("first.minus")).alias("form_n"),
    )
    formed = write_table(formed, work_path(spark, "spelling-forms"))
    # A form is ``times`` as frequent as its word, so a chain has few steps; each round doubles its reach.
    step = formed.filter("form IS NOT NULL").select("word", F.col("form").alias("to"))
    top = counts.agg(F.max("n")).first()[0] or 1
    steps, reach = 1, times
    while reach < top:
        steps, reach = steps + 1, reach * times
    for _ in range(max(0, steps - 1).bit_length()):
        onward = step.select(F.col("word").alias("to"), F.col("to").alias("further"))
        step = step.join(onward, "to", "left").select("word", F.coalesce("further", "to").alias("to"))
        step = write_table(step, work_path(spark, "spelling-roots"))
    roots = step.select("word", F.col("to").alias("root"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
