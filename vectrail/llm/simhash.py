"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``radius`` bits have a common variant
within ``radius / 2`` bits of both.  Every distinct fingerprint emits its ball
of variants; those that meet in a variant are linked.  A ball of radius 2 has
2,081 variants, so they are not shuffled one by one: a variant is dealt out by its
leading bits, one row stands for all variants of a fingerprint with the same
leading bits, and the task that gets the row writes the variants out.  Where too many
variants have the same lead, more bits are taken, until every part is small.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrail.llm.components import connected_components
from vectrail.llm.texts import pieces, release
from vectrail.session import work_path
from vectrail.sources.tables import write_table

SEED = 42
MORE_BITS = 4  # taken at a time where a lead has too many variants


def fingerprint(text: bytes | None, words_per_shingle: int = 4) -> int:
    """The 64 bits of a text as an unsigned number.

    Words are runs without ASCII space, A-Z lower-cased; a shingle is that many words
    joined by spaces (all of them if there are fewer) and is hashed by XXH64.  A bit
    is set if over half of the shingles have it.  No words: 0.
    """
    ones = np.zeros(64, np.int64)
    n = 0
    digest = xxhash.xxh64_intdigest
    tail: list[bytes] = []
    for piece in pieces(text or b""):
        words = tail + piece.lower().split()  # bytes: ASCII letters and ASCII space only
        if len(words) < words_per_shingle:
            tail = words
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[: len(words) - words_per_shingle]]).tolist()
        joined = b" ".join(words)
        hashes = np.array(
            [digest(joined[i : j - 1], SEED) for i, j in zip(starts, ends[words_per_shingle - 1 :].tolist())],
            np.uint64,
        )
        n += len(hashes)
        ones += _bit_counts(hashes)
        tail = words[len(words) - words_per_shingle + 1 :]
    if n == 0:
        if not tail:
            return 0
        return digest(b" ".join(tail), SEED)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits."""
    total = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 4096):
        part = hashes[start : start + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return total


def fingerprints(
    documents: DataFrame, words_per_shingle: int = 4, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``_id`` and ``_fp`` (bigint with the 64 bits) of every row.  A NULL text has no words."""

    def run(batches):
        for batch in batches:
            prints = np.fromiter(
                (fingerprint(text.as_py(), words_per_shingle) for text in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["_id", "_fp"])
        release()

    rows = documents.select(F.col(id_column).alias("_id"), F.col(text_column).cast("binary").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, _fp bigint")


def _flips(bits: int, most: int) -> np.ndarray:
    """Masks of ``bits`` bits with at most ``most`` of them set."""
    masks = [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)]
    return np.array(masks, np.uint64)


def _meet(prints: np.ndarray, lead: int, lead_bits: int, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (fingerprint, smallest linked fingerprint) among those with variants under one lead.

    Each print has variants that begin with ``lead``.  Prints that meet in a variant
    are linked to one of them, not to each other, and the links are
    contracted before they leave the task.
    """
    low_bits = 64 - lead_bits
    low = prints & np.uint64((1 << low_bits) - 1)
    used = np.bitwise_count((prints >> np.uint64(low_bits)) ^ np.uint64(lead))
    variants, owners = [], []
    for spent in range(half + 1):
        here = np.flatnonzero(used == spent)
        masks = _flips(low_bits, half - spent)
        variants.append((low[here][:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(here, len(masks)))
    every = np.concatenate(variants)
    in_order = np.sort(every)
    twice = np.unique(in_order[1:][in_order[1:] == in_order[:-1]])
    if not len(twice):
        return prints[:0], prints[:0]
    at = np.minimum(np.searchsorted(twice, every), len(twice) - 1)
    hit = np.flatnonzero(twice[at] == every)
    owner = np.concatenate(owners)[hit]
    group = at[hit]
    order = np.lexsort((owner, group))
    owner, group = owner[order], group[order]
    first = np.concatenate([[True], group[1:] != group[:-1]])
    hub = owner[np.flatnonzero(first)[np.cumsum(first) - 1]]
    pairs = np.unique(np.stack([owner, hub], 1)[owner != hub], axis=0)
    near = np.bitwise_count(prints[pairs[:, 0]] ^ prints[pairs[:, 1]]) <= 2 * half
    pairs = pairs[near]
    label = np.arange(len(prints))
    while len(pairs):
        before = label.copy()
        least = np.minimum(label[pairs[:, 0]], label[pairs[:, 1]])
        np.minimum.at(label, pairs[:, 0], least)
        np.minimum.at(label, pairs[:, 1], least)
        label = label[label]
        if np.array_equal(before, label):
            break
    linked = np.flatnonzero(label != np.arange(len(prints)))
    return prints[linked], prints[label[linked]]


def lead_bits_for(prints: int, tasks: int, half: int, rows_per_lead: int = 32_768) -> int:
    """How many leading bits cut the variants finely enough.

    At least four leads for each task, and at most ``rows_per_lead`` rows under an
    average lead.  The links found are the same for any number.
    """
    bits = 4
    while bits < 30:
        rows = prints * len(_flips(bits, half)) / 2**bits
        if 2**bits >= 4 * tasks and rows <= rows_per_lead:
            break
        bits += 1
    return bits


def _parts(prints: DataFrame, bits: int, half: int, most: int) -> DataFrame:
    """``_fp``, ``_bits`` and ``_lead``: every print under each lead that variants of it begin with.

    A lead with more than ``most`` variants is cut by further bits, level by level.  With
    all 64 bits a lead is one variant, which at most 2,081 prints (of radius 2) have.
    """
    spark = prints.sparkSession

    def cut(rows: DataFrame, bits: int, more: int) -> DataFrame:
        """Leads of ``bits`` bits out of those that are ``more`` bits shorter."""
        flips = F.explode(F.array(*[F.lit(int(m)) for m in _flips(more, half)])).alias("_flip")
        own = F.shiftrightunsigned("_fp", 64 - bits)
        tail = own.bitwiseAND(F.lit((1 << more) - 1)).bitwiseXOR(F.col("_flip"))
        lead = F.shiftleft("_lead", more).bitwiseOR(tail)
        longer = rows.select("_fp", "_lead", flips).select("_fp", lead.alias("_lead"))
        return longer.filter(F.bit_count(own.bitwiseXOR(F.col("_lead"))) <= half)

    rows = cut(prints.select("_fp", F.lit(0).cast("long").alias("_lead")), bits, bits)
    done = None
    while bits < 64:
        used = F.bit_count(F.shiftrightunsigned("_fp", 64 - bits).bitwiseXOR(F.col("_lead")))
        variants = F.array(*[F.lit(len(_flips(64 - bits, half - spent))) for spent in range(half + 1)])
        large = rows.groupBy("_lead").agg(F.sum(F.get(variants, used)).alias("_variants")).filter(F.col("_variants") > most)
        large = write_table(large.select("_lead"), work_path(spark, "simhash-large"))
        if large.isEmpty():
            break
        small = rows.join(large, "_lead", "left_anti").select("_fp", F.lit(bits).alias("_bits"), "_lead")
        done = small if done is None else done.unionByName(small)
        more = min(MORE_BITS, 64 - bits)
        bits += more
        rows = write_table(cut(rows.join(large, "_lead", "left_semi"), bits, more), work_path(spark, "simhash-leads"))
    rows = rows.select("_fp", F.lit(bits).alias("_bits"), "_lead")
    return rows if done is None else done.unionByName(rows)


def linked_fingerprints(prints: DataFrame, radius: int = 4, most_variants: int = 1 << 22) -> DataFrame:
    """Links ``a``, ``b`` whose components are those of all pairs within ``radius`` bits.

    ``prints`` has distinct values ``_fp``.  ``radius`` must be even, so that the two
    halves of the way are equal and every two prints that meet are within it.  No task
    writes out more than ``most_variants`` variants at once.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    spark = prints.sparkSession
    half = radius // 2
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = lead_bits_for(prints.count(), tasks, half)

    def meet(key, table):
        lead = key[1].as_py() & ((1 << 64) - 1)
        found = _meet(table.column("_fp").to_numpy().view(np.uint64), lead, key[0].as_py(), half)
        return pa.table([pa.array(x.view(np.int64)) for x in found], ["a", "b"])

    parts = _parts(prints, bits, half, most_variants)
    return parts.groupBy("_bits", "_lead").applyInArrow(meet, "a bigint, b bigint").distinct()


def near_duplicates(
    documents: DataFrame,
    radius: int = 4,
    words_per_shingle: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``documents``: ``_id``, ``_fp`` and ``component_id``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest id that is reachable.  Texts without words
    have fingerprint 0 and are linked like others.  A NULL id takes part but is
    never a component's name (it is NULL where no document of the component has an
    id).  Repeated rows get the same answer; an empty table gives no rows.
    """
    spark = documents.sparkSession
    rows = write_table(
        fingerprints(documents, words_per_shingle, id_column, text_column), work_path(spark, "simhash")
    )
    # Equal fingerprints are one node; their documents are counted before any shuffle.
    prints = write_table(rows.groupBy("_fp").agg(F.min("_id").alias("_first")), work_path(spark, "simhash-prints"))
    links = linked_fingerprints(prints.select("_fp"), radius)
    roots = connected_components(links, "a", "b").select(F.col("node").alias("_fp"), "root")
    rooted = prints.join(roots, "_fp", "left").withColumn("root", F.coalesce("root", "_fp"))
    names = rooted.groupBy("root").agg(F.min("_first").alias("component_id"))
    named = rooted.join(names, "root").select("_fp", "component_id")
    return rows.join(named, "_fp").select("_id", "_fp", "component_id")


def fingerprint_text(value: str = "_fp"):
    """Sixteen lowercase hex digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def one_of_each(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents that name their component, all columns; of rows with the same id one.

    Rows without id can't be told apart and stay.
    """
    found = near_duplicates(documents, id_column=id_column, text_column=text_column, **options)
    stay = found.filter(F.col("_id") == F.col("component_id")).select(F.col("_id").alias(id_column)).distinct()
    kept = documents.join(stay, id_column, "left_semi").dropDuplicates([id_column])
    return kept.unionByName(documents.filter(F.col(id_column).isNull()))
