"""Line dedup: which lines of a document also stand elsewhere, as bitmaps.

Lines travel as 128-bit hashes with document and position, never as text.  The
hashes are range-partitioned and sorted by document and position, so that the
occurrences of a line are streamed in order: the first one is seen first, and a
document counts once where its id changes.  The answer is one small bitmap per
document.  Everything is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectrail.llm.texts import free_prefix
from vectrail.session import work_path
from vectrail.sources.tables import write_table

SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lines_of(text: Column) -> Column:
    """The lines of a text; a NULL or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """What makes two lines equal: ASCII space stripped at both ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(SPACE))
    # lower() is cheap and changes A-Z alone where every character is ASCII.
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def repeated_lines(
    documents: DataFrame,
    min_docs: int = 2,
    keep_first: bool = False,
    min_chars: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Bitmaps of the lines to drop, one row per document that loses any.

    A line is dropped where its key has at least ``min_chars`` code points and
    stands in at least ``min_docs`` different documents; with ``keep_first`` its
    first occurrence (smallest id, then position) stays.

    Returns ``_id``, ``_row`` (a digest of the text, which tells rows with the
    same id apart), ``n_dropped`` and ``dropped``: the words of the bitmap that
    are not zero, as a map from word number to 64 bits.  Line ``p`` is dropped
    if bit ``p % 64`` of word ``p / 64`` is set; words left out keep all lines.

    A NULL id counts as one document.  Repeated rows count as one document and
    get the same bitmap.  An empty table gives no rows; other columns are not
    looked at.
    """
    spark = documents.sparkSession
    key = line_key(F.col("_line"))
    found = documents.select(
        F.col(id_column).alias("_id"),
        F.xxhash64(text_column).alias("_row"),
        F.posexplode(lines_of(F.col(text_column))).alias("_pos", "_line"),
    )
    hashed = found.withColumn("_key", key).filter(F.char_length("_key") >= min_chars).select(
        F.xxhash64("_key").alias("_h1"),
        F.xxhash64(F.lit(1), "_key").alias("_h2"),
        "_id",
        "_row",
        "_pos",
    )
    # Read three times below (range sample, stream, lookup); texts are read once.
    lines = write_table(hashed, work_path(spark, "line-hashes"))

    # A line that stands in very many documents is cut into slices by document,
    # as many as there are shuffle partitions, so that no task holds it whole.
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = lines.withColumn("_slice", F.pmod(F.xxhash64("_id"), F.lit(slices))).repartitionByRange(
        "_h1", "_h2", "_slice"
    )
    stream = W.partitionBy("_h1", "_h2", "_slice").orderBy("_id", "_row", "_pos")
    new_document = (F.row_number().over(stream) == 1) | ~F.col("_id").eqNullSafe(
        F.lag("_id").over(stream)
    )
    summed = (
        ranged.withColumn("_new", new_document.cast("long"))
        .groupBy("_h1", "_h2")
        .agg(
            F.sum("_new").alias("_docs"),
            F.min(F.struct("_id", "_row", "_pos")).alias("_first"),
        )
    )
    often = summed.filter(F.col("_docs") >= min_docs).drop("_docs")
    if not keep_first:
        often = often.drop("_first")
    hit = lines.join(often, ["_h1", "_h2"])
    if keep_first:
        hit = hit.filter(~F.struct("_id", "_row", "_pos").eqNullSafe(F.col("_first")))
    words = hit.groupBy("_id", "_row", F.expr("CAST(_pos DIV 64 AS INT)").alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, _pos % 64))").alias("_bits")
    )
    return words.groupBy("_id", "_row").agg(
        F.sum(F.bit_count("_bits")).cast("long").alias("n_dropped"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("_word", "_bits")))).alias("dropped"),
    )


def kept_text(text: str, dropped: str) -> Column:
    """The lines of ``text`` that the bitmap keeps, joined again."""
    lines = f"split(coalesce({text}, ''), '\\n', -1)"
    gone = f"bit_get(coalesce(try_element_at({dropped}, CAST(i DIV 64 AS INT)), 0L), i % 64) = 1"
    return F.when(F.col(dropped).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.expr(f"array_join(filter({lines}, (x, i) -> NOT ({gone})), '\\n')")
    )


def drop_repeated_lines(
    documents: DataFrame,
    min_docs: int = 2,
    keep_first: bool = False,
    min_chars: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
    prefix: str = "_line_dedup",
) -> DataFrame:
    """All rows and columns of ``documents`` with the kept text and two counts.

    Adds ``<prefix>_text``, ``<prefix>_lines`` (before) and ``<prefix>_dropped``.
    A NULL text is one empty line, so its kept text is empty.  See
    ``repeated_lines`` for which lines go.  Where columns begin with the prefix, it gets
    underscores appended (``texts.free_prefix``).
    """
    prefix = free_prefix(documents, prefix)
    bitmaps = repeated_lines(documents, min_docs, keep_first, min_chars, id_column, text_column)
    renamed = bitmaps.select(
        F.col("_id").alias(f"{prefix}_id"),
        F.col("_row").alias(f"{prefix}_row"),
        F.col("n_dropped").alias(f"{prefix}_n"),
        F.col("dropped").alias(f"{prefix}_map"),
    )
    same = F.col(id_column).eqNullSafe(F.col(f"{prefix}_id")) & (
        F.xxhash64(text_column) == F.col(f"{prefix}_row")
    )
    return (
        documents.join(renamed, same, "left")
        .withColumn(f"{prefix}_lines", F.size(lines_of(F.col(text_column))).cast("long"))
        .withColumn(f"{prefix}_dropped", F.coalesce(F.col(f"{prefix}_n"), F.lit(0)).cast("long"))
        .withColumn(f"{prefix}_text", kept_text(text_column, f"{prefix}_map"))
        .drop(f"{prefix}_id", f"{prefix}_row", f"{prefix}_n", f"{prefix}_map")
    )
