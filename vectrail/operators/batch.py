"""Many queries in one job, and the summary of a search log."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectrail.functions import kernels, text, vector
from vectrail.operators.embedding import Embedder, embed_with_reuse
from vectrail.operators.search import fuse
from vectrail.operators.skew import top_per_group
from vectrail.session import work_path
from vectrail.sources.tables import write_table

# Bounds on the queries of a block, which a task holds one at a time, and on the rows it holds meanwhile.
MAX_SHARED_QUERIES = 16_384
MAX_SHARED_BYTES = 64 * 1024 * 1024
HELD_BYTES = 64 * 1024 * 1024

# Bounds on the sets of terms of a block, on the terms whose forms are a block (some 25 forms each),
# and on the words and the postings of a part, all held by a task one at a time.
MAX_SHARED_FORMS = 100_000
MAX_SHARED_SETS = 200_000
MAX_SHARED_TERMS = 2_000_000
PART_ROWS = 4_000_000
TEXT_CLASSES = 8  # classes of texts by weight, whose ranks are bounded together


def batch_vector_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 5,
    metric: str = "cosine",
    query_key: str = "query_id",
    query_vector: str = "query_vector",
    key: str = "id",
    vector_column: str = "embedding",
    max_shared_queries: int = MAX_SHARED_QUERIES,
    max_shared_bytes: int = MAX_SHARED_BYTES,
    keep_undefined: bool = True,
) -> DataFrame:
    """The k nearest corpus rows of every query, exact.

    Columns: query key, corpus key, ``distance``, ``similarity``, ``position``.  The queries are
    stored in blocks; each task of the one scan of the corpus reads the blocks one after the
    other and keeps k rows per query, so that no pair of query and row is ever a Spark row, the
    corpus is never shuffled and the queries never pass the driver.  The work folder must be
    one that Arrow can open (a shared file system, HDFS or an object store).

    Rows without a distance to a query come last, as in ``vector_search``; without
    ``keep_undefined`` they are left out.  A NULL query vector is not asked.
    """
    spark = queries.sparkSession
    asked = queries.select(query_key, query_vector).filter(F.col(query_vector).isNotNull())
    rows = corpus.select(key, vector_column)
    if not keep_undefined:
        rows = rows.filter(F.col(vector_column).isNotNull())
    size = asked.agg(F.count("*").alias("n"), F.sum(F.size(query_vector) * 8).alias("b")).first()
    blocks = max(-(-size["n"] // max_shared_queries), -(-(size["b"] or 0) // max_shared_bytes), 1)
    path = work_path(spark, "asked")
    asked.withColumn("_block", F.pmod(F.xxhash64(query_key), F.lit(blocks))).repartition(
        blocks, "_block"
    ).write.partitionBy("_block").parquet(path)
    near = _against_blocks(path, blocks, asked.schema, rows, k, metric, keep_undefined)
    order = [F.asc_nulls_last("distance"), F.col(key).asc()]
    return top_per_group(near, [query_key], order, k).withColumn(
        "similarity", vector.similarity(F.col("distance"))
    )


def _one_chunk(column: pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _by_width(keys: pa.Array, vectors: pa.Array) -> dict[int, tuple[pa.Array, np.ndarray]]:
    """Keys and vectors by length; an element that is NULL counts as NaN."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    groups = {}
    for n in np.unique(lengths).tolist():
        some = pa.array(lengths == n)
        flat = vectors.filter(some).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        groups[n] = keys.filter(some), flat.reshape(-1, n)
    return groups


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _keys(column: pa.Array) -> np.ndarray:
    if pa.types.is_integer(column.type) and not column.null_count:
        return column.to_numpy(zero_copy_only=False)
    return np.asarray(column.to_pylist())


def _read_files(path: str) -> pa.Table | None:
    """The rows of a stored folder, wherever Arrow can read it."""
    if "://" in path or path.startswith("file:"):
        store, root = fs.FileSystem.from_uri(path)
    else:
        store, root = fs.LocalFileSystem(), path
    chosen = fs.FileSelector(root, allow_not_found=True)
    files = [f.path for f in store.get_file_info(chosen) if f.path.endswith(".parquet")]
    return pa.concat_tables([pq.read_table(f, filesystem=store, partitioning=None) for f in files]) if files else None


def _read_block(path: str, block: int) -> pa.Table | None:
    """The queries of one stored block."""
    return _read_files(f"{path}/_block={block}")


def _undefined(ids: np.ndarray, rows: np.ndarray, valid: np.ndarray, k: int, metric: str) -> np.ndarray:
    """The k smallest keys of rows that have no distance to any query of this length."""
    lost = ~valid | np.isnan(rows).any(axis=1)
    if metric == "cosine":
        lost |= (rows == 0).all(axis=1)
    return np.sort(ids[lost])[:k]


def _against_blocks(
    path: str, blocks: int, asked: T.StructType, rows: DataFrame, k: int, metric: str, keep_undefined: bool
) -> DataFrame:
    """The k nearest rows of every stored query, per part of the corpus that a task holds at a time."""
    key = rows.schema.fields[0]
    schema = T.StructType([asked.fields[0], key, T.StructField("distance", T.DoubleType())])
    arrow_schema = _arrow_schema(schema)

    def answer(held: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = _keys(held.column(0))
        vectors = _one_chunk(held.column(1))
        matrices: dict[int, tuple] = {}  # by length of the queries, made once for all blocks
        for block in range(blocks):
            queries = _read_block(path, block)
            if queries is None:
                continue
            for width, (names, matrix) in _by_width(*(_one_chunk(queries.column(i)) for i in (0, 1))).items():
                if width not in matrices:
                    found, valid = kernels.matrix(vectors, width)
                    lost = _undefined(ids, found, valid, k, metric) if keep_undefined else ids[:0]
                    matrices[width] = ids[valid], found[valid], lost
                fit, found, lost = matrices[width]
                nearest = kernels.Nearest(matrix, k, metric)
                nearest.add(fit, found)
                at, near, distances = nearest.arrays()
                parts = [(at, near, pa.array(distances))]
                if keep_undefined:
                    for i in np.flatnonzero(nearest.found < k):
                        # A query without a direction has no distance to any row.
                        none = metric == "cosine" and not matrix[i].any()
                        others = np.sort(ids)[:k] if none else lost
                        parts.append((np.full(len(others), i), others, pa.nulls(len(others), pa.float64())))
                for at, near, distances in parts:
                    if not len(at):
                        continue
                    columns = [names.take(pa.array(at)), pa.array(near.tolist() if near.dtype == object else near), distances]
                    yield pa.RecordBatch.from_arrays(
                        [c.cast(field.type) for c, field in zip(columns, arrow_schema)], schema=arrow_schema
                    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= HELD_BYTES:
                yield from answer(pa.Table.from_batches(held))
                held, size = [], 0
        if held:
            yield from answer(pa.Table.from_batches(held))

    return rows.mapInArrow(run, schema)


def batch_text_search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 10,
    query_key: str = "query_id",
    query: str = "query",
    key: str = "id",
    content: str = "content",
    language: str = "french",
) -> DataFrame:
    """The k best texts of every query.

    Queries with the same terms are one set of terms, answered once.  The terms that the sets
    ask for are counted where a text is read, and its counts stay one row, so that no word of
    the corpus is shuffled.  A set of one term takes the best texts of that term; the others
    are evaluated by bounds, see ``_best_of_many``.  Texts are cut to k per set in every task
    before they are shuffled.
    """
    spark = queries.sparkSession
    asked = queries.select(
        query_key, text.query_terms(F.col(query), language).alias("_terms")
    ).filter(F.size("_terms") > 0)
    asked = write_table(asked.withColumn("_set", F.sha1(F.array_join("_terms", " "))), work_path(spark, "asked"))
    sets = write_table(asked.groupBy("_set").agg(F.first("_terms").alias("_terms")), work_path(spark, "sets"))

    vocabulary = sets.select(F.explode("_terms").alias("_term")).distinct()
    texts = _counted(corpus, vocabulary, key, content, language)

    # One term: the best k texts of every term serve all sets that ask for it.
    one = F.size("_terms") == 1
    alone = sets.filter(one).select("_set", F.col("_terms")[0].alias("_term"))
    single = _postings(texts, key).join(alone, "_term", "left_semi").select(
        "_term", key, F.round(text.saturation(F.col("_tf")), text.RANK_DECIMALS).alias("text_rank")
    )
    best = top_per_group(single, ["_term"], [F.desc("text_rank"), F.col(key).asc()], k)
    columns = ["_set", key, "text_rank", "position"]
    found = alone.join(best, "_term").select(*columns).unionByName(
        _best_of_many(sets.filter(~one), texts, k, key).select(*columns)
    )
    return asked.select(query_key, "_set").join(found, "_set").drop("_set")


def _counted(corpus: DataFrame, vocabulary: DataFrame, key: str, content: str, language: str) -> DataFrame:
    """Texts with the terms of ``vocabulary`` that they hold, ``_terms``, and how often, ``_counts``.

    The forms of the terms are stored in blocks; a task reads them one after the other and counts
    the texts it scans, a row each.  Only texts whose key comes more than once are shuffled, to
    be added up as one text.
    """
    spark = corpus.sparkSession
    path = work_path(spark, "asked-forms")
    blocks = max(-(-vocabulary.count() // MAX_SHARED_FORMS), 1)
    dealt = vocabulary.repartition(spark.sparkContext.defaultParallelism)
    text.word_forms(dealt, "_term", "_word", language).select(
        "_word", "_term", F.pmod(F.xxhash64("_term"), F.lit(blocks)).alias("_block")
    ).write.partitionBy("_block").parquet(path)
    rows = corpus.select(key, F.split(F.lower(F.col(content)), text.WORD_GAP).alias("_words"))
    schema = T.StructType([rows.schema[key], *_COUNTS])
    arrow_schema = _arrow_schema(schema)

    def read() -> Iterator[tuple[pa.Array, pa.Array]]:
        for block in range(blocks):
            forms = _read_block(path, block)
            if forms is not None:
                yield _one_chunk(forms.column("_word")), _one_chunk(forms.column("_term"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = list(read()) if blocks == 1 else None
        for batch in batches:
            for start, length in _slices(batch.column(1), MAX_SHARED_TERMS):
                part = batch.slice(start, length)
                places, codes, counts, terms = kernels.list_counts(part.column(1), read() if kept is None else kept)
                held, sizes = np.unique(places, return_counts=True)
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                columns = [
                    part.column(0).take(pa.array(held)),
                    pa.ListArray.from_arrays(offsets, terms.take(pa.array(codes))),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(field.type) for c, field in zip(columns, arrow_schema)], schema=arrow_schema
                )

    counted = write_table(rows.mapInArrow(run, schema), work_path(spark, "counted-texts"), **_WIDE)
    several = counted.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1")
    repeated = write_table(several.select(F.col(key).alias("_repeated")), work_path(spark, "repeated-keys"))
    if repeated.isEmpty():
        return counted
    same = F.col(key).eqNullSafe(F.col("_repeated"))
    merged = _by_text(_postings(counted.join(repeated, same, "left_semi"), key), key)
    return counted.join(repeated, same, "left_anti").unionByName(merged)


# The columns that hold the counts of a text.
_COUNTS = (
    T.StructField("_terms", T.ArrayType(T.StringType())),
    T.StructField("_counts", T.ArrayType(T.LongType())),
)
# Beyond 1 MB of distinct terms in a file, Parquet would write every one of them out.
_WIDE = {"parquet.dictionary.page.size": str(8 * 1024 * 1024)}


def _postings(texts: DataFrame, key: str) -> DataFrame:
    """A row per text and term."""
    each = texts.select(key, F.explode(F.arrays_zip("_terms", "_counts")).alias("_p"))
    return each.select(key, F.col("_p._terms").alias("_term"), F.col("_p._counts").alias("_tf"))


def _by_text(postings: DataFrame, key: str) -> DataFrame:
    """Postings as a row per text, stored; counts of equal keys and terms are added up."""
    counts = postings.repartition(key).groupBy(key, "_term").agg(F.sum("_tf").cast("long").alias("_tf"))
    held = counts.groupBy(key).agg(F.collect_list(F.struct("_term", "_tf")).alias("_p"))
    rows = held.select(key, F.col("_p._term").alias("_terms"), F.col("_p._tf").alias("_counts"))
    return write_table(rows, work_path(postings.sparkSession, "grouped-texts"), **_WIDE)


def _classed(texts: DataFrame, key: str, classes: int) -> DataFrame:
    """Texts with their ``_class``: those of like weight (occurrences of asked terms) together.

    Heavy texts hold the high counts, so the greatest count of a term falls from class to class;
    the heaviest class is the last, marked ``_heavy``.
    """
    weight = F.aggregate("_counts", F.lit(0).cast("long"), lambda total, n: total + n)
    weighed = texts.filter(F.col(key).isNotNull()).withColumn("_weight", weight)
    shares = [i / classes for i in range(1, classes)]
    cuts = weighed.agg(F.percentile_approx("_weight", shares, 10_000).alias("c")).first()["c"] or []
    lighter = [(F.col("_weight") > F.lit(c)).cast("int") for c in sorted(set(cuts))]
    classed = weighed.withColumn("_class", sum(lighter, F.lit(0)))
    last = classed.agg(F.max("_class").alias("c")).first()["c"] or 0
    return classed.select(key, "_terms", "_counts", "_class", (F.col("_class") == last).alias("_heavy"))


def _slices(lists: pa.ListArray, most: int) -> Iterator[tuple[int, int]]:
    """Start and length of runs of lists that together have some ``most`` elements."""
    before = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), len(lists)] if len(lists) else []
    for start, end in zip(cuts, cuts[1:]):
        yield start, end - start


def _pairs(sets: DataFrame, texts: DataFrame, key: str, k: int, part_rows: int) -> DataFrame:
    """Sets and the k best texts of every part that may reach ``_least``, with their rank.

    The sets are stored in blocks.  A task holds some ``part_rows`` postings of the texts it
    scans, a part for each class among them, reads the blocks one after the other and meets their
    terms with the lists of a part: neither a text nor a pair of set and text that is not among
    the k best of its part is ever shuffled.
    """
    spark = texts.sparkSession
    size = sets.agg(F.count("*").alias("n"), F.sum(F.size("_terms")).alias("t")).first()
    blocks = max(-(-size["n"] // MAX_SHARED_SETS), -(-(size["t"] or 0) // MAX_SHARED_TERMS), 1)
    path = work_path(spark, "asked-sets")
    asked = sets.select("_set", "_terms", "_least")
    asked.withColumn("_block", F.pmod(F.xxhash64("_set"), F.lit(blocks))).repartition(
        blocks, "_block"
    ).write.partitionBy("_block").parquet(path)
    schema = T.StructType([asked.schema["_set"], texts.schema[key], T.StructField("text_rank", T.DoubleType())])
    arrow_schema = _arrow_schema(schema)

    def parts(held: list[pa.RecordBatch]) -> Iterator[kernels.TermLists]:
        table = pa.Table.from_batches(held)
        numbers = table.column(3).to_numpy()
        for number in np.unique(numbers):
            keys, terms, counts = (_one_chunk(c) for c in table.filter(pa.array(numbers == number)).columns[:3])
            rows = np.repeat(np.arange(len(keys)), terms.value_lengths().to_numpy(zero_copy_only=False))
            yield kernels.TermLists(keys.take(pa.array(rows)), terms.flatten(), counts.flatten())

    def answer(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lists in parts(held):
            for block in range(blocks):
                queries = _read_block(path, block)
                if queries is None:
                    continue
                names, terms, least = (_one_chunk(queries.column(c)) for c in ("_set", "_terms", "_least"))
                for places, found, ranks in lists.best(terms, least.to_numpy(), k):
                    columns = [names.take(pa.array(places)), lists.keys.take(pa.array(found)), pa.array(ranks)]
                    yield pa.RecordBatch.from_arrays(
                        [c.cast(field.type) for c, field in zip(columns, arrow_schema)], schema=arrow_schema
                    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for start, length in _slices(batch.column(1), part_rows):
                held.append(batch.slice(start, length))
                size += pc.sum(held[-1].column(1).value_lengths()).as_py()
                if size >= part_rows:
                    yield from answer(held)
                    held, size = [], 0
        if held:
            yield from answer(held)

    return texts.select(key, "_terms", "_counts", "_class").mapInArrow(run, schema)


def _best_of_many(
    sets: DataFrame, postings: DataFrame, k: int, key: str,
    classes: int = TEXT_CLASSES, part_rows: int | None = None,
) -> DataFrame:
    """The k best texts of sets of several terms, by bounds on parts of the texts.

    After block-max indexes (Ding and Suel 2011): per term and part of the texts the greatest
    count is known, which bounds the rank of every text of the part.  Each set first meets the
    heaviest texts.  What its k-th text reaches there is the least that the others must: only
    parts, and in them texts, whose bound reaches it are looked at.

    ``postings`` has a row per text and term, or a row per text as ``_counted`` gives it.
    """
    spark = postings.sparkSession
    texts = postings if "_counts" in postings.columns else _by_text(postings, key)
    posted, part_rows = _classed(texts, key, classes), part_rows or PART_ROWS
    order = [F.desc("text_rank"), F.col(key).asc()]
    opening = sets.withColumn("_least", F.lit(0.0))
    first = write_table(
        top_per_group(_pairs(opening, posted.filter("_heavy"), key, k, part_rows), ["_set"], order, k),
        work_path(spark, "first-texts"),
    )
    reached = first.filter(F.col("position") == k).select("_set", F.col("text_rank").alias("_least"))
    rest = sets.join(reached, "_set", "left").withColumn("_least", F.coalesce("_least", F.lit(0.0)))
    both = first.drop("position").unionByName(_pairs(rest, posted.filter("NOT _heavy"), key, k, part_rows))
    return top_per_group(both, ["_set"], order, k)


def batch_hybrid_search(
    queries: DataFrame,
    corpus: DataFrame,
    vectors: DataFrame,
    k: int = 10,
    text_limit: int = 100,
    query_key: str = "query_id",
    query: str = "query",
    query_vector: str = "query_vector",
    key: str = "id",
    content: str = "content",
    vector_column: str = "embedding",
    language: str = "french",
) -> DataFrame:
    """Hybrid search of every query: text narrows to ``text_limit`` rows (k, if that is more),
    vectors re-rank, both score."""
    # The candidates are used twice, so they are stored instead of found twice.
    spark = queries.sparkSession
    text_limit = max(text_limit, k)
    hits = write_table(
        batch_text_search(
            queries, corpus, text_limit, query_key, query, key, content, language
        ).drop("position"),
        work_path(spark, "candidates"),
    )
    # The stored table has a known size, by which Spark picks the join.
    needed = vectors.select(key, vector_column).join(hits.select(key).distinct(), key, "left_semi")
    scored = (
        hits.join(needed, key, "left")
        .join(queries.select(query_key, query_vector), query_key)
        .withColumn("distance", vector.cosine_distance(F.col(vector_column), F.col(query_vector)))
        .drop(vector_column, query_vector)
    )
    order = [F.asc_nulls_last("distance"), F.col(key).asc()]
    near = top_per_group(scored, [query_key], order, k, "rank")
    fused = fuse(near.withColumn("similarity", vector.similarity(F.col("distance"))))
    final = W.partitionBy(query_key).orderBy(F.desc("final_score"), F.col(key).asc())
    return fused.withColumn("position", F.row_number().over(final))


def batch_search(
    queries: DataFrame,
    corpus: DataFrame,
    vectors: DataFrame,
    embedder: Embedder,
    k: int = 10,
    mode: str = "auto",
    query_key: str = "query_id",
    query: str = "query",
    key: str = "id",
    content: str = "content",
    vector_column: str = "embedding",
    language: str = "french",
    text_limit: int = 100,
) -> DataFrame:
    """Route every query of a table by its mode and search them all.

    Columns: query key, ``mode``, corpus key, ``position``, ``distance``,
    ``similarity``, ``text_rank`` and ``final_score``; the scores a mode does
    not have are NULL.
    """
    moded = queries.select(query_key, query).withColumn("mode", text.detect_mode(F.col(query), mode))
    names = (query_key, query, key, content)
    parts = [
        batch_text_search(moded.filter("mode = 'text'"), corpus, k, *names, language).withColumn(
            "mode", F.lit("text")
        )
    ]
    # Stored, so that no use below calls the model again.
    embedded = write_table(
        embed_with_reuse(moded.filter("mode != 'text'"), query, embedder, query_key, "query_vector"),
        work_path(queries.sparkSession, "embedded-queries"),
    )
    parts.append(
        batch_vector_search(
            embedded.filter("mode = 'vector'"), vectors, k, "cosine", query_key,
            key=key, vector_column=vector_column, keep_undefined=False,
        ).withColumn("mode", F.lit("vector"))
    )
    parts.append(
        batch_hybrid_search(
            embedded.filter("mode = 'hybrid'"), corpus, vectors, k, text_limit, query_key, query,
            "query_vector", key, content, vector_column, language,
        ).withColumn("mode", F.lit("hybrid"))
    )
    columns = [query_key, "mode", key, "position"]
    scores = ["distance", "similarity", "text_rank", "final_score"]
    result = None
    for part in parts:
        for name in scores:
            if name not in part.columns:
                part = part.withColumn(name, F.lit(None).cast("double"))
        part = part.select(*columns, *scores)
        result = part if result is None else result.unionByName(part)
    return result


def mode_summary(log: DataFrame, mode: str = "mode", ms: str = "ms", ok: str = "ok") -> DataFrame:
    """Mean time and success rate per mode of a search log.

    ``avg_ms`` divides the time of the successes by all runs; ``avg_ok_ms`` by
    the successes.
    """
    good = F.col(ok)
    return log.groupBy(mode).agg(
        F.count("*").alias("runs"),
        (F.coalesce(F.sum(F.when(good, F.col(ms))), F.lit(0)) / F.count("*")).alias("avg_ms"),
        F.avg(F.when(good, F.col(ms))).alias("avg_ok_ms"),
        (F.count_if(good) * 100.0 / F.count("*")).alias("success_pct"),
    )


def fastest_mode(summary: DataFrame, mode: str = "mode") -> DataFrame:
    """The mode with the least mean time; on a tie the later of text, vector, hybrid."""
    place = F.array_position(F.array(*[F.lit(m) for m in text.MODES]), F.col(mode))
    return summary.agg(
        F.min_by(mode, F.struct(F.col("avg_ms"), (-place).alias("place"))).alias("fastest"),
        F.min("avg_ms").alias("avg_ms"),
    )
