"""Approximate search: an inverted file of lists around centres.

The vectors are stored once, split by list; a search reads only the lists
nearest to the query, through partition pruning.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectrail.functions import kernels, vector
from vectrail.operators.search import vector_search
from vectrail.operators.skew import top_per_group
from vectrail.session import work_path
from vectrail.sources.tables import write_table

# Every task holds the centres; more than this is refused, not cut.
MAX_CENTRE_BYTES = 256 * 1024 * 1024


def _point(v: Column, metric: str) -> Column:
    """What lists are built on: directions for cosine, the vector itself otherwise."""
    return vector.normalise(v, "l2", None) if metric == "cosine" else v.cast("array<double>")


def learn_centres(
    df: DataFrame,
    lists: int = 100,
    metric: str = "cosine",
    vector_column: str = "embedding",
    seed: int = 42,
) -> DataFrame:
    """``list_id`` and ``centre``, by k-means over all rows of ``df``.

    To learn from a part of a table, pass that part.  Rows without a direction or vector
    are not used, nor are vectors of another than the most frequent length.
    """
    spark = df.sparkSession
    point = F.col("_point")
    points = df.select(_point(F.col(vector_column), metric).alias("_point")).filter(
        point.isNotNull() & (F.size(point) > 0)
    )
    # Stored, because k-means reads its input many times.
    points = write_table(points, work_path(spark, "points"))
    most = points.groupBy(F.size("_point").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if most is None:
        raise ValueError("there are no vectors to learn from")
    features = points.filter(F.size(point) == most["d"]).select(array_to_vector(point).alias("_features"))
    model = KMeans(k=lists, seed=seed, maxIter=10, featuresCol="_features").fit(features)
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(centres, "list_id int, centre array<double>")


def ivf_build(
    df: DataFrame,
    path: str,
    centres: DataFrame,
    metric: str = "cosine",
    key: str = "id",
    vector_column: str = "embedding",
    rows_per_file: int = 1_000_000,
) -> int:
    """Store ``df`` under ``path`` by nearest centre; how many rows could not be stored.

    Every vector of the centres' length that has a direction is stored; ties go to the
    smaller ``list_id``.  A list with more than ``rows_per_file`` rows is spread over
    several tasks and files.
    """
    if centres.toArrow().nbytes > MAX_CENTRE_BYTES:
        raise ValueError("the centres do not fit into a task; use fewer lists")
    centres.write.parquet(f"{path}/centres")
    return ivf_append(df, path, metric, key, vector_column, rows_per_file)


def ivf_append(
    df: DataFrame,
    path: str,
    metric: str = "cosine",
    key: str = "id",
    vector_column: str = "embedding",
    rows_per_file: int = 1_000_000,
) -> int:
    """Add rows to the lists stored under ``path``; how many could not be stored.

    The centres stay as they are, and no stored file is read or written again.  How far the
    new rows lie from their centres is noted beside what is known of the older ones.
    """
    spark = df.sparkSession
    names, matrix = _centres(spark, path)
    width = matrix.shape[1]

    def nearest(points: pa.Array) -> list[pa.Array]:
        rows, valid = kernels.matrix(points, width)
        valid &= np.isfinite(rows).all(axis=1)
        rows = np.nan_to_num(rows)
        if metric == "cosine":
            score = rows @ (matrix / np.linalg.norm(matrix, axis=1, keepdims=True)).T
        elif metric == "inner_product":
            score = rows @ matrix.T
        else:
            score = rows @ matrix.T - (matrix**2).sum(axis=1) / 2
        at = np.round(score, 12).argmax(axis=1)
        away = np.linalg.norm(rows - matrix[at], axis=1)
        return [
            pa.array(names[at], pa.int32(), mask=~valid),
            pa.array(away, mask=~valid),
            pa.array(np.linalg.norm(rows, axis=1), mask=~valid),
        ]

    def assign(batches):
        for batch in batches:
            columns = [*batch.columns[:-1], *nearest(batch.columns[-1])]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "list_id", "_away", "_norm"])

    more = [T.StructField("list_id", T.IntegerType()), *[T.StructField(n, T.DoubleType()) for n in ("_away", "_norm")]]
    listed = df.withColumn("_point", _point(F.col(vector_column), metric)).mapInArrow(
        assign, T.StructType([*df.schema.fields, *more])
    )
    # One row per list.
    known = listed.groupBy("list_id").agg(
        F.count("*").alias("n"), F.max("_away").alias("radius"), F.max("_norm").alias("norm")
    )
    counted = write_table(known, work_path(spark, "lists"))
    files = counted.filter("list_id IS NOT NULL").select(
        "list_id", F.ceil(F.col("n") / rows_per_file).cast("int").alias("_files")
    )
    file = F.pmod(F.xxhash64(key), F.col("_files"))
    (
        listed.join(F.broadcast(files), "list_id")
        .withColumn("_file", file)
        .repartition("list_id", "_file")
        .drop("_files", "_file", "_away", "_norm")
        .write.mode("append")
        .partitionBy("list_id")
        .parquet(f"{path}/lists")
    )
    counted.filter("list_id IS NOT NULL").write.mode("append").parquet(f"{path}/known")
    lost = counted.filter("list_id IS NULL").first()
    return lost["n"] if lost else 0


def _centres(spark: SparkSession, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Names and centres of the lists, at most MAX_CENTRE_BYTES."""
    table = spark.read.parquet(f"{path}/centres").orderBy("list_id").toArrow()
    return (
        np.array(table.column("list_id").to_pylist(), np.int32),
        np.array(table.column("centre").to_pylist(), np.float64),
    )


class _Lists:
    """What a search has to know of the stored lists: centres, radii, norms.  A row per list."""

    def __init__(self, spark: SparkSession, path: str, metric: str):
        self.metric = metric
        self.names, self.matrix = _centres(spark, path)
        rows = spark.read.parquet(f"{path}/known").groupBy("list_id").agg(
            F.sum("n").alias("n"), F.max("radius").alias("radius"), F.max("norm").alias("norm")
        ).collect()
        place = {name: i for i, name in enumerate(self.names.tolist())}
        self.n, self.radius, self.norm = (np.zeros(len(place)) for _ in range(3))
        for row in rows:
            i = place[row["list_id"]]
            self.n[i], self.radius[i], self.norm[i] = row["n"], row["radius"], row["norm"]

    def distances(self, queries: np.ndarray) -> np.ndarray:
        """From each query to each centre; lists without rows, and centres without a distance, are infinitely far."""
        with np.errstate(invalid="ignore", divide="ignore"):
            far = kernels.distances(self.matrix, queries, self.metric)
        return np.where((self.n > 0) & ~np.isnan(far), far, np.inf)

    def least(self, queries: np.ndarray) -> np.ndarray:
        """What the distance from each query to the rows of each list is at least.

        By the triangle inequality around the centre; a cosine distance is half the square of the
        way between two directions.
        """
        size = np.linalg.norm(queries, axis=1, keepdims=True)
        if self.metric == "inner_product":
            most = np.minimum(queries @ self.matrix.T + size * self.radius, size * self.norm)
            found = -most
        else:
            rows = queries / np.where(size > 0, size, 1) if self.metric == "cosine" else queries
            away = np.stack([np.linalg.norm(self.matrix - q, axis=1) for q in rows]) if len(rows) else np.zeros((0, len(self.n)))
            gap = np.maximum(away - self.radius, 0)
            found = gap**2 / 2 if self.metric == "cosine" else gap
        return np.where(self.n > 0, found - 1e-9 * (1 + np.abs(found)), np.inf)


def batch_ivf_search(
    queries: DataFrame,
    path: str,
    k: int = 5,
    probes: int = 10,
    max_probes: int | None = None,
    metric: str = "cosine",
    query_key: str = "query_id",
    query_vector: str = "query_vector",
    key: str = "id",
    vector_column: str = "embedding",
    rows_per_task: int = 100_000,
) -> DataFrame:
    """The k nearest rows of every query in the stored lists.

    Columns as of ``batch_vector_search``.  The ``probes`` lists with the nearest centres are read
    first.  Then the others whose rows may, by the radius of the list, be nearer than the k-th
    found so far: all of them, which makes the answer exact, or the most promising up to
    ``max_probes`` lists in all.  Queries of another length or without a direction find nothing.
    """
    spark = queries.sparkSession
    lists = _Lists(spark, path, metric)
    width = lists.matrix.shape[1]
    limit = len(lists.names) if max_probes is None else max_probes
    row_key = spark.read.parquet(f"{path}/lists").schema[key]
    asked = queries.select(
        F.col(query_key).alias("_q"), F.col(query_vector).cast("array<double>").alias("_v")
    ).filter((F.size("_v") == width) & F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x)))
    if metric == "cosine":
        asked = asked.filter(F.exists("_v", lambda x: x != 0))
    asked = write_table(asked, work_path(spark, "asked"))

    def route(opening: bool):
        def run(batches):
            for batch in batches:
                rows = kernels.matrix(batch.column(1), width)[0]
                order = np.argsort(lists.distances(rows), axis=1, kind="stable")
                place = np.empty_like(order)
                np.put_along_axis(place, order, np.arange(order.shape[1])[None, :], axis=1)
                first = (place < probes) & (lists.n > 0)
                if opening:
                    send = first
                else:
                    reached = batch.column(2).to_numpy(zero_copy_only=False).astype(np.float64)
                    least = np.where(first, np.inf, lists.least(rows))
                    promise = np.argsort(np.argsort(least, axis=1, kind="stable"), axis=1, kind="stable")
                    send = (least <= np.where(np.isnan(reached), np.inf, reached)[:, None]) & np.isfinite(least)
                    send &= promise < max(0, limit - probes)
                row, at = np.nonzero(send)
                for start in range(0, len(row), 2000):
                    taken = batch.take(pa.array(row[start : start + 2000]))
                    to = pa.array(lists.names[at[start : start + 2000]], pa.int32())
                    yield pa.RecordBatch.from_arrays([taken.column(0), taken.column(1), to], ["_q", "_v", "list_id"])

        return run

    stored = spark.read.parquet(f"{path}/lists").select(F.col(key).alias("_id"), F.col(vector_column).alias("_e"), "list_id")
    parts = {int(name): int(max(1, -(-n // rows_per_task))) for name, n in zip(lists.names, lists.n)}
    count = F.element_at(F.create_map(*[F.lit(x) for pair in parts.items() for x in pair]), F.col("list_id"))
    spread = stored.withColumn("_part", F.pmod(F.xxhash64("_id"), count.cast("long")))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        found, valid = kernels.matrix(left.column("_e").combine_chunks(), width)
        names = right.column("_q").to_pylist()
        nearest = kernels.Nearest(kernels.matrix(right.column("_v").combine_chunks(), width)[0], k, metric)
        ids = left.column("_id")
        ids = ids.to_numpy() if pa.types.is_integer(ids.type) and not ids.null_count else np.asarray(ids.to_pylist())
        nearest.add(ids[valid], found[valid])
        triples = [(names[i], row.item(), d) for i, row, d in nearest.rows()]
        columns = list(zip(*triples)) if triples else [[], [], []]
        types = [right.schema.field("_q").type, left.schema.field("_id").type, pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], ["_q", "_id", "distance"])

    kinds = f"_q {asked.schema['_q'].dataType.simpleString()}, _v array<double>, list_id int"
    result = f"_q {asked.schema['_q'].dataType.simpleString()}, _id {row_key.dataType.simpleString()}, distance double"
    order = [F.col("distance").asc(), F.col("_id").asc()]

    def searched(routed: DataFrame) -> DataFrame:
        routed = routed.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)))
        met = spread.groupBy("list_id", "_part").cogroup(routed.groupBy("list_id", "_part")).applyInArrow(solve, result)
        return top_per_group(met, ["_q"], order, k)

    first = write_table(searched(asked.mapInArrow(route(True), kinds)), work_path(spark, "probed"))
    found = first.drop("position")
    if limit > probes:
        reached = first.filter(F.col("position") == k).select("_q", F.col("distance").alias("_reached"))
        rest = asked.join(reached, "_q", "left").select("_q", "_v", "_reached")
        found = found.unionByName(searched(rest.mapInArrow(route(False), kinds)).drop("position"))
    return top_per_group(found, ["_q"], order, k).select(
        F.col("_q").alias(query_key), F.col("_id").alias(key), "distance",
        vector.similarity(F.col("distance")).alias("similarity"), "position",
    )


def nearest_lists(
    spark: SparkSession, path: str, query: Sequence[float], probes: int, metric: str = "cosine"
) -> list[int]:
    """The lists whose centre is nearest to the query, by the metric of the search."""
    near = vector_search(
        spark.read.parquet(f"{path}/centres"), query, probes, metric, "centre", "list_id", keep_undefined=False
    )
    return [row["list_id"] for row in near.select("list_id").collect()]


def ivf_search(
    spark: SparkSession,
    path: str,
    query: Sequence[float],
    k: int = 5,
    probes: int = 10,
    metric: str = "cosine",
    key: str = "id",
    vector_column: str = "embedding",
    bounded: bool = False,
    **options,
) -> DataFrame:
    """The k nearest rows among the ``probes`` nearest lists.

    With ``bounded`` the search goes on to every list that may, by its radius, hold a nearer
    row than the k-th found, so the answer is that of an exact search.
    """
    lists = nearest_lists(spark, path, query, probes, metric)
    rows = spark.read.parquet(f"{path}/lists")

    def among(chosen: Sequence[int]) -> DataFrame:
        return vector_search(rows.filter(F.col("list_id").isin(list(chosen))), query, k, metric, vector_column, key, **options)

    found = among(lists)
    if not bounded:
        return found
    reached = [r["distance"] for r in found.select("distance").collect() if r["distance"] is not None]  # k rows
    known = _Lists(spark, path, metric)
    least = known.least(np.array([[float(x) for x in query]]))[0]
    edge = max(reached) if len(reached) == k else np.inf
    return among([*lists, *known.names[(least <= edge) & (known.n > 0)].tolist()])


def mean_recall(
    exact: DataFrame, approximate: DataFrame, query_key: str = "query_id", key: str = "id"
) -> DataFrame:
    """Over all queries of the exact result: their number, its rows, and the mean share found of each."""
    hit = approximate.select(query_key, key).withColumn("_hit", F.lit(1))
    per_query = exact.select(query_key, key).join(hit, [query_key, key], "left").groupBy(query_key).agg(
        F.count("*").alias("n"), (F.count("_hit") / F.count("*")).alias("share")
    )
    return per_query.agg(
        F.count("*").alias("n_queries"), F.sum("n").alias("n_exact"), F.avg("share").alias("recall")
    )


def recall(exact: DataFrame, approximate: DataFrame, key: str = "id") -> DataFrame:
    """Share of the exact result that the approximate one found."""
    hit = approximate.select(key).withColumn("_hit", F.lit(1))
    return exact.select(key).join(hit, key, "left").agg(
        F.count("*").alias("n_exact"),
        F.count("_hit").alias("n_found"),
        F.try_divide(F.count("_hit"), F.count("*")).alias("recall"),
    )
