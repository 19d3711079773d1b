"""Exact top-k search by inner product: a Voronoi kNN join.

Candidates are grouped by their nearest pivot.  A summary per group (size, radius,
largest norm) bounds every inner product with a query.  A query is first solved in the
group nearest to it, which gives a score that the others must reach, and is then
sent only to groups whose bound reaches it.  Groups are cut into blocks by size; queries with the
same nearest pivot go together, and a block is copied only for those that are sent to it.

Scores are integers, so equal scores are ties and results do not depend on the order
of summation.  Vectors of each length are searched among themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectrail.llm.exact import LEAST, floored, matrix, norms, products
from vectrail.session import work_path
from vectrail.sources.tables import write_table

ROWS = 4096  # rows of a block, and queries that meet it together
LENGTHS = 8  # lengths of vectors that have pivots; the vectors of any other are one group
_VECTORS = "id long, v array<double>, dims int, cell int, radius double, norm double, seq long"
_FOUND = "query_id long, vec_id long, score long"


def scaled(vector: Column, factor: float = 1024.0) -> Column:
    """Components times ``factor``, rounded down; see ``exact.floored``."""
    return floored(vector, factor)


class _Groups:
    """Pivots by length of the vectors, and a summary of each group: no more than LENGTHS times the pivots."""

    def __init__(self, vectors: DataFrame, pivots: int):
        counts = vectors.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").limit(LENGTHS)
        self.centres = {}
        for row in counts.collect():
            # Rows drawn by a hash: at most ``pivots`` vectors, whatever the table.
            of_length = vectors.filter(F.col("dims") == row["dims"])
            drawn = of_length.orderBy(F.xxhash64("v"), "id").limit(pivots).select("v").collect()
            self.centres[row["dims"]] = np.unique(np.array([r["v"] for r in drawn], np.float64), axis=0)

    def placed(self, vectors: DataFrame) -> DataFrame:
        """Vectors with their group, and a number within the task."""
        known = self.centres

        def place(batches):
            seq = 0
            for batch in batches:
                dims = batch.column("dims").to_numpy()
                for d in np.unique(dims).tolist():
                    part = batch.filter(pa.array(dims == d))
                    rows = matrix(part.column("v"), d)
                    cell = np.zeros(len(rows), np.int32)
                    radius = np.zeros(len(rows))
                    if d in known:
                        centres = known[d]
                        with np.errstate(all="ignore"):
                            near = np.nan_to_num(rows @ centres.T - (centres**2).sum(1) / 2)
                        cell = near.argmax(1).astype(np.int32)
                        radius = norms(rows - centres[cell])
                    numbers = np.arange(seq, seq + len(rows))
                    seq += len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[part.column(c) for c in ("id", "v", "dims")],
                            pa.array(cell), pa.array(radius), pa.array(norms(rows)), pa.array(numbers),
                        ],
                        ["id", "v", "dims", "cell", "radius", "norm", "seq"],
                    )

        return vectors.select("id", "v", "dims").mapInArrow(place, _VECTORS)

    def measure(self, rows: DataFrame) -> None:
        known = rows.filter(F.col("dims").isin([int(d) for d in self.centres] or [-1]))
        found = known.groupBy("dims", "cell").agg(F.max("radius").alias("r"), F.max("norm").alias("norm")).collect()
        self.radius, self.norm = ({d: np.full(len(c), -1.0) for d, c in self.centres.items()} for _ in range(2))
        for row in found:
            self.radius[row["dims"]][row["cell"]] = row["r"]
            self.norm[row["dims"]][row["cell"]] = row["norm"]

    def bounds(self, rows: np.ndarray, d: int) -> np.ndarray:
        """What no score of a query with a row of a group exceeds; -inf for empty groups."""
        centres, radius, norm = self.centres[d], self.radius[d], self.norm[d]
        length = norms(rows)[:, None]
        with np.errstate(all="ignore"):
            around = rows @ centres.T + length * radius
            room = 1 + 1e-9 * length * (norms(centres) + radius + norm)
            bound = np.minimum(np.nan_to_num(around, nan=np.inf, posinf=np.inf), length * norm) + room
        return np.where(norm >= 0, np.nan_to_num(bound, nan=np.inf, posinf=np.inf), -np.inf)


def top_k(
    queries: DataFrame,
    candidates: DataFrame,
    k: int = 10,
    pivots: int = 128,
    id_column: str = "vec_id",
    vector_column: str = "vector",
) -> DataFrame:
    """The ``k`` best candidates of every query: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Vectors hold whole numbers that a double can hold (see ``scaled``).  The score is the inner product,
    exact, and the nearest long where it does not fit one.  A query never finds rows with its own
    id.  Ties go to the smaller id; a query with fewer candidates gets all.  Rows with a NULL id or
    vector, or an empty one, take no part; vectors of different lengths have no score.
    Repeated candidate rows are found each; of repeated query ids the smallest vector is
    asked.  Empty tables give no rows.  Other columns are not looked at.
    """
    spark = candidates.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        return df.select(
            F.col(f"`{id_column}`").cast("long").alias("id"),
            F.col(f"`{vector_column}`").cast("array<double>").alias("v"),
            F.size(f"`{vector_column}`").alias("dims"),
        ).filter("id IS NOT NULL AND v IS NOT NULL AND dims > 0")

    groups = _Groups(usable(candidates), pivots)
    rows = write_table(groups.placed(usable(candidates)), work_path(spark, "topk-cells"))
    groups.measure(rows)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = rows.count()
    block = int(min(ROWS, max(32, n // (4 * tasks))))
    sizes = rows.groupBy("dims", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    sizes = write_table(sizes, work_path(spark, "topk-sizes"))
    # Rows are dealt to blocks by the number that their task gave them, so blocks are even.
    blocks = rows.join(sizes, ["dims", "cell"]).select(
        "id", "v", "dims", "cell", F.pmod(F.col("seq"), F.col("parts")).cast("int").alias("part")
    )
    single = usable(queries).groupBy("id").agg(F.min(F.struct("v", "dims")).alias("x")).select("id", "x.*")
    asked = write_table(groups.placed(single), work_path(spark, "topk-asked"))
    packs = asked.groupBy("dims", "cell").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("packs"))
    asked = asked.join(packs, ["dims", "cell"]).select(
        F.col("id").alias("q"), F.col("v").alias("qv"), "dims",
        (F.col("cell") * 1_000_000 + F.pmod(F.xxhash64("id"), F.col("packs"))).cast("long").alias("pack"),
        F.lit(LEAST).alias("least"),
    )

    def routes(first: bool):
        def run(batches):
            for batch in batches:
                dims = batch.column("dims").to_numpy()
                for d in np.unique(dims).tolist():
                    part = batch.filter(pa.array(dims == d))
                    if d not in groups.centres:  # one group, all of it at home
                        send = np.full((part.num_rows, 1), first)
                    else:
                        bound = groups.bounds(matrix(part.column("qv"), d), d)
                        home = np.zeros(bound.shape, bool)
                        home[np.arange(len(bound)), bound.argmax(1)] = True
                        least = part.column("least").to_numpy().astype(np.float64)
                        least = np.where(least < -(2.0**62), -np.inf, least)  # anything will do
                        send = home if first else ~home & (bound >= least[:, None])
                        send &= bound > -np.inf
                    row, cell = np.nonzero(send)
                    for at in range(0, len(row), 2000):
                        taken = part.take(pa.array(row[at : at + 2000]))
                        to = pa.array(cell[at : at + 2000].astype(np.int32))
                        yield pa.RecordBatch.from_arrays([*taken.columns, to], [*taken.schema.names, "cell"])

        return run

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64),) * 3]
        if left.num_rows and right.num_rows:
            d = left.column("dims")[0].as_py()
            ids = left.column("id").to_numpy()
            score = products(matrix(right.column("q_qv"), d), matrix(left.column("v"), d))
            asks, least = right.column("q_q").to_numpy(), right.column("q_least").to_numpy()
            for i, q in enumerate(asks):
                good = np.flatnonzero((score[i] >= least[i]) & (ids != q))
                if len(good) > k:
                    edge = np.partition(score[i][good], len(good) - k)[len(good) - k]
                    good = good[score[i][good] >= edge]
                good = good[np.lexsort((ids[good], ~score[i][good]))][:k]
                out.append((np.full(len(good), q), ids[good], score[i][good]))
        columns = [np.concatenate(c).astype(np.int64) for c in zip(*out)]
        return pa.table([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    keys = ["dims", "cell", "part", "pack"]

    def solved(routed: DataFrame) -> DataFrame:
        spread = routed.join(sizes, ["dims", "cell"]).select(
            *[F.col(c).alias(f"q_{c}") for c in ("q", "qv", "least")], "dims", "cell",
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "pack",
        )
        asks = write_table(spread, work_path(spark, "topk-asks"))
        # A block is copied for the packs of queries that were sent to it, and no others.
        wanted = asks.select(*[F.col(c).alias(f"w_{c}") for c in keys]).distinct()
        same = [F.col(c) == F.col(f"w_{c}") for c in keys[:3]]
        met = blocks.join(wanted, same).select(*blocks.columns, F.col("w_pack").alias("pack"))
        return met.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(solve, _FOUND)

    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    routed = "q long, qv array<double>, dims int, pack long, least long, cell int"
    asked = write_table(asked, work_path(spark, "topk-packs"))
    at_home = write_table(best(solved(asked.mapInArrow(routes(True), routed))), work_path(spark, "topk-home"))
    reached = at_home.filter(F.col("rank") == k).select(F.col("query_id").alias("q"), F.col("score").alias("reached"))
    rest = asked.join(reached, "q", "left").select(
        "q", "qv", "dims", "pack", F.coalesce("reached", "least").alias("least")
    )
    elsewhere = solved(rest.mapInArrow(routes(False), routed))
    found = at_home.select("query_id", "vec_id", "score").unionByName(elsewhere)
    return best(found).select("query_id", "rank", "vec_id", "score")
