"""Hard negatives: rows of another label that score nearly as high as a positive.

The angles of every vector to some reference directions are stored.  By the triangle inequality,
the angle between an anchor and a row lies between the difference and the sum of their angles
to any direction.  That is an interval of cosines; times both norms it bounds the score, with room
for rounding.  Rows are grouped by their nearest direction; the ranges of angles of a group
bound the scores of all of it, and an anchor is sent only to groups whose interval overlaps the
scores it looks for.  There the rows stand in the order of their angle to the
group's direction, so those that can score so are one stretch, and only that is multiplied out, in
whole numbers.

The positives come first; their scores give the windows for the negatives.  Both are sought in
the nearest groups first: what is found there narrows the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectrail.llm.exact import LEAST, MOST, matrix, norms, products
from vectrail.session import work_path
from vectrail.sources.tables import write_table

ROWS = 4096  # rows of a block
ANCHORS = 1024  # anchors that meet a block together
LENGTHS = 8  # lengths of vectors that have reference directions; others are one cell each
SLACK = 1e-6  # radians: stored angles are floats
_VECTORS = (
    "id long, label string, v array<double>, dims int, bucket int, cell int, norm double, angle double, "
    "angles array<float>, seq long"
)
_BLOCK = ["dims", "bucket", "cell", "part"]


def _angles(rows: np.ndarray, lengths: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Angles of rows to unit directions; a zero vector is at right angles to all."""
    with np.errstate(invalid="ignore", divide="ignore"):
        cosines = np.nan_to_num((rows / lengths[:, None]) @ directions.T)
    return np.arccos(np.clip(cosines, -1, 1))


def _bounds(alpha, length, low, high, least_norm, most_norm):
    """Lowest and highest scores of an anchor with rows at angles from ``low`` to ``high`` to directions.

    The last axis of ``alpha``, ``low`` and ``high`` runs over the directions.
    """
    nearest = np.maximum(np.maximum(alpha - high, low - alpha).max(-1) - SLACK, 0)
    furthest = np.minimum(np.minimum(alpha + high, 2 * np.pi - alpha - low).min(-1) + SLACK, np.pi)
    top, bottom = np.cos(np.minimum(nearest, np.pi)), np.cos(np.maximum(furthest, nearest))
    most = length * np.where(top > 0, top * most_norm, top * least_norm)
    least = length * np.where(bottom > 0, bottom * least_norm, bottom * most_norm)
    room = 1 + 1e-9 * length * most_norm
    return least - room, most + room


class _Layout:
    """Reference directions and sizes, found once per call; small enough for every task."""

    def __init__(self, vectors: DataFrame, directions: int):
        counts = vectors.groupBy("dims").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dims").limit(LENGTHS).collect()
        n = sum(r["n"] for r in counts)
        groups = max(1, n // (ROWS // 2))
        self.buckets = int(min(32, max(1, groups // 4)))
        self.cells = int(min(directions, max(1, groups // self.buckets)))
        self.directions = {}
        for row in counts:
            of_length = vectors.filter(F.col("dims") == row["dims"])
            drawn = of_length.orderBy(F.xxhash64("v"), "id").limit(directions).select("v").collect()
            units = np.array([r["v"] for r in drawn], np.float64)
            sizes = norms(units)
            units = np.unique(units[sizes > 0] / sizes[sizes > 0, None], axis=0)
            if len(units):
                self.directions[row["dims"]] = np.random.default_rng(0).permutation(units)
        # Groups of fewer directions than ``directions`` (equal or few vectors) have empty places.
        self.width = directions

    def placed(self, vectors: DataFrame) -> DataFrame:
        """Vectors with their bucket of labels, cell, norm and angles."""
        known, cells, width = self.directions, self.cells, self.width

        def place(batches):
            seq = 0
            for batch in batches:
                dims = batch.column("dims").to_numpy()
                for d in np.unique(dims):
                    part = batch.filter(pa.array(dims == d))
                    rows = matrix(part.column("v"), int(d))
                    size = norms(rows)
                    angles = np.full((len(rows), width), np.pi / 2, np.float32)
                    cell = np.zeros(len(rows), np.int32)
                    own = np.zeros(len(rows))
                    if int(d) in known:
                        exact = _angles(rows, size, known[int(d)])
                        angles[:, : exact.shape[1]] = exact
                        cell = exact[:, :cells].argmin(1).astype(np.int32)
                        own = exact[np.arange(len(rows)), cell]
                    flat = pa.ListArray.from_arrays(
                        pa.array(np.arange(0, angles.size + 1, width, dtype=np.int32)), pa.array(angles.ravel())
                    )
                    numbers = np.arange(seq, seq + len(rows))
                    seq += len(rows)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[part.column(c) for c in ("id", "label", "v", "dims", "bucket")],
                            pa.array(cell), pa.array(np.minimum(size, 1e150)), pa.array(own), flat, pa.array(numbers),
                        ],
                        ["id", "label", "v", "dims", "bucket", "cell", "norm", "angle", "angles", "seq"],
                    )

        bucket = F.pmod(F.xxhash64("label"), F.lit(self.buckets)).cast("int")
        return vectors.select("id", "label", "v", "dims", bucket.alias("bucket")).mapInArrow(place, _VECTORS)

    def measure(self, rows: DataFrame) -> None:
        """Ranges of angles and norms per group of the lengths with directions."""
        known = rows.filter(F.col("dims").isin([int(d) for d in self.directions] or [-1]))
        ranges = [f(F.col("angles")[j]).alias(f"{f.__name__}{j}") for f in (F.min, F.max) for j in range(self.width)]
        found = known.groupBy("dims", "bucket", "cell").agg(
            F.count("*").alias("n"), F.min("norm").alias("least"), F.max("norm").alias("most"), *ranges
        ).collect()  # at most LENGTHS * buckets * cells rows
        self.groups = {}
        for d in self.directions:
            mine = [r for r in found if r["dims"] == d]
            self.groups[d] = {
                "bucket": np.array([r["bucket"] for r in mine], np.int32),
                "cell": np.array([r["cell"] for r in mine], np.int32),
                "least": np.array([r["least"] for r in mine]),
                "most": np.array([r["most"] for r in mine]),
                "low": np.array([[r[f"min{j}"] for j in range(self.width)] for r in mine], np.float64).reshape(-1, self.width),
                "high": np.array([[r[f"max{j}"] for j in range(self.width)] for r in mine], np.float64).reshape(-1, self.width),
            }


def _routes(layout: _Layout, asked: DataFrame, same_label: bool, opening: bool) -> DataFrame:
    """The groups that each anchor must meet: ``asked`` with ``to_bucket`` and ``to_cell``.

    An anchor looks for scores from ``floor`` to ``ceiling``.  ``opening`` takes the most promising
    cell of each bucket, without it all others whose scores may lie there.
    """
    groups, buckets = layout.groups, layout.buckets
    names = [*asked.columns, "to_bucket", "to_cell"]

    def run(batches):
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                own = part.column("bucket").to_numpy()
                if int(d) not in groups:  # one cell: all of it is the opening
                    if not opening:
                        continue
                    bucket, cell = np.arange(buckets, dtype=np.int32), np.zeros(buckets, np.int32)
                    send = np.ones((part.num_rows, buckets), bool)
                else:
                    g = groups[int(d)]
                    bucket, cell = g["bucket"], g["cell"]
                    width = g["low"].shape[1]
                    alpha = matrix(part.column("angles"), width)
                    length = part.column("norm").to_numpy()
                    floor = part.column("floor").to_numpy().astype(np.float64)
                    ceiling = part.column("ceiling").to_numpy().astype(np.float64)
                    ceiling = np.where(ceiling > 2.0**62, np.inf, ceiling)  # saturated scores
                    floor = np.where(floor < -(2.0**62), -np.inf, floor)
                    send = np.zeros((part.num_rows, len(bucket)), bool)
                    for i in range(part.num_rows):
                        least, most = _bounds(alpha[i], length[i], g["low"], g["high"], g["least"], g["most"])
                        first = np.zeros(len(bucket), bool)
                        order = np.lexsort((-most, bucket))
                        first[order[np.unique(bucket[order], return_index=True)[1]]] = True
                        send[i] = (first if opening else ~first) & (most >= floor[i]) & (least <= ceiling[i])
                if same_label:
                    send &= bucket == own[:, None]
                row, at = np.nonzero(send)
                for start in range(0, len(row), 2000):  # an anchor may go to many groups
                    taken = part.take(pa.array(row[start : start + 2000]))
                    to = at[start : start + 2000]
                    yield pa.RecordBatch.from_arrays(
                        [*taken.columns, pa.array(bucket[to], pa.int32()), pa.array(cell[to], pa.int32())], names
                    )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema.fields)
    return asked.mapInArrow(run, f"{fields}, to_bucket int, to_cell int")


def _stretch(angle, alpha, length, floor, ceiling, least_norm, most_norm):
    """Where, in rows sorted by ``angle``, scores between ``floor`` and ``ceiling`` may lie, per anchor."""
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.where(length * most_norm > 0, (floor * (1 - 1e-9) - 1) / (length * most_norm), np.where(floor > 1, 2.0, -1.0))
        down = np.where(length * least_norm > 0, (ceiling * (1 + 1e-9) + 1) / (length * least_norm), 1.0)
    # A floor that is not positive is reached at any angle that the norms allow.
    reach = np.where(up > 1 + 1e-9, -1.0, np.where(up <= 0, np.pi, np.arccos(np.clip(up, -1, 1)) + 2 * SLACK))
    nearest = np.where((down >= 1) | (down < 0), 0.0, np.arccos(np.clip(down, 0, 1)) - 2 * SLACK)
    start = np.searchsorted(angle, np.maximum(alpha - reach, nearest - alpha), "left")
    end = np.searchsorted(angle, np.where(reach < 0, -1.0, alpha + reach), "right")
    return start, np.maximum(start, end)


def _met(routed: DataFrame, blocks: DataFrame, groups: DataFrame, solve, schema: str) -> DataFrame:
    """Anchors and the blocks they are sent to, together: each block is copied once per pack that needs it."""
    spread = routed.join(groups, ["dims", "to_bucket", "to_cell"]).select(
        *routed.columns, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    )
    asks = spread.select(
        *[F.col(c).alias(f"q_{c}") for c in routed.columns if c not in ("dims", "to_bucket", "to_cell", "pack")],
        "dims", F.col("to_bucket").alias("bucket"), F.col("to_cell").alias("cell"), "part", "pack",
    )
    asks = write_table(asks, work_path(routed.sparkSession, "negatives-asks"))
    keys = [*_BLOCK, "pack"]
    wanted = asks.select(*[F.col(c).alias(f"w_{c}") for c in keys]).distinct()
    same = [F.col(c) == F.col(f"w_{c}") for c in _BLOCK]
    met = blocks.join(wanted, same).select(*blocks.columns, F.col("w_pack").alias("pack"))
    return met.groupBy(*keys).cogroup(asks.groupBy(*keys)).applyInArrow(solve, schema)


def _group(left: pa.Table, right: pa.Table):
    """Rows of a block in the order of their angle, and the anchors."""
    dims = left.column("dims")[0].as_py()
    angle = left.column("angle").to_numpy()
    order = np.argsort(angle, kind="stable")
    left = left.take(pa.array(order))
    norm = left.column("norm").to_numpy()
    rows = matrix(left.column("v"), dims)
    # The direction is that of the block's cell, at its place among the stored angles.
    cell = left.column("cell")[0].as_py()
    q_angles = right.column("q_angles").combine_chunks()
    width = len(q_angles[0]) if len(q_angles) else 1
    alpha = matrix(q_angles, width)[:, cell].astype(np.float64)
    return dims, angle[order], norm, left.column("id").to_numpy(), left.column("label").to_numpy(), rows, alpha


def _scored(left: pa.Table, right: pa.Table, floor, ceiling, directed: bool):
    """For every anchor: its number, and ids, labels and scores of the stretch that may count."""
    dims, angle, norm, ids, labels, rows, alpha = _group(left, right)
    length = right.column("q_norm").to_numpy()
    if directed:
        start, end = _stretch(angle, alpha, length, floor, ceiling, norm.min(), norm.max())
    else:
        start, end = np.zeros(len(alpha), np.int64), np.full(len(alpha), len(angle))
    anchors = matrix(right.column("q_v"), dims)
    order = np.argsort(start, kind="stable")
    for at in range(0, len(order), 64):  # anchors with like stretches are multiplied together
        some = order[at : at + 64]
        low, high = start[some].min(), end[some].max()
        if high <= low:
            continue
        scores = products(anchors[some], rows[low:high])
        for i, score in zip(some, scores):
            cut = slice(start[i] - low, end[i] - low)
            own = slice(start[i], end[i])
            yield i, ids[own], labels[own], score[cut]


def _table(parts: list, names: Sequence[str], types: Sequence) -> pa.Table:
    columns = list(zip(*parts)) if parts else [[] for _ in names]
    return pa.table([pa.array(np.concatenate(c) if len(c) else [], t) for c, t in zip(columns, types)], list(names))


def hard_negatives(
    anchors: DataFrame,
    candidates: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    directions: int = 32,
    id_column: str = "vec_id",
    vector_column: str = "vector",
    label_column: str = "label",
) -> DataFrame:
    """For each anchor and positive the best negatives within a window of scores.

    An anchor's positives are its ``positives`` highest-scoring other candidates with its label.  The
    negatives of a positive are the ``negatives`` highest-scoring candidates of other labels with
    ``low_percent * positive_score <= 100 * negative_score <= high_percent * positive_score``.
    Ties go to the smaller id.  Fewer are given where there are fewer.

    Vectors are array<double> of whole numbers (see ``exact.floored``); the score is the inner product,
    exact, and the nearest long where it does not fit one.  Vectors of different lengths have no score.

    Returns ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``.  Rows with a NULL id, label or vector, or an empty vector, take no part.
    Repeated candidates count each; of anchors with the same id the one with the smallest
    label and vector is asked.  Empty tables give no rows.  Other columns are not looked at.
    """
    spark = candidates.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        return df.select(
            F.col(f"`{id_column}`").cast("long").alias("id"),
            F.col(f"`{label_column}`").cast("string").alias("label"),
            F.col(f"`{vector_column}`").alias("v"),
            F.size(f"`{vector_column}`").alias("dims"),
        ).filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND dims > 0")

    layout = _Layout(usable(candidates), directions)
    rows = write_table(layout.placed(usable(candidates)), work_path(spark, "negatives-rows"))
    layout.measure(rows)
    # Blocks of even size: rows of a group are numbered within the task that placed them.
    sizes = rows.groupBy("dims", "bucket", "cell").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("parts"))
    blocks = rows.join(sizes, ["dims", "bucket", "cell"]).select(
        "id", "label", "v", "norm", "angle", "dims", "bucket", "cell",
        F.pmod(F.col("seq"), F.col("parts")).cast("int").alias("part"),
    )
    groups = sizes.select("dims", F.col("bucket").alias("to_bucket"), F.col("cell").alias("to_cell"), "parts")

    single = usable(anchors).groupBy("id").agg(F.min(F.struct("label", "v", "dims")).alias("x")).select("id", "x.*")
    asked = write_table(layout.placed(single), work_path(spark, "negatives-anchors"))
    packs = asked.groupBy("dims", "cell").agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("packs"))
    asked = asked.join(packs, ["dims", "cell"]).select(
        "id", "label", "v", "dims", "bucket", "norm", "angles",
        (F.col("cell") * 1_000_000 + F.pmod(F.xxhash64("id"), F.col("packs"))).cast("long").alias("pack"),
    )
    known = set(layout.directions)

    # ------------------------------------------------------------ positives
    best_first = W.partitionBy("anchor_id").orderBy(F.desc("score"), "positive_id")

    def top_positives(left, right):
        out = []
        if left.num_rows and right.num_rows:
            floor = right.column("q_floor").to_numpy().astype(np.float64)
            floor = np.where(floor < -(2.0**62), -np.inf, floor)
            wanted = right.column("q_floor").to_numpy()
            asks, own = right.column("q_id").to_numpy(), right.column("q_label").to_numpy()
            dims = left.column("dims")[0].as_py()
            for i, ids, labels, score in _scored(left, right, floor, np.full(len(floor), np.inf), dims in known):
                good = np.flatnonzero((labels == own[i]) & (ids != asks[i]) & (score >= wanted[i]))
                good = good[np.lexsort((ids[good], ~score[good]))][:positives]
                out.append((np.full(len(good), asks[i]), ids[good], score[good]))
        return _table(out, ["anchor_id", "positive_id", "score"], [pa.int64()] * 3)

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("place", F.row_number().over(best_first)).filter(F.col("place") <= positives)

    found_schema = "anchor_id long, positive_id long, score long"
    opening = asked.withColumn("floor", F.lit(LEAST)).withColumn("ceiling", F.lit(MOST))
    at_home = _met(_routes(layout, opening, True, True), blocks, groups, top_positives, found_schema)
    at_home = write_table(ranked(at_home), work_path(spark, "positives-home"))
    reached = at_home.filter(F.col("place") == positives).select(F.col("anchor_id").alias("id"), F.col("score").alias("least"))
    rest = opening.join(reached, "id", "left").withColumn("floor", F.coalesce("least", "floor")).drop("least")
    elsewhere = _met(_routes(layout, rest, True, False), blocks, groups, top_positives, found_schema)
    found = ranked(at_home.select("anchor_id", "positive_id", "score").unionByName(elsewhere))
    found = write_table(found, work_path(spark, "positives"))

    # ------------------------------------------------------------ negatives
    def window(percent: int, up: bool):
        score = F.col("score").cast("decimal(38,0)") * percent
        edge = F.ceil(score / 100) if up else F.floor(score / 100)
        return F.least(F.greatest(edge, F.lit(LEAST)), F.lit(MOST)).cast("long")

    windows = (
        found.withColumn("low", window(low_percent, True))
        .withColumn("high", window(high_percent, False))
        .filter("low <= high")
        .groupBy(F.col("anchor_id").alias("id"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "low", "high"))).alias("windows"))
    )

    def looking(asks: DataFrame) -> DataFrame:
        return asks.select(
            "*",
            F.array_min(F.transform("windows", lambda w: w["low"])).alias("floor"),
            F.array_max(F.transform("windows", lambda w: w["high"])).alias("ceiling"),
        ).select(
            *[c for c in asks.columns if c != "windows"], "floor", "ceiling",
            F.transform("windows", lambda w: w["place"]).alias("places"),
            F.transform("windows", lambda w: w["low"]).alias("lows"),
            F.transform("windows", lambda w: w["high"]).alias("highs"),
        )

    def top_negatives(left, right):
        out = []
        if left.num_rows and right.num_rows:
            floor = right.column("q_floor").to_numpy().astype(np.float64)
            ceiling = right.column("q_ceiling").to_numpy().astype(np.float64)
            ceiling = np.where(ceiling > 2.0**62, np.inf, ceiling)
            asks, own = right.column("q_id").to_numpy(), right.column("q_label").to_numpy()
            places, lows, highs = (right.column(f"q_{c}").to_pylist() for c in ("places", "lows", "highs"))
            dims = left.column("dims")[0].as_py()
            for i, ids, labels, score in _scored(left, right, floor, ceiling, dims in known):
                good = np.flatnonzero((labels != own[i]) & (score >= min(lows[i])) & (score <= max(highs[i])))
                good = good[np.lexsort((ids[good], ~score[good]))]
                falling = ~score[good]  # rises as the score falls
                for place, low, high in zip(places[i], lows[i], highs[i]):
                    start = np.searchsorted(falling, ~high, "left")
                    end = min(start + negatives, np.searchsorted(falling, ~low, "right"))
                    some = good[start:end]
                    if len(some):
                        out.append((np.full(len(some), asks[i]), np.full(len(some), place), ids[some], score[some]))
        return _table(out, ["anchor_id", "place", "negative_id", "score"], [pa.int64(), pa.int32(), pa.int64(), pa.int64()])

    order = W.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "negative_id")

    def first_few(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)

    negative_schema = "anchor_id long, place int, negative_id long, score long"
    windowed = write_table(asked.join(windows, "id"), work_path(spark, "negatives-windows"))
    near = _met(_routes(layout, looking(windowed), False, True), blocks, groups, top_negatives, negative_schema)
    near = write_table(first_few(near), work_path(spark, "negatives-home"))
    # What is full at home asks only for better ones elsewhere.
    full = near.filter(F.col("rank") == negatives).groupBy(F.col("anchor_id").alias("id")).agg(
        F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("full")
    )
    narrowed = windowed.join(full, "id", "left").withColumn(
        "windows",
        F.transform(
            "windows", lambda w: w.withField("low", F.coalesce(F.try_element_at("full", w["place"]), w["low"]))
        ),
    ).drop("full")
    far = _met(_routes(layout, looking(narrowed), False, False), blocks, groups, top_negatives, negative_schema)
    final = first_few(near.drop("rank").unionByName(far))
    return final.join(found.withColumnRenamed("score", "positive_score"), ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score")
    )
