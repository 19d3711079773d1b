"""Quality by ordinal cumulative-link regression on graded ratings.

One weight per hashed byte n-gram is shared by all grades, and ordered thresholds cut
the score of a text into grades: P(grade <= k) = sigmoid(threshold_k - score).  That
gives an expected grade and the probability of reaching a grade, for selection.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrail.llm.texts import pieces, third

BITS = 16  # weights: 2**BITS
GRAM = 3  # bytes
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def hashed(text: bytes) -> np.ndarray:
    """The weight numbers of all byte n-grams of a piece of text, A-Z lower-cased."""
    codes = _LOWER[np.frombuffer(text, np.uint8)].astype(np.uint32)
    n = len(codes) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    gram = np.zeros(n, np.uint32)
    for i in range(GRAM):
        gram = (gram << np.uint32(8)) | codes[i : i + n]
    return (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)


def counts(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct weight numbers of a text with their shares."""
    total = np.zeros(1 << BITS, np.int64)
    for piece in pieces(text or b""):
        total += np.bincount(hashed(piece), minlength=1 << BITS)
    some = np.flatnonzero(total)
    return some.astype(np.int32), total[some] / max(1, total.sum())


@dataclass
class Model:
    """Grades in rising order, weights and thresholds (one less than grades)."""

    grades: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def text_score(self, text: bytes | None) -> float:
        """Mean weight over all n-grams; 0 for texts without any."""
        total, n = 0.0, 0
        for piece in pieces(text or b""):
            found = self.weights[hashed(piece)]
            total, n = total + float(found.sum(dtype=np.float64)), n + len(found)
        return total / n if n else 0.0

    def reach(self, scores: np.ndarray) -> np.ndarray:
        """Probability of reaching each grade but the lowest (row: text)."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - scores[:, None], -30, 30)))

    def expected(self, scores: np.ndarray) -> np.ndarray:
        if not len(self.grades):
            return np.zeros(len(scores))
        return self.grades[0] + self.reach(scores) @ np.diff(self.grades)


def fit_ordinal(
    rows: np.ndarray, columns: np.ndarray, shares: np.ndarray, grades: np.ndarray, steps: int = 200, ridge: float = 1e-3
) -> Model:
    """Maximum likelihood with a ridge, by Adam on all rows at once.

    ``rows``, ``columns``, ``shares`` are the entries of the sparse matrix of n-gram shares.
    With fewer than two grades there are no thresholds.
    """
    levels, y = np.unique(grades, return_inverse=True)
    k, n, width = len(levels), len(grades), 1 << BITS
    if k < 2:
        return Model(levels.astype(float), np.zeros(width, np.float32), np.zeros(0))
    # Rare n-grams have small shares; scaling by their spread lets all of them learn.
    spread = np.sqrt(np.bincount(columns, shares**2, width) / n) + 1e-6
    values = shares / spread[columns]
    below = np.cumsum(np.bincount(y, minlength=k))[:-1] / n
    start = np.log(below / (1 - below))
    theta = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    weights = np.zeros(width)
    state = [np.zeros(width), np.zeros(width), np.zeros(k - 1), np.zeros(k - 1)]
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for step in range(1, steps + 1):
        cuts = np.concatenate([[-np.inf], np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])])), [np.inf]])
        score = np.bincount(rows, values * weights[columns], n)
        low, high = sigmoid(cuts[y] - score), sigmoid(cuts[y + 1] - score)
        low[y == 0], high[y == k - 1] = 0.0, 1.0
        by_score = low + high - 1
        p = np.maximum(high - low, 1e-12)
        by_cut = np.bincount(y, high * (1 - high) / p, k)[:-1] - np.bincount(y, low * (1 - low) / p, k)[1:]
        # Thresholds are sums of their positive steps.
        by_theta = np.cumsum(by_cut[::-1])[::-1] * np.concatenate([[1.0], np.exp(theta[1:])])
        gradients = (np.bincount(columns, values * by_score[rows], width) / n - ridge * weights, by_theta / n)
        for i, (parameter, gradient) in enumerate(zip((weights, theta), gradients)):
            first, second = state[2 * i], state[2 * i + 1]
            first += 0.1 * (gradient - first)
            second += 0.01 * (gradient**2 - second)
            parameter += 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    thresholds = np.cumsum(np.concatenate([theta[:1], np.exp(theta[1:])]))
    return Model(levels.astype(float), (weights / spread).astype(np.float32), thresholds)


def fit(
    documents: DataFrame,
    ratings: DataFrame,
    max_texts: int = 5000,
    id_column: str = "doc_id",
    text_column: str = "text",
    grade_column: str = "quality",
) -> Model:
    """Learn from at most ``max_texts`` rated documents that are not held out.

    Which is decided by a hash of the id; the bound holds what the driver gets, and nothing
    else depends on it.  Grades are integers, any number of them; a document with several
    ratings has the lowest.  NULL grades, ids and texts are not used.
    """
    draw = F.xxhash64(F.lit("quality"), "_id")
    rated = (
        ratings.filter(F.col(grade_column).isNotNull())
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.min(grade_column).cast("long").alias("_grade"))
        .filter(third("_id") != 1)
        .orderBy(draw, "_id")
        .limit(max_texts)
    )
    rows = documents.select(F.col(id_column).alias("_id"), F.col(text_column).cast("binary").alias("_text"))
    joined = rows.filter(F.col("_text").isNotNull()).join(rated, "_id")

    def run(batches):
        for batch in batches:
            found = [counts(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                 pa.array([f[1] for f in found], pa.list_(pa.float64()))],
                ["_id", "_grade", "_columns", "_shares"],
            )

    kind = joined.schema["_id"].dataType.simpleString()
    shape = f"_id {kind}, _grade bigint, _columns array<int>, _shares array<double>"
    table = joined.select("_id", "_text", "_grade").mapInArrow(run, shape).toArrow().sort_by("_id")
    lists = table.column("_columns").combine_chunks()
    rows_ = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    return fit_ordinal(
        rows_,
        lists.flatten().to_numpy(),
        table.column("_shares").combine_chunks().flatten().to_numpy(),
        table.column("_grade").to_numpy(),
    )


def score(documents: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``_id``, ``expected_grade`` and ``reach`` (probability of each grade but the lowest, rising).

    Every whole text is scored, by its text alone.  A NULL or very short text has score 0
    and so the grade of the thresholds alone.  Repeated rows score alike; an empty table
    gives no rows.
    """
    rows = documents.select(F.col(id_column).alias("_id"), F.col(text_column).cast("binary").alias("_text"))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights

    def run(batches):
        for batch in batches:
            scores = np.array([shared.value.text_score(text.as_py()) for text in batch.column(1)], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shared.value.expected(scores)),
                 pa.array(list(shared.value.reach(scores)), pa.list_(pa.float64()))],
                ["_id", "expected_grade", "reach"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, expected_grade double, reach array<double>")
