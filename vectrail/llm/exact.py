"""Exact inner products of vectors of whole numbers held as doubles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

LEAST, MOST = -(1 << 63), (1 << 63) - 1


def floored(vector: Column, factor: float) -> Column:
    """``floor(factor * x)`` of every component, as whole doubles.

    NULL for a vector that is NULL or empty, or holds a component that is NULL or not finite, or is
    not finite after scaling.
    """
    grown = F.transform(vector, lambda x: F.lit(factor) * x.cast("double"))
    usable = F.forall(grown, lambda y: F.coalesce((y > float("-inf")) & (y < float("inf")), F.lit(False)))
    # floor() of a double is a long in Spark; what has no long is whole already.
    whole = F.transform(grown, lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y))
    return F.when((F.size(vector) > 0) & usable, whole)


def matrix(column, dims: int) -> np.ndarray:
    """A list column, all lists ``dims`` long, as rows of doubles."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64, copy=False)


def norms(rows: np.ndarray) -> np.ndarray:
    """Lengths, without overflow on the way."""
    top = np.maximum(np.abs(rows).max(axis=1, initial=0), 1.0)
    return top * np.sqrt(((rows / top[:, None]) ** 2).sum(axis=1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products as int64, exact; beyond 64 bits the nearest number that fits."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    with np.errstate(all="ignore"):
        rough = a @ b.T
        # Every partial sum is a whole number below 2^53, so doubles hold it.
        sure = np.multiply.outer(np.abs(a).max(1), np.abs(b).max(1)) * a.shape[1] < 2.0**53
        out = np.where(sure, rough, 0).astype(np.int64)
    for i, j in np.argwhere(~sure):
        exact = sum(int(x) * int(y) for x, y in zip(a[i], b[j]))
        out[i, j] = min(max(exact, LEAST), MOST)
    return out
