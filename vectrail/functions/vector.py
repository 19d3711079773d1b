"""Vector functions as native column expressions.

A vector is ``array<float>`` or ``array<double>``; arithmetic runs in double.
Vectors of different lengths give NULL, because ``zip_with`` pads with NULL.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("cosine", "l2", "inner_product")
NORMALISATIONS = ("l2", "max", "minmax", "sum")
_TWO_POW_32 = 4294967296.0

# Vector length, the model that usually gives it, and its provider.
MODEL_GUIDE = (
    (4096, "qwen/qwen3-embedding-8b", "OpenRouter / Alibaba"),
    (1536, "text-embedding-ada-002", "OpenAI"),
    (3072, "text-embedding-3-large", "OpenAI"),
    (1024, "text-embedding-3-small", "OpenAI"),
    (768, "bert-base-uncased", "HuggingFace"),
)

# The shorter list used by the table diagnostic.
STANDARD_DIMENSIONS = (
    (1536, "OpenAI text-embedding-ada-002"),
    (3072, "OpenAI text-embedding-3-large"),
    (384, "Sentence Transformers (all-MiniLM-L6-v2)"),
)


def literal(vector: Sequence[float]) -> Column:
    """A vector constant."""
    return F.array(*[F.lit(float(x)) for x in vector]).cast("array<double>")


def _sum(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    """Inner product."""
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def dims(v: Column) -> Column:
    """Number of elements; NULL stays NULL."""
    return F.when(v.isNotNull(), F.size(v))


def norm(v: Column) -> Column:
    """Euclidean length."""
    return F.sqrt(
        F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def cosine_distance(a: Column, b: Column) -> Column:
    """One minus the cosine; NULL when either vector has zero length."""
    return F.lit(1.0) - F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_distance(a: Column, b: Column) -> Column:
    """Euclidean distance."""

    def square(x: Column, y: Column) -> Column:
        gap = x.cast("double") - y.cast("double")
        return gap * gap

    return F.sqrt(_sum(F.zip_with(a, b, square)))


def negative_inner_product(a: Column, b: Column) -> Column:
    """Inner product with the sign turned, so that smaller is nearer."""
    return -dot(a, b)


def distance(a: Column, b: Column, metric: str = "cosine") -> Column:
    """Distance of two vector columns under one of ``METRICS``."""
    if metric == "cosine":
        return cosine_distance(a, b)
    if metric == "l2":
        return l2_distance(a, b)
    if metric == "inner_product":
        return negative_inner_product(a, b)
    raise ValueError(f"unknown metric {metric!r}, expected one of {METRICS}")


def distance_to(v: Column, query: Sequence[float], metric: str = "cosine") -> Column:
    """Distance of a vector column to one constant query vector.

    The length of the query is worked out once here, not once per row.
    """
    q = literal(query)
    if metric == "cosine":
        q_norm = math.sqrt(sum(float(x) * float(x) for x in query))
        return F.lit(1.0) - F.try_divide(dot(v, q), norm(v) * F.lit(q_norm))
    return distance(v, q, metric)


def similarity(dist: Column) -> Column:
    """One minus the distance, for every metric."""
    return F.lit(1.0) - dist


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Work ``value`` out once and hand it to ``body``.

    An expression used inside a lambda runs again for every element; binding it
    to a lambda variable first keeps a vector of n elements at n steps.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _abs_all(v: Column) -> Column:
    return F.transform(v, lambda x: F.abs(x.cast("double")))


def normalise(v: Column, method: str = "l2", decimals: int | None = 6) -> Column:
    """Scale a vector; NULL where ``normalise_error`` names a reason.

    ``decimals`` rounds the elements; ``None`` keeps them whole.
    """
    low = F.array_min(v).cast("double") if method == "minmax" else F.lit(0.0)

    def scale(x: Column, terms: Column) -> Column:
        y = F.try_divide(x.cast("double") - terms["low"], terms["span"])
        return y if decimals is None else F.round(y, decimals)

    terms = F.struct(low.alias("low"), _divisor(v, method).alias("span"))
    return _let(
        terms,
        lambda t: F.when((t["span"] != 0) & (F.size(v) > 0), F.transform(v, lambda x: scale(x, t))),
    )


def _divisor(v: Column, method: str) -> Column:
    if method == "l2":
        return norm(v)
    if method == "max":
        return F.array_max(_abs_all(v))
    if method == "sum":
        return _sum(_abs_all(v))
    if method == "minmax":
        return F.array_max(v).cast("double") - F.array_min(v).cast("double")
    raise ValueError(f"unknown method {method!r}, expected one of {NORMALISATIONS}")


def normalise_error(v: Column, method: str = "l2") -> Column:
    """Why a vector cannot be normalised; NULL when it can."""
    reason = "zero range" if method == "minmax" else "zero vector"
    return (
        F.when(v.isNull(), F.lit("null vector"))
        .when(F.size(v) == 0, F.lit("empty vector"))
        .when(_divisor(v, method) == 0, F.lit(reason))
    )


def has_nan(v: Column) -> Column:
    return F.exists(v, lambda x: F.isnan(x))


def has_infinity(v: Column) -> Column:
    return F.exists(v, lambda x: F.abs(x.cast("double")) == F.lit(math.inf))


def to_text(v: Column) -> Column:
    """Text form ``[0.1,0.2]``."""
    return F.concat(F.lit("["), F.array_join(v.cast("array<string>"), ","), F.lit("]"))


def from_text(text: Column, element: str = "float") -> Column:
    """Vector from its text form."""
    return F.from_json(text, f"array<{element}>")


def zeros(n: int) -> Column:
    """Zero vector."""
    return F.array_repeat(F.lit(0.0).cast("float"), n)


def random_vector(
    key: Column,
    n: int,
    seed: int = 42,
    low: float = -1.0,
    high: float = 1.0,
    unit: bool = True,
) -> Column:
    """A repeatable random vector per key, uniform in ``[low, high)``.

    The digits come from a digest of seed, key and position, so a task that is
    run again gives the same vector.  ``unit`` scales to length one.
    """

    def draw(i: Column) -> Column:
        text = F.concat_ws(":", F.lit(str(seed)), key.cast("string"), i.cast("string"))
        digits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double")
        return F.lit(float(low)) + digits / F.lit(_TWO_POW_32) * F.lit(float(high) - float(low))

    raw = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), draw)
    if not unit:
        return raw
    return _let(
        raw,
        lambda v: _let(
            norm(v), lambda n: F.transform(v, lambda x: F.coalesce(F.try_divide(x, n), x))
        ),
    )


def model_for(n: Column, guide: Sequence[tuple] = MODEL_GUIDE) -> Column:
    """Name of the model that usually gives vectors of this length."""
    pairs = [F.lit(part) for row in guide for part in row[:2]]
    return F.element_at(F.create_map(*pairs), n.cast("int"))


def provider_for(n: Column, guide: Sequence[tuple] = MODEL_GUIDE) -> Column:
    """Provider of that model."""
    pairs = [F.lit(part) for row in guide for part in (row[0], row[2])]
    return F.element_at(F.create_map(*pairs), n.cast("int"))
