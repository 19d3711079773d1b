import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrail.functions import vector
from vectrail.operators import profile
from vectrail.operators.search import vector_search

EDGE = [
    (1, [3.0, 4.0]),
    (2, [0.0, 0.0]),
    (3, [2.0, 2.0]),
    (4, []),
    (5, None),
    (6, [1.0]),
    (7, [math.nan, 1.0]),
    (8, [math.inf, 1.0]),
    (9, [-1.0, 2.0]),
    (10, [None, 1.0]),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, "id long, v array<float>")


def by_id(df, column):
    return {row["id"]: row[column] for row in df.collect()}


def test_distances_of_edge_vectors(edge):
    q = vector.literal([3.0, 4.0])
    cosine = by_id(edge.select("id", vector.cosine_distance(F.col("v"), q).alias("d")), "d")
    assert cosine[1] == pytest.approx(0.0)
    assert cosine[2] is None and cosine[4] is None and cosine[5] is None
    assert cosine[6] is None and cosine[10] is None
    assert math.isnan(cosine[7])
    l2 = by_id(edge.select("id", vector.l2_distance(F.col("v"), q).alias("d")), "d")
    assert l2[2] == pytest.approx(5.0) and l2[6] is None and l2[8] == math.inf
    inner = by_id(edge.select("id", vector.negative_inner_product(F.col("v"), q).alias("d")), "d")
    assert inner[9] == pytest.approx(-5.0)


def test_dims_and_norm(edge):
    rows = edge.select("id", vector.dims(F.col("v")).alias("n"), vector.norm(F.col("v")).alias("l"))
    found = {r["id"]: (r["n"], r["l"]) for r in rows.collect()}
    assert found[1] == (2, 5.0) and found[4] == (0, 0.0) and found[5] == (None, None)


@pytest.mark.parametrize(
    "method, expected",
    [
        ("l2", [0.6, 0.8]),
        ("max", [0.75, 1.0]),
        ("minmax", [0.0, 1.0]),
        ("sum", [0.428571, 0.571429]),
    ],
)
def test_normalise(edge, method, expected):
    v = F.col("v")
    df = edge.select(
        "id",
        vector.normalise(v, method).alias("n"),
        vector.normalise_error(v, method).alias("why"),
    )
    rows = {r["id"]: r for r in df.collect()}
    assert rows[1]["n"] == pytest.approx(expected) and rows[1]["why"] is None
    assert rows[2]["n"] is None and rows[2]["why"].startswith("zero")
    assert rows[4]["n"] is None and rows[4]["why"] == "empty vector"
    assert rows[5]["n"] is None and rows[5]["why"] == "null vector"
    if method == "minmax":
        assert rows[3]["n"] is None and rows[3]["why"] == "zero range"
    else:
        assert rows[3]["n"] is not None


def test_unknown_names_are_refused(edge):
    with pytest.raises(ValueError):
        vector.distance(F.col("v"), F.col("v"), "hamming")
    with pytest.raises(ValueError):
        vector.normalise(F.col("v"), "cube")


def test_text_form_round_trip(edge):
    df = edge.filter("id in (1, 3, 4, 9)").select(
        "id", "v", vector.from_text(vector.to_text(F.col("v"))).alias("w")
    )
    assert all(r["v"] == r["w"] for r in df.collect())


def test_random_vectors_repeat_and_are_unit(spark):
    df = spark.range(20).select(
        "id",
        vector.random_vector(F.col("id"), 8).alias("a"),
        vector.random_vector(F.col("id"), 8).alias("b"),
        vector.random_vector(F.col("id"), 8, low=2.0, high=3.0, unit=False).alias("c"),
    )
    for r in df.collect():
        assert r["a"] == r["b"]
        assert np.linalg.norm(r["a"]) == pytest.approx(1.0)
        assert all(2.0 <= x < 3.0 for x in r["c"])


def test_validation_counts_each_fault_once(edge):
    row = profile.validate_vectors(edge, "v", 2).first()
    assert (row["n_vectors"], row["n_null"], row["n_empty"]) == (10, 1, 1)
    assert (row["n_nan"], row["n_infinity"], row["n_with_null"]) == (1, 1, 1)
    assert (row["n_lengths"], row["n_wrong_dims"], row["compatible"]) == (2, 1, False)
    good = edge.filter("id in (1, 3)")
    assert profile.validate_vectors(good, "v").first()["compatible"]
    assert not profile.validate_vectors(edge.limit(0), "v").first()["compatible"]
    assert profile.require_valid(good, "v") is good
    with pytest.raises(ValueError):
        profile.require_valid(edge, "v", 2)


@pytest.mark.parametrize("engine", ["native", "arrow"])
def test_rows_without_distance_come_last(edge, engine):
    found = vector_search(
        edge.filter("id not in (7, 8)"), [3.0, 4.0], 10, "cosine", "v", engine=engine
    ).collect()
    assert [r["id"] for r in found[:3]] == [1, 3, 9]
    assert [r["id"] for r in found[3:]] == [2, 4, 5, 6, 10]
    assert all(r["similarity"] is None for r in found[3:])


def test_zero_query_has_no_cosine(edge):
    for engine in ("native", "arrow"):
        found = vector_search(edge.filter("id = 1"), [0.0, 0.0], 1, "cosine", "v", engine=engine)
        assert found.first()["distance"] is None
