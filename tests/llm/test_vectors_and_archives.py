"""Top-k search, vector near-dedup and WARC against brute force, on hard rows."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrail.llm import topk, vector_dedup, warc
from vectrail.session import work_path

VECTORS = "vec_id long, embedding array<float>, label int, score string, rank string"


def hard_vectors(n=700, dims=8, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(25, dims))
    rows = []
    for i in range(n):
        v = centres[i % 25] + draw.normal(size=dims) * draw.choice([0.02, 0.1, 0.6])
        rows.append((i, [float(x) for x in np.float32(v)], i % 3, "x", "y"))
    hot = rows[17][1]
    rows += [(10_000 + i, hot, 2, "x", "y") for i in range(300)]  # a third of the rows are equal
    bad = [None, [], [0.0] * dims, [1.0, None] + [0.0] * (dims - 2), [float("nan")] * dims, [float("inf")] + [1.0] * (dims - 1), [1.0, 2.0]]
    rows += [(20_000 + 100 * i, v, 1, "x", "y") for i, v in enumerate(bad)]
    rows += [(None, hot, 2, "x", "y"), (30_000, hot, None, "x", "y"), (17, hot, 2, "x", "y")]
    return rows


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(hard_vectors(), VECTORS)


# ----------------------------------------------------------------------- top k


def plain_top_k(rows, k, dims=8):
    usable = [
        (i, [math.floor(1024 * float(np.float32(x))) for x in v])
        for i, v, *_ in rows
        if i is not None and v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for q, v in usable:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)[:k]
            out |= {(q, place + 1, i, -s) for place, (s, i) in enumerate(scored)}
    return out


def test_top_k_of_large_components_and_several_lengths(spark):
    """Components of 3e5 and 1e15, products beyond 64 bits, and each length by itself."""
    draw = np.random.default_rng(4)
    rows = [(i, [float(x) for x in draw.normal(size=4)]) for i in range(300)]
    rows += [(300 + i, [float(x) for x in draw.normal(size=3)]) for i in range(150)]
    rows += [(1000 + 10 * i, [1.0] * (5 + i % 12)) for i in range(60)]  # more lengths than have pivots
    rows += [(2000, [3e5, 1.0, 0.0, 2.0]), (2100, [1e15, -1.0, 0.5, 0.0]), (2200, [-1e15, 1e15, 3.0, 3e5]), (2300, [1e200, 1.0, 1.0, 1.0])]
    clamp = lambda x: min(max(x, -(1 << 63)), (1 << 63) - 1)
    usable = [(i, [math.floor(1024 * x) if abs(1024 * x) < 2**53 else int(1024 * x) for x in v]) for i, v in rows]
    want = set()
    for q, v in usable:
        if q % 100 == 0:
            scored = sorted((-clamp(sum(a * b for a, b in zip(v, w))), i) for i, w in usable if i != q and len(w) == len(v))[:10]
            want |= {(q, place + 1, i, -s) for place, (s, i) in enumerate(scored)}
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vector", topk.scaled(F.col("embedding")))
    for pivots in (128, 5):
        found = topk.top_k(table.filter("vec_id % 100 = 0"), table, 10, pivots)
        assert {tuple(r) for r in found.collect()} == want
    assert {2100, 2300} <= {r[2] for r in want} and {2000, 2200} <= {r[0] for r in want}


@pytest.mark.parametrize("k,pivots", [(10, 128), (1, 3), (2000, 16)])
def test_top_k_on_hard_vectors(vectors, k, pivots):
    rows = vectors.withColumn("vector", topk.scaled(F.col("embedding")))
    found = topk.top_k(rows.filter("vec_id % 100 = 0"), rows, k, pivots)
    assert {tuple(r) for r in found.collect()} == plain_top_k(hard_vectors(), k)


def test_top_k_with_scores_beyond_doubles(spark):
    big = [[(1 << 27) - i, -(1 << 27) + 7 * i, 3 + i] for i in range(40)]
    df = spark.createDataFrame([(i * 50, v) for i, v in enumerate(big)], "vec_id long, vector array<long>")
    found = topk.top_k(df.filter("vec_id % 100 = 0"), df, 3).collect()
    for r in found:
        assert r["score"] == sum(a * b for a, b in zip(big[r["query_id"] // 50], big[r["vec_id"] // 50]))


def test_top_k_skips_groups_out_of_reach(spark):
    # Two far groups: nearly all queries are settled at home.
    rows = [(i, [1000 + i % 7, 0] if i % 2 else [-1000 - i % 5, 0]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    found = topk.top_k(df.filter("vec_id % 100 = 0"), df, 5, pivots=2).collect()
    want = []
    for q in range(0, 400, 100):
        best = sorted((-(rows[q][1][0] * v[0]), i) for i, v in rows if i != q)[:5]
        want += [(q, p + 1, i, -s) for p, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in found) == sorted(want)


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, vector array<long>")
    some = spark.createDataFrame([(100, [1, 2])], "vec_id long, vector array<long>")
    assert topk.top_k(empty, empty).count() == 0
    assert topk.top_k(some, some).count() == 0
    assert topk.top_k(empty, some).count() == 0


# ----------------------------------------------------------- vector near-dedup


def plain_links(rows, threshold):
    fit = []
    for place, (i, v, label, *_) in enumerate(rows):
        whole = v and label is not None and i is not None and all(x is not None and math.isfinite(x) for x in v)
        if whole and any(v):
            x = np.array(v, np.float64)
            fit.append((place, label, len(v), x / np.sqrt((x**2).sum())))
    near = {place: set() for place in range(len(rows))}
    for a, label, size, x in fit:
        for b, label2, size2, y in fit:
            if a != b and label == label2 and size == size2 and x @ y >= threshold:
                near[a].add(b)
    out = Counter()
    for place, row in enumerate(rows):
        reach, todo = {place}, [place]
        while todo:
            for b in near[todo.pop()] - reach:
                reach.add(b)
                todo.append(b)
        name = row[0] if row[0] is None else min(rows[p][0] for p in reach)
        out[(row[0], len(near[place]), name, row[0] is not None and name == row[0])] += 1
    return out


def test_vector_dedup_on_hard_vectors(vectors):
    found = vector_dedup.near_duplicates(vectors, 0.98)
    want = plain_links(hard_vectors(), 0.98)
    got = Counter(tuple(r) for r in found.collect())
    assert sum(got.values()) == sum(want.values())
    assert sum((got & want).values()) >= 0.98 * sum(want.values())
    exact = {r for r in want if r[1] == 0}
    assert exact <= set(got)  # nothing links below the threshold


def test_vector_dedup_over_many_shards(spark):
    rows = hard_vectors(1500, seed=4)
    df = spark.createDataFrame(rows, VECTORS)
    named = df.filter("vec_id IS NOT NULL AND vec_id < 10000").dropDuplicates(["vec_id"]).select(
        F.col("vec_id").alias("_id"), F.col("embedding").alias("_v"), F.lit(1).cast("long").alias("_n"), F.col("label").alias("_group")
    )
    members = vector_dedup.shards(named, shard_rows=120)
    sizes = [r["count"] for r in members.groupBy("_shard").count().collect()]
    assert len(sizes) > 10 and max(sizes) <= 400
    assert members.select("_id").distinct().count() == named.count()
    found = vector_dedup.links(members, 0.98, 24)
    true, hit = vector_dedup.audit(named, found, 0.98, 300)
    assert true > 100 and hit >= 0.95 * true


def test_robust_pruning_keeps_the_nearest_and_spreads(spark):
    draw = np.random.default_rng(2)
    unit = draw.normal(size=(300, 6))
    unit /= np.sqrt((unit**2).sum(1, keepdims=True))
    lists = vector_dedup.neighbour_lists(unit)
    similar = unit @ unit.T
    np.fill_diagonal(similar, -2)
    assert (lists[:, 0] == similar.argmax(1)).all()
    for i in range(50):
        kept = [j for j in lists[i] if j >= 0]
        for place, j in enumerate(kept):
            for earlier in kept[:place]:
                assert vector_dedup.ALPHA**2 * (1 - unit[earlier] @ unit[j]) > (1 - similar[i, j]) - 1e-12


def test_vector_dedup_finds_all_links_of_dense_groups(spark):
    # 3,600 different vectors around one direction, more than a shard holds.
    draw = np.random.default_rng(6)
    dense = np.float32(np.ones(16) + draw.normal(size=(3600, 16)) * 0.14)
    rows = [(i, [float(x) for x in v], 7, "x", "y") for i, v in enumerate(dense)]
    unit = dense.astype(np.float64)
    unit /= np.sqrt((unit**2).sum(1, keepdims=True))
    want = (unit @ unit.T >= 0.98).sum(1) - 1
    assert 1000 < want.mean() < 3500
    got = vector_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), 0.98).collect()
    assert {r["_id"]: r["n_links"] for r in got} == dict(enumerate(want.tolist()))


@pytest.mark.parametrize("block_rows", [None, 40, 7])
def test_vector_dedup_is_exact_for_any_size_of_blocks(vectors, block_rows):
    found = vector_dedup.near_duplicates(vectors, 0.98, block_rows=block_rows)
    assert Counter(tuple(r) for r in found.collect()) == plain_links(hard_vectors(), 0.98)


def test_vector_dedup_skips_blocks_out_of_range(spark):
    draw = np.random.default_rng(8)
    centres = np.eye(12)[draw.integers(0, 12, 1200)]
    v = centres + draw.normal(size=(1200, 12)) * 0.01
    df = spark.createDataFrame(
        [(i, -i, i, 1, 1, x.tolist()) for i, x in enumerate(v)],
        "_a long, _b long, _id long, _n long, _group int, _v array<double>",
    )
    pairs = vector_dedup.block_pairs(df, 0.98, 60)
    blocks = pairs.select("_block").distinct().count()
    assert blocks >= 12 and pairs.count() < 1200 * blocks / 2


def test_vector_dedup_of_nothing_and_of_one(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert vector_dedup.near_duplicates(empty).count() == 0
    one = spark.createDataFrame([(5, [1.0, 2.0], 1, "x", "y")], VECTORS)
    assert [tuple(r) for r in vector_dedup.near_duplicates(one).collect()] == [(5, 0, 5, True)]


# ------------------------------------------------------------------------ WARC

RECORD = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77777>\r\nContent-Length: 5\r\n\r\nhello"


def hard_pages(n=1200):
    draw = random.Random(5)
    bits = ["\r\n\r\nWARC/1.", "\r\n\r\nWARC/1.1\r\n", "WARC/1.1\r\n", "\r\n", "\r", "\n", "abc" * 50, RECORD]
    bits += ["\r\n\r\n" + RECORD, "\r\n\r\n" + RECORD + "\r\n\r\n", "é", "x", "Content-Length: 3\r\n\r\n", "\r\n\r\n"]
    rows = [
        (i, f"http://x/{i}\r\nWARC/1.1", "".join(draw.choice(bits) for _ in range(draw.choice([0, 0, 1, 2, 5, 20]))), "z")
        for i in range(n)
    ]
    rows += [(n, None, None, None), rows[5], (None, None, "only without id", "z"), (None, None, "abc", "z"), (-5, "u", "neg", "z")]
    rows.append((n + 1, "long", "\r\n\r\nWARC/1.1\r\n" + "y" * 2_000_000, "z"))
    return rows


PAGES = "page_id long, url string, html string, record_type string"


def plain_records(rows, least=0):
    low = -(10**9)
    top = {}
    for i, _, h, _ in rows:
        key = (h or "").encode()
        top[key] = max(top.get(key, low), low if i is None else i)
    out = Counter()
    for i, _, h, _ in rows:
        key = (h or "").encode()
        first = len(key) < least or (low if i is None else i) == top[key]
        digest = base64.b32encode(hashlib.sha1(key).digest()).decode()
        out[(i, len(key), digest, "response" if first else "revisit", None if first else top[key])] += 1
    return out


@pytest.mark.parametrize("split,least,compression", [("128m", 0, "none"), ("5000", 0, "none"), ("128m", 30, "gzip")])
def test_warc_round_trip(spark, split, least, compression):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = hard_pages()
        path = work_path(spark, "warc")
        warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(3), path, least, compression=compression)
        assert Counter(tuple(r) for r in warc.page_records(spark, path).collect()) == plain_records(rows, least)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.files.openCostInBytes", old[1])


def test_warc_payloads_come_back(spark):
    rows = hard_pages(200)
    path = work_path(spark, "warc")
    warc.write_warc(spark.createDataFrame(rows, PAGES), path)
    read = warc.read_warc(spark, path).filter("warc_type = 'response'")
    found = Counter(bytes(r["payload"]) for r in read.collect())
    assert set(found) == {(r[2] or "").encode() for r in rows}
    wrong = read.filter(F.col("declared_digest") != warc.base32_sha1(F.col("payload"))).count()
    assert wrong == 0


def test_warc_of_nothing(spark):
    path = work_path(spark, "warc")
    warc.write_warc(spark.createDataFrame([], PAGES), path)
    assert warc.page_records(spark, path).count() == 0
