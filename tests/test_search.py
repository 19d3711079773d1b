import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vectrail.functions import kernels, text
from vectrail.operators import ann, batch, search
from vectrail.operators.embedding import Embedder
from vectrail.session import work_path
from vectrail.sources.tables import load


@pytest.fixture(scope="module")
def vectors(spark, folder):
    return load(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")


@pytest.fixture(scope="module")
def texts(spark, folder):
    return load(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content")
    )


def triples(df):
    return sorted((r["query_id"], r["position"], r["id"], round(r["distance"], 9)) for r in df.collect())


def test_shared_and_blocked_batches_agree(vectors):
    asked = vectors.filter("id % 7 = 0").select(
        F.col("id").alias("query_id"), F.col("embedding").alias("query_vector")
    )
    shared = batch.batch_vector_search(asked, vectors, 4)
    blocked = batch.batch_vector_search(
        asked, vectors, 4, max_shared_queries=10
    )
    assert triples(shared) == triples(blocked)


def test_batch_agrees_with_single_searches(vectors):
    asked = vectors.filter("id < 3").select(
        F.col("id").alias("query_id"), F.col("embedding").alias("query_vector")
    )
    for metric in ("cosine", "l2", "inner_product"):
        many = batch.batch_vector_search(asked, vectors, 5, metric).collect()
        for row in asked.collect():
            one = search.vector_search(vectors, row["query_vector"], 5, metric).collect()
            got = sorted((r for r in many if r["query_id"] == row["query_id"]), key=lambda r: r["position"])
            assert [r["id"] for r in got] == [r["id"] for r in one]


def test_batch_with_copies_nulls_and_mixed_lengths(spark):
    rows = [(i, [1.0, 0.0]) for i in range(50)] + [(50, None), (51, [1.0]), (52, [0.0, 1.0])]
    corpus = spark.createDataFrame(rows, "id long, embedding array<float>")
    asked = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [2.0]), ("c", None), ("d", [0.0, 0.0])],
        "query_id string, query_vector array<float>",
    )
    for keep, want in (
        (False, {"a": [0, 1, 2], "b": [51]}),
        (True, {"a": [0, 1, 2], "b": [51, 0, 1], "d": [0, 1, 2]}),
    ):
        found = batch.batch_vector_search(asked, corpus, 3, keep_undefined=keep).collect()
        got = {}
        for r in sorted(found, key=lambda r: (r["query_id"], r["position"])):
            got.setdefault(r["query_id"], []).append(r["id"])
        assert got == want


def test_many_query_blocks_in_one_scan(spark, vectors, monkeypatch):
    """Every task reads the stored blocks itself; rows are held a part at a time."""
    monkeypatch.setattr(batch, "HELD_BYTES", 2_000)
    asked = vectors.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    found = batch.batch_vector_search(asked, vectors, 3, max_shared_queries=7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("FileScan parquet") <= 1
    assert triples(found) == triples(batch.batch_vector_search(asked, vectors, 3))


def test_text_keys(spark):
    rows = [(f"id-{i:02}", [float(i % 5), 1.0]) for i in range(40)]
    corpus = spark.createDataFrame(rows, "id string, embedding array<double>").repartition(4)
    asked = spark.createDataFrame(
        [("q", [3.0, 1.0]), ("r", [0.0, 1.0])], "query_id string, query_vector array<float>"
    )
    shared = batch.batch_vector_search(asked, corpus, 3, "l2")
    blocked = batch.batch_vector_search(
        asked, corpus, 3, "l2", max_shared_queries=1
    )
    for found in (shared, blocked):
        rows = [r for r in found.collect() if r["query_id"] == "q"]
        got = [r["id"] for r in sorted(rows, key=lambda r: r["position"])]
        assert got == ["id-03", "id-08", "id-13"]


def test_empty_query_table(vectors):
    asked = vectors.limit(0).select(
        F.col("id").alias("query_id"), F.col("embedding").alias("query_vector")
    )
    assert batch.batch_vector_search(asked, vectors, 3).count() == 0


def test_batch_text_agrees_with_single_searches(spark, texts):
    queries = ["ment tion", "tion", "le la", "elle pour", "zzz tion"]
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")
    many = batch.batch_text_search(asked, texts, 5).collect()
    for i, query in enumerate(queries):
        one = [(r["id"], r["rank"]) for r in search.text_search(texts, query, k=5).collect()]
        got = sorted((r for r in many if r["query_id"] == i), key=lambda r: r["position"])
        assert [(r["id"], r["text_rank"]) for r in got] == one


def test_batch_text_with_a_term_in_half_of_the_texts(spark):
    """Bounds leave most pairs out and lose nothing, ties included."""
    rows = []
    for i in range(4000):
        words = ["moteur"] * (1 + i % 7 if i % 2 else 0) + ["diesel"] * (i % 5) + ["panne"] * (i % 3) + ["huile"] * (i % 11 == 0)
        rows.append((i, " ".join(words + ["autre"] * (i % 13))))
    texts = spark.createDataFrame(rows, "id long, content string")
    queries = ["moteur diesel", "moteur panne", "diesel panne moteur", "huile moteur", "moteur", "moteur zzz"]
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")
    many = batch.batch_text_search(asked, texts, 10).collect()
    for i, query in enumerate(queries):
        one = [(r["id"], r["rank"]) for r in search.text_search(texts, query, k=10).collect()]
        got = sorted((r for r in many if r["query_id"] == i), key=lambda r: r["position"])
        assert [(r["id"], r["text_rank"]) for r in got] == one


def test_bounds_leave_out_most_pairs(spark):
    """A set scores a fifth, at most, of the texts of its rarest term."""
    draw = np.random.default_rng(0)
    rows = [(i, t, int(n)) for i in range(6000) for t, n in zip("abc", draw.poisson(draw.exponential(2.0), 3)) if n]
    postings = spark.createDataFrame(rows, "id long, _term string, _tf long")
    sets = spark.createDataFrame([("s1", ["a", "b"]), ("s2", ["b", "c"]), ("s3", ["a", "b", "c"])], "_set string, _terms array<string>")
    scored = []
    real = batch._pairs
    batch._pairs = lambda *x: (scored.append(real(*x)), scored[-1])[1]
    try:
        found = batch._best_of_many(sets, postings, 10, "id").collect()
    finally:
        batch._pairs = real
    tf = {(i, t): n for i, t, n in rows}
    for name, terms in (("s1", "ab"), ("s2", "bc"), ("s3", "abc")):
        ranks = [
            (-round(sum(tf[i, t] / (tf[i, t] + 1) for t in terms) / len(terms), 12), i)
            for i in range(6000) if all((i, t) in tf for t in terms)
        ]
        got = sorted((r for r in found if r["_set"] == name), key=lambda r: r["position"])
        assert [(round(-r["text_rank"], 9), r["id"]) for r in got] == [(round(r, 9), i) for r, i in sorted(ranks)[:10]]
    rarest = sum(min(sum(t == u for _, u, _ in rows) for t in terms) for terms in ("ab", "bc", "abc"))
    assert 5 * sum(p.count() for p in scored) <= rarest


def test_hybrid_against_brute_force(spark, texts, vectors):
    query = list(vectors.filter("id = 7").first()["embedding"])
    hits = search.text_search(texts, "tion", k=100).collect()
    stored = {r["id"]: r["embedding"] for r in vectors.collect()}
    q = np.array(query)

    def cosine(v):
        v = np.array(v, dtype=float)
        return float(v @ q / np.linalg.norm(v) / np.linalg.norm(q))

    scored = [(r["id"], cosine(stored[r["id"]]), r["rank"]) for r in hits if r["id"] in stored]
    near = sorted(scored, key=lambda x: (-x[1], x[0]))[:10]
    expected = sorted(
        ((i, 0.7 * s + 0.3 * t, place) for place, (i, s, t) in enumerate(near, 1)),
        key=lambda x: (-x[1], x[0]),
    )
    got = search.hybrid_search(texts, "tion", query, vectors).collect()
    assert [(r["id"], r["rank"]) for r in got] == [(i, place) for i, _, place in expected]
    assert [r["final_score"] for r in got] == pytest.approx([s for _, s, _ in expected])
    joined = search.hybrid_search(texts.join(vectors, "id", "left"), "tion", query).collect()
    assert [(r["id"], r["rank"]) for r in joined] == [(r["id"], r["rank"]) for r in got]


def test_hybrid_keeps_candidates_without_vector(spark):
    rows = [(1, "chat noir", None), (2, "chat", [1.0, 0.0]), (3, "chien", [1.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, content string, embedding array<float>")
    got = search.hybrid_search(df, "chat", [1.0, 0.0]).collect()
    assert [(r["id"], r["similarity"]) for r in got] == [(2, 1.0), (1, None)]
    assert got[1]["final_score"] == pytest.approx(0.15)


def test_router(spark, texts, vectors):
    both = texts.join(vectors, "id", "left")
    model = Embedder(dims=64)
    assert {r["mode"] for r in search.search(both, "tion", model).collect()} == {"text"}
    assert {r["mode"] for r in search.search(both, "un deux trois", model).collect()} == {"vector"}
    forced = search.search(both, "tion", model, mode="hybrid").collect()
    assert forced and {r["mode"] for r in forced} == {"hybrid"}
    with pytest.raises(ValueError):
        search.search(both, "tion", model, mode="magic")


def test_batch_search_agrees_with_the_router(spark, texts, vectors):
    queries = ["tion", "un deux trois", "ment tion comment"]
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")
    model = Embedder(dims=64)
    many = batch.batch_search(asked, texts, vectors, model, 5).collect()
    for i, query in enumerate(queries):
        table = vectors if i == 1 else texts.join(vectors, "id", "left")
        one = search.search(table, query, model, k=5).collect()
        got = sorted((r for r in many if r["query_id"] == i), key=lambda r: r["position"])
        assert [(r["id"], r["mode"]) for r in got] == [(r["id"], r["mode"]) for r in one]


def test_mode_summary_and_fastest(spark):
    log = [("text", 10.0, True), ("text", 99.0, False), ("vector", 5.0, True), ("hybrid", 5.0, True)]
    df = spark.createDataFrame(log, "mode string, ms double, ok boolean")
    summary = batch.mode_summary(df)
    rows = {r["mode"]: r for r in summary.collect()}
    assert rows["text"]["avg_ms"] == 5.0 and rows["text"]["avg_ok_ms"] == 10.0
    assert rows["text"]["success_pct"] == 50.0
    assert batch.fastest_mode(summary).first()["fastest"] == "hybrid"


@pytest.mark.parametrize("metric", ["cosine", "l2", "inner_product"])
def test_lists_recall(spark, vectors, metric):
    path = work_path(spark, "ivf")
    assert ann.ivf_build(vectors, path, ann.learn_centres(vectors, 8, metric), metric) == 0
    query = list(vectors.filter("id = 7").first()["embedding"])
    exact = search.vector_search(vectors, query, 10, metric)
    every = ann.ivf_search(spark, path, query, 10, 8, metric)
    assert ann.recall(exact, every).first()["recall"] == 1.0
    bounded = ann.ivf_search(spark, path, query, 10, 1, metric, bounded=True)
    assert ann.recall(exact, bounded).first()["recall"] == 1.0
    some = ann.ivf_search(spark, path, query, 10, 4, metric)
    stored = spark.read.parquet(f"{path}/lists")
    assert stored.count() == vectors.count()
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(list_id" in plan or "PartitionFilters: [list_id" in plan


@pytest.mark.parametrize("metric", ["cosine", "l2", "inner_product"])
def test_batch_lists_recall_over_every_fiftieth_row(spark, vectors, metric):
    """Within a limit of lists at least 0.9 are found; without one the radii make it exact."""
    path = work_path(spark, "ivf")
    ann.ivf_build(vectors, path, ann.learn_centres(vectors, 8, metric), metric)
    asked = vectors.filter("id % 50 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    exact = batch.batch_vector_search(asked, vectors, 10, metric)
    some = ann.batch_ivf_search(asked, path, 10, 3, 6, metric)
    row = ann.mean_recall(exact, some).first()
    assert row["n_queries"] == asked.count() and row["n_exact"] == 10 * asked.count() and row["recall"] >= 0.9
    assert triples(ann.batch_ivf_search(asked, path, 10, 1, None, metric, rows_per_task=20)) == triples(exact)


def test_appended_rows_are_found_and_nothing_is_rebuilt(spark, vectors):
    path = work_path(spark, "ivf")
    ann.ivf_build(vectors.filter("id % 3 = 0"), path, ann.learn_centres(vectors, 6, "l2"), "l2")
    files = {r[0] for r in spark.read.parquet(f"{path}/lists").select(F.input_file_name()).distinct().collect()}
    far = spark.createDataFrame([(100_000, [50.0] * 64)], "id long, embedding array<float>")
    assert ann.ivf_append(vectors.filter("id % 3 != 0").unionByName(far, True), path, "l2") == 0
    after = {r[0] for r in spark.read.parquet(f"{path}/lists").select(F.input_file_name()).distinct().collect()}
    assert files < after
    everything = vectors.unionByName(far, True)
    for query in ([0.1] * 64, [50.0] * 64):
        exact = [r["id"] for r in search.vector_search(everything, query, 7, "l2").collect()]
        got = ann.ivf_search(spark, path, query, 7, 1, "l2", bounded=True).collect()
        assert [r["id"] for r in got] == exact


def test_batch_lists_with_odd_queries(spark, vectors):
    path = work_path(spark, "ivf")
    ann.ivf_build(vectors, path, ann.learn_centres(vectors, 4))
    asked = spark.createDataFrame(
        [("null", None), ("short", [1.0]), ("zero", [0.0] * 64), ("nan", [float("nan")] * 64), ("good", [1.0] * 64)],
        "query_id string, query_vector array<double>",
    )
    found = ann.batch_ivf_search(asked, path, 3, 2)
    assert {r["query_id"] for r in found.collect()} == {"good"}
    assert ann.batch_ivf_search(asked.limit(0), path, 3, 2).count() == 0


def test_vector_search_needs_no_shuffle(vectors):
    df = search.vector_search(vectors, [0.1] * 64, 5, where="id > 10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    assert "GreaterThan(vec_id,10)" in plan


def test_top_k_is_cut_before_the_shuffle(vectors):
    asked = vectors.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    plan = batch.batch_vector_search(asked, vectors, 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_search_of_queries_in_parts_never_shuffles_the_corpus(vectors):
    asked = vectors.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vector"))
    for most in (10_000, 50):
        df = batch.batch_vector_search(asked, vectors, 2, max_shared_queries=most)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" in plan and all("embedding" not in line for line in plan.split("\n") if "Exchange" in line)


def test_rows_without_a_distance_come_last_or_are_left_out_alike(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0]), (5, [0.5, 0.5])]
    corpus = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(3)
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, query_vector array<double>")
    for options, want in (({}, [1, 5, 2, 3, 4]), ({"keep_undefined": False}, [1, 5])):
        for k in (2, 4, 9):
            many = batch.batch_vector_search(asked, corpus, k, **options).orderBy("position").collect()
            one = search.vector_search(corpus, [1.0, 0.0], k, **options).collect()
            assert [r["id"] for r in many] == [r["id"] for r in one] == want[:k]
            assert all((r["distance"] is None) == (r["id"] in (2, 3, 4)) for r in many + one)


def test_more_than_a_hundred_hybrid_results(spark):
    rows = [(i, f"comment choisir un moteur numero {i}", [float(i), 1.0]) for i in range(150)]
    corpus = spark.createDataFrame(rows, "id long, content string, embedding array<double>")
    model = Embedder(2, lambda texts: [[1.0, 1.0] for _ in texts])
    query = "comment choisir un moteur"
    one = search.search(corpus, query, model, k=130).collect()
    assert len(one) == 130 and {r["mode"] for r in one} == {"hybrid"}
    asked = spark.createDataFrame([("q", query)], "query_id string, query string")
    many = batch.batch_search(asked, corpus, corpus.select("id", "embedding"), model, k=130).collect()
    assert len(many) == 130 and {r["mode"] for r in many} == {"hybrid"}


def test_equal_term_sets_and_a_term_in_half_of_the_texts(spark):
    rows = [(i, ("moteur " if i % 2 else "") + f"diesel{i % 3} " * (1 + i % 4)) for i in range(400)]
    corpus = spark.createDataFrame(rows, "id long, content string")
    queries = ["moteur", "moteur moteur", "moteur diesel1", "diesel1 moteur", "diesel2", "absent moteur"]
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")
    many = batch.batch_text_search(asked, corpus, 7).collect()
    for i, query in enumerate(queries):
        one = [(r["id"], r["rank"]) for r in search.text_search(corpus, query, k=7).collect()]
        got = sorted((r for r in many if r["query_id"] == i), key=lambda r: r["position"])
        assert [(r["id"], r["text_rank"]) for r in got] == one


def test_lists_over_mixed_lengths(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(60)] + [(100, [1.0]), (101, None), (102, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    path = work_path(spark, "ivf")
    assert ann.ivf_build(df, path, ann.learn_centres(df, 4)) == 3
    assert spark.read.parquet(f"{path}/lists").count() == 60


def test_lists_by_inner_product_prefer_long_centres(spark):
    rows = [(1, [10.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<double>")
    centres = spark.createDataFrame([(0, [10.0, 0.0]), (1, [1.0, 0.1]), (2, [0.0, 1.0])], "list_id int, centre array<double>")
    path = work_path(spark, "ivf")
    ann.ivf_build(df, path, centres, "inner_product")
    found = ann.ivf_search(spark, path, [1.0, 0.1], 1, 1, "inner_product").collect()
    assert [r["id"] for r in found] == [1]


def test_hybrid_search_is_one_lazy_plan(spark, folder):
    """Building it starts no job but that of the query's terms; run, it reads the texts once and shuffles no vectors."""
    texts = load(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    vectors = load(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), "embedding")
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    text.constant_terms(spark, "tion", "french")
    terms = len(status.getJobIdsForGroup("lazy"))
    found = search.hybrid_search(texts, "tion", [0.1] * 64, vectors)
    assert len(status.getJobIdsForGroup("lazy")) == 2 * terms
    assert found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and plan.count("TakeOrderedAndProject(limit=100") == 1
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert not any("Exchange hashpartitioning" in line and "embedding" in line and "Broadcast" in line for line in plan.split("\n"))


def test_sets_meet_texts_without_a_row_per_pair(spark):
    """Texts that all hold both terms: k rows a part reach Spark, not a row per text."""
    postings = spark.createDataFrame([(i, t, 1) for i in range(3000) for t in "ab"], "id long, _term string, _tf long")
    sets = spark.createDataFrame([("s", ["a", "b"])], "_set string, _terms array<string>")
    made = []
    real = batch._pairs
    batch._pairs = lambda *x: (made.append(real(*x)), made[-1])[1]
    try:
        found = batch._best_of_many(sets, postings, 10, "id").collect()
    finally:
        batch._pairs = real
    assert sorted((r["position"], r["id"], r["text_rank"]) for r in found) == [(i + 1, i, 0.5) for i in range(10)]
    assert sum(p.count() for p in made) <= 300


def test_best_of_many_over_parts_and_words_as_keys(spark):
    draw = np.random.default_rng(1)
    rows = [(f"é{i:04}", t, int(n)) for i in range(900) for t, n in zip("abcde", draw.poisson(draw.exponential(0.8), 5)) if n]
    postings = spark.createDataFrame([*rows, (None, "a", 9), (None, "b", 9)], "id string, _term string, _tf long")
    wanted = ["ab", "bc", "abc", "abcd", "abcde", "ce", "az"]
    sets = spark.createDataFrame([(s, list(s)) for s in wanted], "_set string, _terms array<string>")
    tf = {(i, t): n for i, t, n in rows}
    for options in ({}, {"part_rows": 90}, {"classes": 1, "part_rows": 200}):
        found = batch._best_of_many(sets, postings, 10, "id", **options).collect()
        for terms in wanted:
            ranks = [
                (-round(sum(tf[i, t] / (tf[i, t] + 1) for t in terms) / len(terms), 12), i)
                for i in {i for i, _ in tf} if all((i, t) in tf for t in terms)
            ]
            got = sorted((r for r in found if r["_set"] == terms), key=lambda r: r["position"])
            assert [(round(-r["text_rank"], 9), r["id"]) for r in got] == [(round(r, 9), i) for r, i in sorted(ranks)[:10]]


@pytest.mark.parametrize("metric", ["cosine", "l2", "inner_product"])
def test_queries_are_cut_together(metric, monkeypatch):
    """The number of sorts follows the blocks of queries and rows, not the queries."""
    draw = np.random.default_rng(2)
    queries, rows = draw.normal(size=(1500, 16)), draw.normal(size=(4000, 16))
    sorts = []
    real = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda *x, **y: (sorts.append(1), real(*x, **y))[1])
    nearest = kernels.Nearest(queries, 3, metric)
    nearest.add(np.arange(4000), rows)
    assert len(list(nearest.rows())) == 4500
    assert len(sorts) < 100


@pytest.mark.parametrize("metric", ["cosine", "l2", "inner_product"])
@pytest.mark.parametrize("scale, offset", [(1.0, 0.0), (1e-3, 1e3), (1e-30, 0.0), (1e30, 0.0), (1e-12, 1.0)])
def test_single_precision_loses_no_neighbour(metric, scale, offset):
    draw = np.random.default_rng(3)
    queries, rows = (offset + scale * draw.normal(size=(n, 8)) for n in (40, 3000))
    rows[::50] = rows[1]  # copies: ties fall to the smaller key
    rows[7], rows[8], queries[3] = np.nan, 0.0, rows[1]
    ids = draw.permutation(3000)
    nearest = kernels.Nearest(queries, 5, metric)
    for part in (slice(0, 1000), slice(1000, 1003), slice(1003, None)):
        nearest.add(ids[part], rows[part])
    found = {}
    for i, row, d in nearest.rows():
        found.setdefault(i, []).append((row, d))
    with np.errstate(invalid="ignore", over="ignore"):
        far = kernels.distances(rows, queries, metric)
    for i in range(len(queries)):
        got = [d for _, d in found[i]]
        some = np.flatnonzero(~np.isnan(far[i]))
        want = np.sort(far[i][some])[:5]
        assert np.allclose(got, want, rtol=1e-9, atol=2e-12)
    copies = sorted(ids[[1, *range(0, 3000, 50)]])[:5]
    if metric == "l2" and scale > 1e-20:  # below, all distances round to 0
        assert [row for row, _ in found[3]] == copies


def test_words_of_the_texts_are_not_shuffled(spark, folder):
    """What reads the texts writes a row per text, without an exchange."""
    texts = load(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    asked = spark.createDataFrame([(0, "ment tion"), (1, "elle pour tion")], "query_id int, query string")
    plans, real = [], batch.write_table
    batch.write_table = lambda df, *x, **o: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, *x, **o))[1]
    try:
        found = batch.batch_text_search(asked, texts, 5)
    finally:
        batch.write_table = real
    plans = [p.split("== Initial Plan ==")[0] for p in [*plans, found._jdf.queryExecution().executedPlan().toString()]]
    reading = [p for p in plans if "documents.parquet" in p]
    assert reading and not any("Exchange" in p for p in reading)


def test_batch_text_adds_up_texts_of_one_key(spark, monkeypatch):
    """Rows of one key, or of none, are one text; small blocks and parts lose nothing."""
    monkeypatch.setattr(batch, "MAX_SHARED_FORMS", 1)
    monkeypatch.setattr(batch, "MAX_SHARED_TERMS", 3)
    rows = [(1, "moteur panne"), (1, "Moteurs diesel"), (2, "diesel moteur diesel"), (3, None), (4, ""), (5, "panne"), (None, "moteur"), (None, "moteur")]
    texts = spark.createDataFrame(rows, "id long, content string")
    asked = spark.createDataFrame([(0, "moteur diesel"), (1, "moteur"), (2, "panne moteur")], "query_id int, query string")
    found = batch.batch_text_search(asked, texts, 10).collect()
    got = sorted((r["query_id"], r["position"], r["id"], round(r["text_rank"], 9)) for r in found)
    third, both = round(2 / 3, 9), round((2 / 3 + 1 / 2) / 2, 9)
    assert got[:2] == [(0, 1, 1, both), (0, 2, 2, both)]
    assert [r[2:] for r in got[2:5]] == [(None, third), (1, third), (2, 0.5)]
    assert got[5:] == [(2, 1, 1, both)]


def test_list_counts():
    lists = pa.array([["a", "as", "b"], None, [], ["x"], ["b", None, "b", "a"]])
    forms = [(pa.array(["a", "as"]), pa.array(["A", "A"])), (pa.array(["b", "c"]), pa.array(["B", "C"]))]
    places, codes, counts, terms = kernels.list_counts(lists, forms)
    got = sorted(zip(places.tolist(), terms.take(pa.array(codes)).to_pylist(), counts.tolist()))
    assert got == [(0, "A", 2), (0, "B", 1), (4, "A", 1), (4, "B", 2)]
    assert not len(kernels.list_counts(lists, [])[0]) and not len(kernels.list_counts(pa.array([None, []], pa.list_(pa.string())), forms)[0])
