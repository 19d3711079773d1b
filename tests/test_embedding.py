import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrail.operators import embedding as E
from vectrail.operators.tables import append_rows, append_with_embedding, new_rows
from vectrail.session import work_path
from vectrail.streaming.incremental import embed_new_rows, embedded_rows


def lengths(texts):
    return [[float(len(t)), 1.0] for t in texts]


def failing(texts):
    if any("bad" in t for t in texts):
        raise RuntimeError("model is down")
    return lengths(texts)


def test_default_model_edges(spark):
    rows = [(1, None), (2, "  \t"), (3, "un deux un"), (4, " un deux un\n"), (5, "!!")]
    df = spark.createDataFrame(rows, "id long, t string")
    got = {r["id"]: r["embedding"] for r in E.embed(df, "t", E.Embedder(16)).collect()}
    assert got[1] is None
    assert got[2] == [0.0] * 16 and got[5] == [0.0] * 16
    assert got[3] == got[4] and np.linalg.norm(got[3]) == pytest.approx(1.0)


def test_default_model_on_nothing_but_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id long, t string")
    assert [r["embedding"] for r in E.embed(df, "t", E.Embedder(4)).collect()] == [None, None]


def test_plug_in_model_failures_stay_null(spark):
    df = spark.createDataFrame([(1, "abc"), (2, "bad"), (3, ""), (4, None)], "id long, t string")
    got = {r["id"]: r["embedding"] for r in E.embed(df, "t", E.Embedder(2, failing)).collect()}
    assert got == {1: [3.0, 1.0], 2: None, 3: [0.0, 0.0], 4: None}


def test_reuse_asks_once_per_text(spark):
    asked = spark.sparkContext.accumulator(0)

    def counting(texts):
        asked.add(len(texts))
        return lengths(texts)

    rows = [(i, ["  x", "x ", "yy", None][i % 4]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, t string").repartition(8)
    done = E.embed_with_reuse(df, "t", E.Embedder(2, counting), "id", rows_per_task=50).collect()
    assert asked.value == 2
    assert len(done) == 400
    assert all((r["embedding"] is None) == (r["t"] is None) for r in done)


def news(spark):
    day = 86_400_000
    rows = [
        (1, "t", "old", None, 100 * day - 8 * day),
        (2, "t", "edge", None, 100 * day - 7 * day),
        (3, None, None, None, 100 * day - 2),
        (4, "t", "bad", None, 100 * day - 3),
        (5, "t", "x" * 9000, None, 100 * day - 4),
        (6, "t", "kept", [9.0, 9.0], 100 * day - 5),
    ]
    schema = "id long, title string, content string, embedding array<float>, timestamp_unix_ms long"
    return spark.createDataFrame(rows, schema), 100 * day


def test_backfill(spark):
    df, now = news(spark)
    done = E.backfill(df, E.Embedder(2, failing), now)
    got = {r["id"]: (r["backfill"], r["embedding"]) for r in done.collect()}
    assert got[1] == (None, None) and got[2] == (None, None)
    assert got[3] == ("embedded", [0.0, 0.0])  # blank title and content
    assert got[4] == ("failed", None)
    assert got[5] == ("embedded", [9003.0, 1.0])  # the whole text
    assert got[6] == (None, [9.0, 9.0])
    counts = E.backfill_counts(done).first()
    assert (counts["due"], counts["embedded"], counts["failed"]) == (3, 2, 1)


def test_backfill_newest_first(spark):
    df, now = news(spark)
    done = E.backfill(df, E.Embedder(2, lengths), now, limit=2)
    assert sorted(r["id"] for r in done.filter("backfill = 'embedded'").collect()) == [3, 4]
    assert done.count() == 6


def test_vectorise_rows(spark):
    df = spark.createDataFrame(
        [(1, "abc", None, None), (2, "a", "b", None), (3, "long text", "x", [7.0, 7.0])],
        "id long, a string, b string, embedding array<float>",
    )
    ids = spark.createDataFrame([(1,), (2,), (2,), (9,)], "id long")
    done = E.vectorise_rows(df, ids, ["a", "b"], E.Embedder(2, lengths)).orderBy("id").collect()
    assert [(r["id"], r["status"]) for r in done] == [(1, "too short"), (2, "too short"), (3, None)]
    ids = spark.createDataFrame([(3,)], "id long")
    again = E.vectorise_rows(df, ids, ["a", "b"], E.Embedder(2, lengths)).filter("id = 3").first()
    assert (again["status"], again["embedding"]) == ("vectorised", [11.0, 1.0])
    assert [r["id"] for r in E.missing_ids(df, spark.createDataFrame([(1,), (9,)], "id long")).collect()] == [9]


def test_dimension_agreement(spark):
    df = spark.createDataFrame([([1.0],), ([1.0, 2.0],), ([3.0],), (None,)], "v array<float>")
    rows = {r["dims"]: (r["n_rows"], r["agrees"]) for r in E.dimension_agreement(df, "v", 1).collect()}
    assert rows == {1: (2, True), 2: (1, False)}


def test_append_with_embedding(spark):
    base = spark.createDataFrame([(4, "old", [1.0, 1.0])], "id long, symbol string, embedding array<float>")
    new = spark.createDataFrame([(1, "ETH", "up"), (2, "BTC", None)], "item long, symbol string, note string")
    empty = F.lit(None).cast("string")
    source = E.record_text(F.col("note"), empty, F.col("symbol"), empty)
    rows = append_with_embedding(base, new, source, E.Embedder(2, lengths), extend=True).orderBy("id").collect()
    assert [(r["id"], r["symbol"]) for r in rows] == [(4, "old"), (5, "ETH"), (6, "BTC")]
    assert rows[1]["embedding"][0] == len("up | Symbol: ETH")
    assert rows[2]["embedding"][0] == len("Symbol: BTC")


@pytest.mark.parametrize("reuse", [False, True])
def test_new_rows_are_embedded_once(spark, reuse):
    source, target, progress = (work_path(spark, n) for n in ("in", "out", "progress"))
    schema = spark.createDataFrame([], "id long, t string").schema

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        embed_new_rows(
            spark, source, schema, target, progress, "t", E.Embedder(2, lengths), "id", reuse=reuse
        ).awaitTermination()

    arrive([(1, "a"), (2, "bb"), (3, "a")])
    arrive([(4, "cccc")])
    arrive([(5, None)])
    got = {r["id"]: r["embedding"] for r in embedded_rows(spark, target).collect()}
    assert got == {1: [1.0, 1.0], 2: [2.0, 1.0], 3: [1.0, 1.0], 4: [4.0, 1.0], 5: None}
    assert embedded_rows(spark, target).count() == 5


def test_failed_rows_are_named(spark):
    df = spark.createDataFrame(
        [(1, "good text", None), (2, "bad text", None), (3, "bad again", [7.0])], "id long, a string, embedding array<float>"
    )
    model = E.Embedder(1, lambda texts: [None if "bad" in t else [1.0] for t in texts])
    done = E.vectorise_rows(df, df.select("id"), ["a"], model).orderBy("id").collect()
    assert [(r["status"], r["embedding"]) for r in done] == [
        ("vectorised", [1.0]), ("failed", None), ("failed", [7.0])
    ]


def test_unknown_columns_are_not_dropped(spark):
    base = spark.createDataFrame([(4, "old")], "id long, symbol string")
    new = spark.createDataFrame([(1, "ETH", "x")], "item long, symbol string, note string")
    with pytest.raises(ValueError, match="note"):
        append_rows(base, new, order_by="item")
    rows = append_rows(base, new, order_by="item", extend=True).orderBy("id").collect()
    assert [(r["id"], r["symbol"], r["note"]) for r in rows] == [(4, "old", None), (5, "ETH", "x")]
    added = new_rows(base, new.drop("note"), order_by="item").collect()
    assert [(r["id"], r["symbol"]) for r in added] == [(5, "ETH")]


def test_whole_articles_are_embedded(spark):
    title, content = F.lit("t"), F.repeat(F.lit("x"), 20_000)
    row = spark.range(1).select(F.length(E.article_text(title, content)).alias("n")).first()
    assert row["n"] == 20_003


def test_known_texts_are_not_embedded_again(spark):
    df = spark.createDataFrame([(1, " a "), (2, "b"), (3, "a"), (4, None)], "id long, t string")
    known = spark.createDataFrame([("a", [9.0])], "t string, vector array<float>").select(
        E.text_digest(F.col("t")).alias("text_digest"), "vector"
    )
    done = E.embed_with_reuse(df, "t", E.Embedder(1, lambda texts: [[float(len(t))] for t in texts]), "id", known=known)
    assert {r["id"]: r["embedding"] for r in done.collect()} == {1: [9.0], 2: [1.0], 3: [9.0], 4: None}
    assert E.embedded_texts(done, "t", known=known).count() == 1


def test_a_text_of_an_earlier_batch_is_not_embedded_again(spark):
    source, target, progress = (work_path(spark, n) for n in ("in", "out", "progress"))
    schema = spark.createDataFrame([], "id long, t string").schema

    def chance(texts):
        import random

        return [[random.random()] for _ in texts]

    for rows in ([(1, "same"), (2, "other")], [(3, "same"), (4, "new")], [(5, "new")]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        embed_new_rows(
            spark, source, schema, target, progress, "t", E.Embedder(1, chance), "id", reuse=True
        ).awaitTermination()
    got = {r["id"]: r["embedding"] for r in embedded_rows(spark, target).collect()}
    assert len(got) == 5 and got[1] == got[3] and got[4] == got[5]
    assert len({tuple(v) for v in got.values()}) == 3


def test_known_texts_over_three_batches(spark):
    """A text is embedded in the first batch that holds it; later ones read its folder of the store only."""
    source, target, marks = (work_path(spark, n) for n in ("in", "out", "marks"))
    texts = [["one", "two", "three"], ["two", "four", "one"], ["five", "one", "four"]]

    def drawn(values):  # another vector at every call
        return [[float(x)] for x in np.random.default_rng().random(len(values))]

    schema = "id long, t string"
    for number, batch in enumerate(texts):
        rows = [(10 * number + i, t) for i, t in enumerate(batch)]
        spark.createDataFrame(rows, schema).repartition(1).write.mode("append").parquet(source)
        query = embed_new_rows(
            spark, source, spark.createDataFrame([], schema).schema, target, marks, "t", E.Embedder(1, drawn), "id", reuse=True
        )
        query.awaitTermination()
    rows = spark.read.schema("id long, t string, embedding array<float>, batch_id long").parquet(target).filter("t IS NOT NULL").collect()
    assert len(rows) == 9
    for t in {r["t"] for r in rows}:
        assert len({tuple(r["embedding"]) for r in rows if r["t"] == t}) == 1
    known = spark.read.schema("text_digest string, vector array<float>, batch_id long, prefix string").parquet(f"{target}/_known")
    assert known.groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 3), (1, 1), (2, 1)]
    asked = spark.createDataFrame([("one",)], "t string").select(E.text_digest(F.col("t")).alias("_digest"))
    found = E.known_of(known, asked)
    assert found.count() == 1
    scan = [line for line in found._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line and "prefix" in line]
    assert scan and all("PartitionFilters: [" in line and "prefix" in line.split("PartitionFilters")[1] for line in scan)


def test_no_word_reaches_python(spark):
    df = spark.createDataFrame([(1, "un deux")], "id long, t string")
    plan = E.embed(df, "t", E.Embedder(16))._jdf.queryExecution().executedPlan().toString()
    udf = next(line for line in plan.split("\n") if "ArrowEvalPython" in line)
    assert "array<float>" not in udf.split("udf(")[-1] and "md5" in plan


def test_codes_are_those_of_the_digests(spark):
    import hashlib

    words = ["un", "deux", "école", "x" * 500, "1"]
    row = spark.createDataFrame([(" -- ".join(words),)], "t string").select(E.text.word_codes(F.col("t"), 97).alias("c")).first()
    want = []
    for w in words:
        digest = hashlib.md5(w.encode()).digest()
        want.append(int.from_bytes(digest[:4], "big") % 97 * 2 + (digest[4] >= 128))
    assert list(row["c"]) == want


@pytest.mark.parametrize("name", ["r1_incremental_embedding", "r1_incremental_embedding_with_reuse"])
@pytest.mark.parametrize("files", [0, 2])
def test_the_stream_reads_a_table_of_one_or_many_files(spark, tmp_path, name, files):
    from vectrail.plans import QUERIES

    rows = [(1, "un deux", "fr", "a", 7), (2, "un deux", "fr", "a", 7), (3, None, "fr", "b", 0), (4, "drei", "de", "b", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(max(files, 1)).write.parquet(str(tmp_path / "documents.parquet"))
    if not files:  # the table is one file of that name
        (part,) = (tmp_path / "documents.parquet").glob("part-*.parquet")
        folder = tmp_path / "single"
        folder.mkdir()
        (folder / "documents.parquet").write_bytes(part.read_bytes())
    else:
        folder = tmp_path
    got = {r["doc_id"]: r["norm"] for r in QUERIES[name](spark, str(folder)).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: None, 4: 1.0}
