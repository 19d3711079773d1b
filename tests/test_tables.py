from types import SimpleNamespace

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectrail.operators import guarded_sql, profile, skew, tables, workload
from vectrail.session import work_path
from vectrail.sources.tables import load, write_table


def test_create_is_idempotent(spark):
    path = work_path(spark, "made")
    first = tables.create_vector_table(spark, path, 3)
    second = tables.create_vector_table(spark, path, 9)
    assert first.columns == ["id", "embedding", "created_at"]
    assert second.schema["embedding"].metadata == {"vector_dim": 3}


def test_add_column_refuses_a_present_one(spark):
    df = spark.range(2)
    grown = tables.add_vector_column(df, "v", 3)
    assert grown.schema["v"].metadata["vector_dim"] == 3
    with pytest.raises(ValueError):
        tables.add_vector_column(grown, "v", 3)


def test_change_dimension(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "id int, v array<float>")
    nulled = tables.change_dimension(df, "v", 2, "null").orderBy("id").collect()
    assert [r["v"] for r in nulled] == [[1.0, 2.0], None, None]
    with pytest.raises(Exception, match="expected 2 dimensions"):
        tables.change_dimension(df, "v", 2).collect()
    assert tables.change_dimension(df.filter("id != 2"), "v", 2).count() == 2
    with pytest.raises(ValueError):
        tables.change_dimension(df, "v", 2, "pad")


@pytest.mark.parametrize("all_have_it", [True, False])
def test_optional_columns_need_every_item(spark, all_have_it):
    base = spark.createDataFrame([], "id long, embedding array<float>, content string, metadata string")
    other = "b" if all_have_it else None
    items = spark.createDataFrame(
        [(1, [1.0], "a", {"k": "v"}), (2, [2.0], other, {"k": "w"})],
        "item long, embedding array<float>, content string, metadata map<string,string>",
    )
    rows = tables.append_vectors(base, items).orderBy("id").collect()
    assert [r["id"] for r in rows] == [0, 1]
    assert [r["content"] for r in rows] == (["a", "b"] if all_have_it else [None, None])
    assert rows[0]["metadata"] == '{"k":"v"}'


def test_update_and_delete_with_null_predicate(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "id int, n int")
    updated = tables.update_where(df, "n > 5", {"n": F.lit(0)}).orderBy("id").collect()
    assert [r["n"] for r in updated] == [5, None, 0]
    kept = tables.delete_where(df, "n > 5").orderBy("id").collect()
    assert [r["id"] for r in kept] == [1, 2]
    counts = tables.affected(df, "n > 5").first()
    assert (counts["n_affected"], counts["n_remaining"]) == (1, 2)


def test_written_table_never_overwrites(spark):
    path = work_path(spark, "once")
    write_table(spark.range(3), path)
    with pytest.raises(Exception, match="already exists"):
        write_table(spark.range(4), path)
    assert spark.read.parquet(path).count() == 3


def test_shared_folder_is_used_when_named():
    def session(folder, master):
        conf = SimpleNamespace(get=lambda key, default: folder)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert work_path(session("hdfs://shared/", "yarn"), "x").startswith("hdfs://shared/x-")
    with pytest.raises(ValueError):
        work_path(session(None, "yarn"), "x")


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_numbers_are_dense_and_ordered(spark, buckets):
    # a third of the rows share one value of the order column
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id")).alias("n")
    )
    rows = skew.number_rows(df, "n", ["id"], 10, buckets).collect()
    ordered = [r["position"] for r in sorted(rows, key=lambda r: (r["n"], r["id"]))]
    assert ordered == list(range(10, 3010))


def test_hot_value_is_split_by_the_ties(spark):
    df = spark.range(5000).select("id", F.lit(1).alias("n"))
    numbered = skew.number_rows(df, "n", ["id"], buckets=10)
    stored = next(line for line in numbered.inputFiles())
    folder = stored.rsplit("/", 1)[0]
    sizes = spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()
    assert len(sizes) > 5 and max(r["count"] for r in sizes) < 1000


def test_numbering_holds_no_bounds_in_its_plan(spark):
    """The plan is as long for many rows as for few, and shuffles them once, before they are stored."""
    def plan(n, buckets):
        df = spark.range(n).select("id", (F.col("id") % 97).alias("n"))
        return skew.number_rows(df, "n", ["id"], buckets=buckets)._jdf.queryExecution().executedPlan().toString()

    few, many = plan(100, 2), plan(20_000, 64)
    assert abs(len(few) - len(many)) < 200 and "rangepartitioning" not in many


def test_hot_keys_are_split_and_nothing_is_lost(spark):
    big = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key")
    )
    small = big.groupBy("key").agg(F.count("*").alias("n")).withColumn("v", F.upper("key"))
    joined = skew.salted_lookup(big, small, "key", "n", "id", rows_per_task=100)
    assert joined.count() == 9000
    assert joined.filter("v != upper(key) or v is null").count() == 0


@pytest.mark.parametrize("rows_per_key", [1_000_000, 350, 1])
def test_running_windows_equal_plain_windows(spark, folder, rows_per_key):
    events = load(spark, folder, "events").select(
        "event_id", "ts", "value", F.nullif(F.col("user_id") % 3, F.lit(2)).alias("user")
    )
    done = skew.running_windows(events, "user", ["ts", "event_id"], "value", F.to_date("ts"), rows_per_key)
    w = W.partitionBy("user").orderBy("ts", "event_id")
    plain = events.select(
        "event_id",
        F.row_number().over(w).alias("p"),
        F.sum("value").over(w.rowsBetween(W.unboundedPreceding, 0)).alias("t"),
        F.lag("value").over(w).alias("l"),
    )
    both = done.join(plain, "event_id")
    assert both.count() == events.count()
    wrong = both.filter(
        (F.col("p") != F.col("position"))
        | (F.abs(F.col("t") - F.col("running_total")) > 1e-6)
        | ~F.col("l").eqNullSafe(F.col("previous"))
    )
    assert wrong.count() == 0


def test_sliced_ranks_and_frames_equal_plain_windows(spark):
    # a third of the rows share one key, and many share one value
    df = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"),
        (F.col("id") * 7 % 100).alias("n"),
    )
    band = F.floor(F.col("n") / 10)
    w = W.partitionBy("k").orderBy("n")
    ranked = skew.sliced_ranks(df, "k", ["n"], band)
    plain = df.select("id", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"))
    both = ranked.join(plain, "id")
    assert both.count() == 3000
    assert both.filter("r != rank or d != dense_rank").count() == 0
    exact = W.partitionBy("k").orderBy("n", "id")
    plain = df.select("id", F.avg("n").over(exact.rowsBetween(-2, 0)).alias("m"))
    for most in (1_000_000, 500):  # no hot key, one
        placed = skew.running_windows(df, "k", ["n", "id"], "n", band, most)
        framed = skew.framed_mean(placed, "k", "position", "n", 2, rows_per_key=most)
        both = framed.join(plain, "id")
        assert both.count() == 3000
        assert both.filter("abs(m - mean) > 1e-9").count() == 0


def test_ordinary_keys_take_one_exchange(spark):
    df = spark.range(300).select("id", (F.col("id") % 7).alias("k"), (F.col("id") * 3 % 50).alias("n"))
    done = skew.running_windows(df, "k", ["n", "id"], "n", F.col("n"))
    assert done._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_numbers_follow_the_rows(spark):
    df = spark.range(2500).select("id", (F.col("id") % 11).alias("n"))
    rows = skew.number_rows(df, "n", ["id"]).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(1, 2501))
    assert [(r["n"], r["id"]) for r in rows] == sorted((r["n"], r["id"]) for r in rows)


def test_expected_length_comes_from_the_data(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 3.0],), ([1.0, 2.0, 3.0],)], "v array<double>")
    row = profile.validate_vectors(df, "v").first()
    assert (row["n_wrong_dims"], row["n_lengths"], row["compatible"]) == (1, 2, False)


def test_the_filter_on_time_reaches_the_scan(spark, folder):
    from vectrail.plans import QUERIES

    plan = QUERIES["c4_recent_rows"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan


def test_profile_of_nulls_and_sketch(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "a")], "n int, s string")
    rows = {r["column_name"]: r for r in profile.table_profile({"t": df}).collect()}
    assert (rows["n"]["n_distinct"], rows["s"]["n_null"], rows["s"]["n_distinct"]) == (2, 1, 1)
    assert profile.table_overview(profile.table_profile({"t": df})).first()["n_columns"] == 2


def test_diagnose_finds_faults(spark):
    df = spark.createDataFrame([(1, [1.0], "a"), (2, None, "b")], "id int, embedding array<float>, content string")
    rows = {r["check"]: r for r in profile.diagnose(df).collect()}
    assert not rows["null vectors"]["ok"] and rows["null vectors"]["detail"] == "1"
    assert rows["support columns"]["detail"] == "content, id"
    with pytest.raises(ValueError):
        profile.diagnose(None)


def test_ratio_edges(spark):
    df = spark.createDataFrame([("a", 0, 0), ("b", 9, 1), ("c", 8, 2)], "t string, live long, dead long")
    rows = workload.stale_ratio(df, "t", min_dead=None).collect()
    assert [(r["t"], r["dead_pct"]) for r in rows] == [("c", 20.0)]
    every = workload.stale_ratio(df, "t", min_dead=None, min_share=None).collect()
    assert [r["t"] for r in every] == ["c", "b", "a"]
    none = spark.createDataFrame([(0, 0)], "r long, h long")
    row = workload.hit_ratio(none, [("x", "r", "h")]).first()
    assert row["x_ratio"] is None and row["x_below"] is False


def test_slow_statements_floor_and_order(spark):
    log = [("a", 1.0)] * 5 + [("b", 9.0)] * 4 + [("c", 2.0)] * 6
    df = spark.createDataFrame(log, "statement string, ms double")
    assert [r["statement"] for r in workload.slow_statements(df).collect()] == ["c", "a"]
    with pytest.raises(ValueError):
        workload.slow_statements(df, order_by="rows")


REFUSED = [
    "INSERT INTO t VALUES (1)",
    "update t set a = 1",
    "DELETE FROM t",
    "drop table t",
    "CREATE TABLE t (a int)",
    "Alter table t add column b int",
    "TRUNCATE TABLE t",
    "SELECT 'please delete me'",
    "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x",
    "SET a = 1",
    "",
]


@pytest.mark.parametrize("sql", REFUSED)
def test_refused_statements(spark, sql):
    with pytest.raises(guarded_sql.RefusedStatement):
        guarded_sql.run_sql(spark, sql)


@pytest.mark.parametrize(
    "sql, rows",
    [
        ("SELECT id FROM range(500)", 100),
        ("select id from range(500);", 100),
        ("SELECT id FROM range(500) LIMIT 300", 300),
        ("SELECT id AS credit_limit FROM range(500)", 100),
        ("SELECT id AS updated_at FROM range(5)", 5),
        ("WITH x AS (SELECT id FROM range(500)) SELECT * FROM x", 100),
        ("VALUES (1), (2)", 2),
        ("EXPLAIN SELECT 1", 1),
    ],
)
def test_automatic_limit(spark, sql, rows):
    assert guarded_sql.run_sql(spark, sql).count() == rows


def test_exact_profile_by_digests(spark):
    """Counts by value, of NULLs, equal zeros, NaN, nested values and an empty table; no Expand."""
    rows = [(1, 0.0, "a", [1]), (1, -0.0, None, [1]), (2, float("nan"), "a", None), (None, float("nan"), "", [2])]
    df = spark.createDataFrame(rows, "i int, d double, s string, `odd name` array<int>")
    found = profile.table_profile({"t": df}, "exact")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "partial_count" in plan
    got = {r["column_name"]: (r["n_rows"], r["n_filled"], r["n_null"], r["n_distinct"]) for r in found.collect()}
    assert got == {"i": (4, 3, 1, 2), "d": (4, 4, 0, 2), "s": (4, 3, 1, 2), "odd name": (4, 3, 1, 2)}
    empty = profile.table_profile({"t": df.limit(0)}, "exact").collect()
    assert [(r["position"], r["n_rows"], r["n_distinct"]) for r in empty] == [(i, 0, 0) for i in range(1, 5)]


def test_profile_from_stored_sketches_reads_new_files_only(spark):
    path, store = work_path(spark, "sketched"), work_path(spark, "sketches")
    df = spark.range(3000).select("id", (F.col("id") % 40).alias("k"), F.when(F.col("id") % 3 > 0, F.lit("x")).alias("s"))
    df.filter("id < 2000").repartition(2).write.parquet(path)
    assert profile.sketch_files(spark, path, store) == 2
    df.filter("id >= 2000").repartition(1).write.mode("append").parquet(path)
    assert profile.sketch_files(spark, path, store) == 1
    assert profile.sketch_files(spark, path, store) == 0
    got = {r["column_name"]: r for r in profile.profile_of_sketches(spark, store, "t").collect()}
    assert {c: (r["n_rows"], r["n_null"]) for c, r in got.items()} == {"id": (3000, 0), "k": (3000, 0), "s": (3000, 1000)}
    assert got["k"]["n_distinct"] == 40 and got["s"]["n_distinct"] == 1 and abs(got["id"]["n_distinct"] - 3000) < 90
