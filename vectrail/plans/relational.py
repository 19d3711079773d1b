"""Queries over predicates, joins, aggregates, windows, sorts, sets and guarded SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectrail.functions.time import epoch_ms, recent_times
from vectrail.operators.guarded_sql import run_sql
from vectrail.operators.skew import (
    framed_mean,
    running_windows,
    sliced_ranks,
    sliced_running,
    top_per_group,
    windowed,
)
from vectrail.plans.registry import longs, query, tidy, tidy_sql
from vectrail.sources.tables import load

AS_OF_MS = 1_706_659_200_000  # 2024-01-31 00:00:00 UTC


# ----------------------------------------------------- projections, predicates


@query(
    "c1_computed_column",
    "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge FROM lineitem",
)
def computed_column(spark, folder):
    charge = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    return load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", charge.alias("charge")
    )


@query(
    "c2_text_predicate",
    "SELECT vec_id, label FROM embeddings WHERE label = 3 AND vec_id > 20",
)
def text_predicate(spark, folder):
    rows = load(spark, folder, "embeddings").filter(F.expr("label = 3 AND vec_id > 20"))
    return rows.select("vec_id", "label")


@query(
    "c3_null_tests",
    """
    SELECT doc_id, embedding IS NULL AS missing FROM documents LEFT JOIN embeddings ON doc_id = vec_id
    WHERE lang IS NOT NULL
    """,
)
def null_tests(spark, folder):
    vectors = load(spark, folder, "embeddings").withColumnRenamed("vec_id", "doc_id")
    both = load(spark, folder, "documents").join(vectors, "doc_id", "left")
    return both.filter(F.col("lang").isNotNull()).select(
        "doc_id", F.col("embedding").isNull().alias("missing")
    )


@query(
    "c4_recent_rows",
    f"SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events WHERE epoch_us(ts) // 1000 > {AS_OF_MS} - 7 * 86400000",
)
def recent_rows(spark, folder):
    events = load(spark, folder, "events").withColumn("ms", epoch_ms(F.col("ts")))
    return events.filter(recent_times(F.col("ts"), AS_OF_MS, 7)).select("event_id", "ms")


@query(
    "c5_contains_any_case",
    "SELECT doc_id FROM documents WHERE text ILIKE '%TION_de%'",
)
def contains_any_case(spark, folder):
    return load(spark, folder, "documents").filter(F.col("text").ilike("%TION_de%")).select("doc_id")


@query(
    "c6_like_and_not_like",
    "SELECT page_id, url FROM pages WHERE html LIKE '%</title>%' AND url NOT LIKE '%.net/%'",
)
def like_and_not_like(spark, folder):
    pages = load(spark, folder, "pages")
    kept = pages.filter(F.col("html").like("%</title>%") & ~F.col("url").like("%.net/%"))
    return kept.select("page_id", "url")


@query(
    "c7_in_and_not_in",
    """
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey NOT IN (1, 2, 3)
    """,
)
def in_and_not_in(spark, folder):
    kept = load(spark, folder, "customer").filter(
        F.col("c_mktsegment").isin("BUILDING", "MACHINERY") & ~F.col("c_nationkey").isin(1, 2, 3)
    )
    return kept.select("c_custkey", "c_mktsegment")


@query(
    "c8_between_and_logic",
    """
    SELECT p_partkey FROM part
    WHERE (p_size BETWEEN 5 AND 20 AND NOT p_type = 'SMALL')
       OR ((p_retailprice > 950) <> (p_brand = 'Brand#2'))
    """,
)
def between_and_logic(spark, folder):
    size = F.col("p_size").between(5, 20) & ~(F.col("p_type") == "SMALL")
    either = (F.col("p_retailprice") > 950) != (F.col("p_brand") == "Brand#2")
    return load(spark, folder, "part").filter(size | either).select("p_partkey")


@query(
    "c9_case_when",
    """
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class,
           if(p_retailprice > 1000, 'dear', 'cheap') AS price_class FROM part
    """,
)
def case_when(spark, folder):
    size = (
        F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "medium").otherwise("large")
    )
    return load(spark, folder, "part").select(
        "p_partkey",
        size.alias("size_class"),
        F.expr("if(p_retailprice > 1000, 'dear', 'cheap')").alias("price_class"),
    )


@query(
    "c10_exists_as_value",
    """
    SELECT EXISTS (SELECT 1 FROM orders WHERE o_totalprice > 400000) AS some_large,
           EXISTS (SELECT 1 FROM orders WHERE o_totalprice < 0) AS some_negative
    """,
)
def exists_as_value(spark, folder):
    price = F.col("o_totalprice")
    return load(spark, folder, "orders").agg(
        (F.count_if(price > 400000) > 0).alias("some_large"),
        (F.count_if(price < 0) > 0).alias("some_negative"),
    )


@query(
    "c11_null_handling",
    """
    SELECT doc_id, coalesce(quality, -1)::BIGINT AS quality, nullif(lang, 'en') AS other_lang,
           greatest(n_chars, 1000) AS at_least FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def null_handling(spark, folder):
    both = load(spark, folder, "documents").join(load(spark, folder, "labels"), "doc_id", "left")
    return both.select(
        "doc_id",
        F.coalesce("quality", F.lit(-1)).cast("long").alias("quality"),
        F.nullif("lang", F.lit("en")).alias("other_lang"),
        F.greatest("n_chars", F.lit(1000).cast("long")).alias("at_least"),
    )


# ----------------------------------------------------------------------- joins


@query(
    "d1_inner_join",
    """
    SELECT l_orderkey, l_linenumber, o_custkey, o_orderstatus
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND l_shipdate >= o_orderdate
    """,
)
def inner_join(spark, folder):
    lines, orders = load(spark, folder, "lineitem"), load(spark, folder, "orders")
    on = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") >= F.col("o_orderdate"))
    return lines.join(orders, on).select("l_orderkey", "l_linenumber", "o_custkey", "o_orderstatus")


@query(
    "d1_inner_join_two_keys",
    """
    SELECT c_nationkey, s_nationkey, count(*) AS n
    FROM (SELECT l_suppkey, o_custkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    JOIN customer ON c_custkey = o_custkey
    JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey = c_nationkey
    GROUP BY c_nationkey, s_nationkey
    """,
)
def inner_join_two_keys(spark, folder):
    lines, orders = load(spark, folder, "lineitem"), load(spark, folder, "orders")
    customers, suppliers = load(spark, folder, "customer"), load(spark, folder, "supplier")
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customers, F.col("c_custkey") == F.col("o_custkey")
    )
    near = (F.col("s_suppkey") == F.col("l_suppkey")) & (
        F.col("s_nationkey") == F.col("c_nationkey")
    )
    return sold.join(suppliers, near).groupBy("c_nationkey", "s_nationkey").agg(
        F.count("*").alias("n")
    )


@query(
    "d2_three_way_join",
    f"""
    SELECT r_name, n_name, count(*) AS n_customers, {tidy_sql('sum(c_acctbal)', 2)} AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name, n_name
    """,
)
def three_way_join(spark, folder):
    customers, nations = load(spark, folder, "customer"), load(spark, folder, "nation")
    regions = load(spark, folder, "region")
    # Sums per nation first: the joins then carry a handful of rows.
    per_nation = customers.groupBy("c_nationkey").agg(
        F.count("*").alias("n_customers"), F.sum("c_acctbal").alias("balance")
    )
    return (
        per_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", "n_name")
        .agg(
            F.sum("n_customers").alias("n_customers"),
            tidy(F.sum("balance"), 2).alias("balance"),
        )
    )


@query(
    "d4_left_join",
    "SELECT doc_id, lang, quality FROM documents LEFT JOIN labels USING (doc_id)",
)
def left_join(spark, folder):
    docs, labels = load(spark, folder, "documents"), load(spark, folder, "labels")
    return docs.join(labels, "doc_id", "left").select("doc_id", "lang", "quality")


@query(
    "d4_right_join",
    "SELECT vec_id, label, lang FROM documents RIGHT JOIN embeddings ON doc_id = vec_id",
)
def right_join(spark, folder):
    docs, vectors = load(spark, folder, "documents"), load(spark, folder, "embeddings")
    return docs.join(vectors, F.col("doc_id") == F.col("vec_id"), "right").select(
        "vec_id", "label", "lang"
    )


@query(
    "d4_full_join",
    """
    SELECT doc_id, n_chars, item_id, len(b.text)::BIGINT AS item_chars
    FROM documents FULL JOIN benchmark b ON doc_id = item_id * 50
    """,
)
def full_join(spark, folder):
    docs = load(spark, folder, "documents").select("doc_id", "n_chars")
    items = load(spark, folder, "benchmark").select(
        "item_id", F.char_length("text").cast("long").alias("item_chars")
    )
    return docs.join(items, F.col("doc_id") == F.col("item_id") * 50, "full")


@query(
    "d5_semi_join",
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 450000)",
)
def semi_join(spark, folder):
    large = load(spark, folder, "orders").filter(F.col("o_totalprice") > 450000)
    customers = load(spark, folder, "customer")
    return customers.join(large, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select(
        "c_custkey", "c_name"
    )


@query(
    "d5_anti_join",
    "SELECT doc_id, source FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)",
)
def anti_join(spark, folder):
    docs, labels = load(spark, folder, "documents"), load(spark, folder, "labels")
    return docs.join(labels, "doc_id", "left_anti").select("doc_id", "source")


@query(
    "d7_subqueries",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.5 FROM orders)
      AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    """,
)
def subqueries(spark, folder):
    for name in ("orders", "customer"):
        load(spark, folder, name).createOrReplaceTempView(f"vectrail_{name}")
    return spark.sql(
        """
        SELECT o_orderkey, o_totalprice FROM vectrail_orders
        WHERE o_totalprice > (SELECT avg(o_totalprice) * 1.5 FROM vectrail_orders)
          AND o_custkey IN (SELECT c_custkey FROM vectrail_customer WHERE c_acctbal < 0)
        """
    )


# ------------------------------------------------------------------ aggregates


@query(
    "e1_counts",
    """
    SELECT count(*) AS n_rows, count(quality) AS n_filled, count(*) - count(quality) AS n_null
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def counts(spark, folder):
    both = load(spark, folder, "documents").join(load(spark, folder, "labels"), "doc_id", "left")
    return both.agg(
        F.count("*").alias("n_rows"),
        F.count("quality").alias("n_filled"),
        (F.count("*") - F.count("quality")).alias("n_null"),
    )


@query(
    "e2_group_by",
    f"""
    SELECT l_returnflag, l_linestatus, count(*) AS n, {tidy_sql('sum(l_quantity)', 2)} AS sum_qty,
           {tidy_sql('sum(l_extendedprice * (1 - l_discount))', 2)} AS revenue,
           {tidy_sql('avg(l_discount)')} AS avg_discount, min(l_extendedprice) AS min_price,
           max(l_extendedprice) AS max_price
    FROM lineitem GROUP BY l_returnflag, l_linestatus
    """,
)
def group_by(spark, folder):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        load(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("n"),
            tidy(F.sum("l_quantity"), 2).alias("sum_qty"),
            tidy(F.sum(net), 2).alias("revenue"),
            tidy(F.avg("l_discount")).alias("avg_discount"),
            F.min("l_extendedprice").alias("min_price"),
            F.max("l_extendedprice").alias("max_price"),
        )
    )


@query(
    "e3_having",
    f"""
    SELECT o_custkey, count(*) AS n_orders, {tidy_sql('sum(o_totalprice)', 2)} AS total
    FROM orders GROUP BY o_custkey HAVING count(*) >= 12
    """,
)
def having(spark, folder):
    return (
        load(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.count("*").alias("n_orders"), tidy(F.sum("o_totalprice"), 2).alias("total"))
        .filter(F.col("n_orders") >= 12)
    )


@query(
    "e4_guarded_ratio",
    f"""
    SELECT l_suppkey, {tidy_sql("sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / nullif(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END), 0)")} AS ratio
    FROM lineitem GROUP BY l_suppkey
    """,
)
def guarded_ratio(spark, folder):
    returned = F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(0.0))
    final = F.sum(F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).otherwise(0.0))
    return load(spark, folder, "lineitem").groupBy("l_suppkey").agg(
        tidy(F.try_divide(returned, final)).alias("ratio")
    )


@query(
    "e5_joined_members",
    """
    SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types FROM part GROUP BY p_brand
    """,
)
def joined_members(spark, folder):
    # Distinct members first, so the text of a group holds each of them once.
    members = load(spark, folder, "part").select("p_brand", "p_type").distinct()
    return members.groupBy("p_brand").agg(
        F.array_join(F.sort_array(F.collect_list("p_type")), ",").alias("types")
    )


@query(
    "e5_first_members",
    """
    SELECT c_nationkey, string_agg(c_name, ', ' ORDER BY c_custkey) AS names
    FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS p FROM customer)
    WHERE p <= 3 GROUP BY c_nationkey
    """,
)
def first_members(spark, folder):
    # Three rows per group are left before any list is built.
    few = top_per_group(
        load(spark, folder, "customer"), ["c_nationkey"], [F.col("c_custkey").asc()], 3
    )
    ordered = F.sort_array(F.collect_list(F.struct("position", "c_name")))
    return few.groupBy("c_nationkey").agg(
        F.array_join(ordered.getField("c_name"), ", ").alias("names")
    )


@query(
    "e6_distinct_rows",
    "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders",
)
def distinct_rows(spark, folder):
    return load(spark, folder, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@query(
    "e6_distinct_dimensions",
    """
    SELECT lang, count(DISTINCT n_words) AS n_lengths, min(n_words) AS shortest, max(n_words) AS longest
    FROM (SELECT lang, len(string_split(text, ' '))::BIGINT AS n_words FROM documents) GROUP BY lang
    """,
)
def distinct_dimensions(spark, folder):
    n = F.size(F.split("text", " ", -1)).cast("long")
    return (
        load(spark, folder, "documents")
        .select("lang", n.alias("n_words"))
        .groupBy("lang")
        .agg(
            F.count_distinct("n_words").alias("n_lengths"),
            F.min("n_words").alias("shortest"),
            F.max("n_words").alias("longest"),
        )
    )


@query(
    "e7_spread_per_statement",
    f"""
    SELECT event_type, {tidy_sql('avg(value)')} AS mean_ms, max(value) AS max_ms,
           {tidy_sql('stddev_pop(value)')} AS stddev_ms, {tidy_sql('sum(value)', 2)} AS total_ms, count(*) AS calls
    FROM events GROUP BY event_type
    """,
)
def spread_per_statement(spark, folder):
    return (
        load(spark, folder, "events")
        .groupBy("event_type")
        .agg(
            tidy(F.avg("value")).alias("mean_ms"),
            F.max("value").alias("max_ms"),
            tidy(F.stddev_pop("value")).alias("stddev_ms"),
            tidy(F.sum("value"), 2).alias("total_ms"),
            F.count("*").alias("calls"),
        )
    )


# --------------------------------------------------------------------- windows


@query(
    "w3_running_windows",
    f"""
    SELECT event_id, user_id,
           row_number() OVER w AS position, {tidy_sql('sum(value) OVER w', 4)} AS running_total,
           lag(value) OVER w AS previous
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    """,
)
def running(spark, folder):
    events = load(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    day = F.to_date("ts")
    done = running_windows(events, "user_id", ["ts", "event_id"], "value", day)
    return longs(
        done.select(
            "event_id", "user_id", "position", tidy(F.col("running_total"), 4).alias("running_total"),
            "previous",
        ),
        ["position"],
    )


def _plain_ranks(orders):
    by_price = W.partitionBy("o_custkey").orderBy("by_price")
    in_turn = W.partitionBy("o_custkey").orderBy("by_price", "o_orderkey")
    return orders.select(
        "o_orderkey",
        F.rank().over(by_price).cast("long").alias("rank"),
        F.dense_rank().over(by_price).cast("long").alias("dense_rank"),
        F.lead("o_orderkey").over(in_turn).alias("next_order"),
    )


def _sliced_ranks(orders):
    # Bands of the price keep a customer with very many orders out of one task.
    band = F.floor(F.col("by_price") / 25_000)
    placed = sliced_running(orders, "o_custkey", ["by_price", "o_orderkey"], "by_price", band)
    following = placed.select(
        "o_custkey",
        (F.col("position") - 1).alias("position"),
        F.col("o_orderkey").alias("next_order"),
    )
    chained = placed.join(following, ["o_custkey", "position"], "left").select(
        "o_custkey", "o_orderkey", "by_price", "next_order"
    )
    ranked = sliced_ranks(chained, "o_custkey", ["by_price"], band)
    return ranked.select(
        "o_orderkey", F.col("rank").cast("long").alias("rank"), F.col("dense_rank").cast("long").alias("dense_rank"), "next_order"
    )


@query(
    "w3_ranks_per_customer",
    """
    SELECT o_orderkey, rank() OVER w AS price_rank, dense_rank() OVER w AS price_dense_rank,
           lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS next_order
    FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC)
    """,
)
def ranks_per_customer(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", (-F.col("o_totalprice")).alias("by_price")
    )
    ranked = windowed(orders, "o_custkey", _plain_ranks, _sliced_ranks)
    return longs(
        ranked.select(
            "o_orderkey",
            F.col("rank").alias("price_rank"),
            F.col("dense_rank").alias("price_dense_rank"),
            "next_order",
        ),
        ["price_rank", "price_dense_rank"],
    )


@query(
    "w3_framed_average",
    f"""
    SELECT o_orderkey, {tidy_sql('avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 4)} AS recent_average
    FROM orders
    """,
)
def framed_average(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"
    )
    month = F.trunc("o_orderdate", "month")
    placed = running_windows(
        orders, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", month
    )
    framed = framed_mean(placed, "o_custkey", "position", "o_totalprice", 2)
    return framed.select("o_orderkey", tidy(F.col("mean"), 4).alias("recent_average"))


# -------------------------------------------------------------- sorts and sets


@query(
    "o1_top_k_ascending",
    "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice, p_partkey LIMIT 25",
)
def top_k_ascending(spark, folder):
    parts = load(spark, folder, "part").select("p_partkey", "p_retailprice")
    return parts.orderBy(F.asc_nulls_last("p_retailprice"), "p_partkey").limit(25)


@query(
    "o2_top_k_descending",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def top_k_descending(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(
    "o4_sort_by_expression",
    """
    SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem
    ORDER BY l_returnflag ASC, l_quantity / greatest(l_extendedprice, 1) DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 50
    """,
)
def sort_by_expression(spark, folder):
    share = F.col("l_quantity") / F.greatest(F.col("l_extendedprice"), F.lit(1.0))
    lines = load(spark, folder, "lineitem")
    ordered = lines.orderBy(
        F.asc("l_returnflag"), share.desc(), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )
    return ordered.limit(50).select("l_orderkey", "l_linenumber", "l_returnflag")


@query(
    "o6_offset",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 100 OFFSET 1000",
)
def offset(spark, folder):
    lines = load(spark, folder, "lineitem")
    ordered = lines.orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return ordered.offset(1000).limit(100).select("l_orderkey", "l_linenumber", "l_partkey")


_PARTIES_SQL = """
    SELECT c_nationkey AS nation, 'customer' AS kind FROM customer
    {union} SELECT s_nationkey, 'supplier' FROM supplier
"""


def _parties(spark, folder):
    customers = load(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nation"), F.lit("customer").alias("kind")
    )
    suppliers = load(spark, folder, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind")
    )
    return customers, suppliers


@query("s1_union_all", _PARTIES_SQL.format(union="UNION ALL"))
def union_all(spark, folder):
    customers, suppliers = _parties(spark, folder)
    return customers.unionByName(suppliers)


@query("s2_union_distinct", _PARTIES_SQL.format(union="UNION"))
def union_distinct(spark, folder):
    customers, suppliers = _parties(spark, folder)
    return customers.unionByName(suppliers).distinct()


# ----------------------------------------------------------------- guarded sql


def _views(spark, folder, *names):
    for name in names:
        load(spark, folder, name).createOrReplaceTempView(f"vectrail_{name}")


_GUARDED = """
    WITH big AS (
        SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM {p}orders GROUP BY o_custkey),
    placed AS (
        SELECT c_nationkey, o_custkey, n, top,
               row_number() OVER (PARTITION BY c_nationkey ORDER BY top DESC, o_custkey) AS place
        FROM big JOIN {p}customer ON o_custkey = c_custkey)
    SELECT c_nationkey, o_custkey, n, top FROM placed WHERE place = 1
    UNION ALL
    SELECT c_nationkey, o_custkey, n, top FROM placed WHERE place = 2
"""


@query("f0_guarded_sql", _GUARDED.format(p=""))
def guarded_sql(spark, folder):
    _views(spark, folder, "orders", "customer")
    return run_sql(spark, _GUARDED.format(p="vectrail_"))


@query(
    "f0_grouping_sets",
    """
    SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem
    GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())
    """,
)
def grouping_sets(spark, folder):
    _views(spark, folder, "lineitem")
    return run_sql(
        spark,
        """
        SELECT l_returnflag, l_linestatus, count(*) AS n FROM vectrail_lineitem
        GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ());
        """,
    )


@query(
    "o5_automatic_limit",
    "SELECT o_orderkey, o_totalprice AS credit_limit FROM orders ORDER BY o_orderkey LIMIT 100",
)
def automatic_limit(spark, folder):
    # A column named credit_limit is no LIMIT, so the automatic one applies.
    _views(spark, folder, "orders")
    return run_sql(
        spark,
        "SELECT o_orderkey, o_totalprice AS credit_limit FROM vectrail_orders ORDER BY o_orderkey;",
    )


@query(
    "o5_own_limit_kept",
    "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 250",
)
def own_limit(spark, folder):
    _views(spark, folder, "orders")
    return run_sql(spark, "SELECT o_orderkey FROM vectrail_orders ORDER BY o_orderkey LIMIT 250")
