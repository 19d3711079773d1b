"""Connected components of a large graph by alternating star contraction.

After Kiveris et al., "Connected Components in MapReduce and Beyond" (2014).  Each
step sends the neighbours of a node to the smallest of them; the edges shrink to
stars within a few rounds.  Edges stay in tables, never on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrail.session import work_path
from vectrail.sources.tables import write_table


def _smallest(edges: DataFrame) -> DataFrame:
    # Minima per node are taken before the shuffle, so a hub is no hot key here.
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return (
        both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = _smallest(edges)
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) of every node that has an edge.

    Edges are pairs of bigint in any direction; loops, NULLs and repeated edges
    do no harm.  An empty table of edges gives no rows.
    """
    spark = edges.sparkSession
    one_way = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct()
    state = write_table(one_way, work_path(spark, "components"))
    seen = None
    for _ in range(max_rounds):
        state = write_table(_small_star(_large_star(state)), work_path(spark, "components"))
        now = state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1000003)).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("the components did not settle")
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
