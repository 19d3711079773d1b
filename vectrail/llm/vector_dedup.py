"""Near-dedup of vectors: all links of a group, found block against block.

Distinct vectors of a large group are dealt to cells by their nearest pivot, and cells are
cut into blocks.  A vector is within range of another only if its angle to that one's
pivot is at most the cell's radius plus the range, so it meets only the blocks that
this bound leaves.  Every pair of blocks is compared in one task, in double precision; counts
per vector and contracted links leave it, never the pairs.

``shards``, ``links`` and ``audit`` search a robust-pruned flat graph instead, which finds
most links only; ``near_duplicates`` does not use them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectrail.llm.components import connected_components
from vectrail.session import work_path
from vectrail.sources.tables import write_table

SHARD_ROWS = 3000  # a larger shard is cut further
NEAREST = 32  # candidates of a neighbour list that are near
RANDOM = 8  # and that are not
DEGREE = 16  # neighbours kept by the pruning
ALPHA = 1.2  # how much nearer a kept neighbour must be to rule another out
BLOCK = 256  # queries that are searched side by side
PIVOTS = 256  # at most, for all groups together
BLOCK_VALUES = 1 << 20  # components of all vectors of a block
ROUNDING = 1e-4  # of angles, which are kept as floats


def usable(vector: Column) -> Column:
    """Not NULL or empty, all components finite, not all of them zero."""
    def finite(x: Column) -> Column:
        return F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x.cast("double"))

    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(table: pa.Table) -> np.ndarray:
    column = table.column("_v").combine_chunks()
    dims = len(column[0]) if len(column) else 0
    raw = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dims)
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)  # no overflow in the squares
    return raw / np.sqrt((raw**2).sum(axis=1, keepdims=True))


def shards(vectors: DataFrame, shard_rows: int = SHARD_ROWS, overlap: int = 2, max_levels: int = 12) -> DataFrame:
    """``_id``, ``_v``, ``_n`` and ``_shard``: every vector in the shards of its nearest pivots.

    ``vectors`` has ``_group``, ``_id``, ``_v``, ``_n``; groups are never mixed.  A shard
    with more than ``shard_rows`` rows is cut around pivots drawn from it by a hash, and a
    vector goes to the ``overlap`` nearest of them, level by level until all shards are
    small.  (A shard that would not get smaller is left whole; equal vectors, the
    usual reason, are one row here.)
    """
    spark = vectors.sparkSession
    rows = vectors.select("_id", "_v", "_n", F.xxhash64("_group", F.size("_v")).alias("_shard"))
    rows = write_table(rows, work_path(spark, "vector-shards"))
    done = None
    before = None
    for level in range(max_levels):
        sizes = rows.groupBy("_shard").agg(F.count("*").alias("_size")).filter(F.col("_size") > shard_rows)
        sizes = write_table(sizes, work_path(spark, "vector-shard-sizes"))
        largest = sizes.agg(F.max("_size")).first()[0]
        if largest is None or (before is not None and largest > 0.9 * before):
            break
        before = largest
        small = rows.join(sizes, "_shard", "left_anti")
        done = small if done is None else done.unionByName(small)
        large = rows.join(sizes, "_shard")
        wanted = F.least(F.lit(64), F.greatest(F.lit(8), F.ceil(F.col("_size") * 3 * overlap / shard_rows)))
        draw = F.row_number().over(W.partitionBy("_shard").orderBy(F.xxhash64("_id", F.lit(level)), "_id"))
        pivots = (
            large.withColumn("_wanted", wanted)
            .withColumn("_draw", draw)
            .filter((F.col("_draw") <= 64) & (F.col("_draw") <= F.col("_wanted")))
            .groupBy("_shard")
            .agg(F.sort_array(F.collect_list(F.struct("_draw", "_v"))).alias("_pivots"))
            .select("_shard", F.transform("_pivots", lambda p: p["_v"]).alias("_pivots"))
        )
        rows = write_table(_nearest_pivots(large.drop("_size").join(pivots, "_shard"), overlap), work_path(spark, "vector-shards"))
    return rows if done is None else done.unionByName(rows)


def _nearest_pivots(rows: DataFrame, overlap: int) -> DataFrame:
    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                table = pa.Table.from_batches([batch])
                unit, parents = _unit_by_length(table.column("_v")), table.column("_shard").to_numpy()
                row, child = [], []
                for parent in np.unique(parents):
                    here = np.flatnonzero(parents == parent)
                    pivots = _unit_by_length(table.column("_pivots")[int(here[0])].values)
                    near = unit[here] @ pivots.T
                    top = np.argsort(-near, axis=1, kind="stable")[:, :overlap]
                    row.append(np.repeat(here, top.shape[1]))
                    # A shard's name is its parent's, mixed with the number of the pivot.
                    mixed = (np.uint64(parent) ^ (top.ravel().astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
                    child.append((mixed ^ (mixed >> np.uint64(31))).view(np.int64))
                taken = table.take(pa.array(np.concatenate(row))).select(["_id", "_v", "_n"])
                yield from taken.append_column("_shard", pa.array(np.concatenate(child))).to_batches()

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select("_id", "_v", "_n").schema.fields)
    return rows.select("_id", "_v", "_n", "_shard", "_pivots").mapInArrow(run, f"{kinds}, _shard bigint")


def _unit_by_length(column) -> np.ndarray:
    return _unit(pa.table({"_v": column}))


def neighbour_lists(unit: np.ndarray, seed: int = 1) -> np.ndarray:
    """Robust-pruned neighbour lists (row, degree) of the vectors of a shard; -1 fills up.

    The nearest candidate is kept and rules out those that are nearer to it, by a factor,
    than to the vector itself; then the next, and so on.
    """
    n = len(unit)
    near_count = min(NEAREST, n - 1)
    lists = np.full((n, DEGREE), -1, np.int32)
    if near_count < 1:
        return lists
    random = np.random.default_rng(seed)
    for start in range(0, n, BLOCK):
        rows = np.arange(start, min(n, start + BLOCK))
        similar = unit[rows] @ unit.T
        similar[np.arange(len(rows)), rows] = -np.inf
        near = np.argpartition(-similar, near_count - 1, axis=1)[:, :near_count]
        wide = random.integers(0, n, (len(rows), RANDOM))
        chosen = np.concatenate([near, wide], axis=1)
        distance = 1 - np.take_along_axis(similar, chosen, axis=1)
        order = np.argsort(distance, axis=1, kind="stable")
        chosen, distance = np.take_along_axis(chosen, order, 1), np.take_along_axis(distance, order, 1)
        between = 1 - np.einsum("bcd,bed->bce", unit[chosen], unit[chosen])
        alive = np.isfinite(distance)
        at = np.arange(len(rows))
        for place in range(DEGREE):
            any_left = alive.any(axis=1)
            if not any_left.any():
                break
            pick = alive.argmax(axis=1)
            lists[rows[any_left], place] = chosen[at, pick][any_left]
            alive[at, pick] = False
            # Squared distances: the factor counts twice.
            alive &= ALPHA**2 * between[at, pick] > distance
            alive[~any_left] = False
    return lists


def search(unit: np.ndarray, lists: list[np.ndarray], threshold: float, beam: int) -> np.ndarray:
    """Which vectors of a shard are within range of which, as found over the graph.

    Each query starts at the medoid and expands the most similar vector seen so far;
    after ``beam`` of them it goes on only where a vector is within a widened range.
    """
    n = len(unit)
    width = max((len(x) for x in lists), default=0)
    table = np.full((n, max(1, width)), -1, np.int32)
    for i, x in enumerate(lists):
        table[i, : len(x)] = x
    medoid = int((unit @ unit.mean(axis=0)).argmax())
    slack = threshold - 2 * (1 - threshold)
    found = np.zeros((n, n), bool)
    for start in range(0, n, BLOCK):
        queries = np.arange(start, min(n, start + BLOCK))
        rows = np.arange(len(queries))
        seen = np.full((len(queries), n), -np.inf)
        open_ = np.full((len(queries), n), -np.inf)
        seen[:, medoid] = open_[:, medoid] = unit[queries] @ unit[medoid]
        active = rows
        steps = 0
        while len(active):
            best = open_[active].argmax(axis=1)
            value = open_[active, best]
            go = np.isfinite(value) & ((steps < beam) | (value >= slack))
            active, best = active[go], best[go]
            if not len(active):
                break
            open_[active, best] = -np.inf
            nexts = table[best]
            ok = nexts >= 0
            row = np.repeat(active, ok.sum(axis=1))
            node = nexts[ok]
            new = np.isneginf(seen[row, node])
            row, node = row[new], node[new]
            similar = np.einsum("ij,ij->i", unit[queries[row]], unit[node])
            seen[row, node] = similar
            open_[row, node] = similar
            steps += 1
        found[queries] = seen >= threshold
    found |= found.T
    found[np.arange(n), np.arange(n)] = False
    return found


def _local_roots(found: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id reachable inside the shard, per vector."""
    label = ids.copy()
    a, b = np.nonzero(found)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        if np.array_equal(before, label):
            return label


def links(members: DataFrame, threshold: float, beam: int) -> DataFrame:
    """``_id``, ``found`` (structs of id and copies) and ``root`` per vector and shard."""
    spark = members.sparkSession

    def build(table: pa.Table) -> pa.Table:
        ids = table.column("_id").to_numpy()
        lists = neighbour_lists(_unit(table))
        row, place = np.nonzero(lists >= 0)
        here, there = ids[row], ids[lists[row, place]]
        # Both directions, so that no vector is without a way in.
        return pa.table({"_id": np.concatenate([here, there]), "_to": np.concatenate([there, here])})

    edges = members.groupBy("_shard").applyInArrow(build, "_id bigint, _to bigint")
    adjacency = write_table(
        edges.groupBy("_id").agg(F.collect_set("_to").alias("_list")), work_path(spark, "vector-graph")
    )

    def look(table: pa.Table) -> pa.Table:
        ids, copies = table.column("_id").to_numpy(), table.column("_n").to_numpy()
        order = np.argsort(ids)
        lists = []
        for value in table.column("_list"):
            to = np.array(value.as_py() or [], np.int64)
            at = order[np.minimum(np.searchsorted(ids[order], to), len(ids) - 1)]
            lists.append(at[ids[at] == to])  # neighbours that are in this shard
        found = search(_unit(table), lists, threshold, beam)
        some = np.flatnonzero(found.any(axis=1))
        root = _local_roots(found, ids)
        pairs = [[{"id": int(ids[j]), "n": int(copies[j])} for j in np.flatnonzero(found[i])] for i in some]
        kind = pa.list_(pa.struct([("id", pa.int64()), ("n", pa.int64())]))
        return pa.table({"_id": ids[some], "found": pa.array(pairs, kind), "root": root[some]})

    return (
        members.join(adjacency, "_id", "left")
        .groupBy("_shard")
        .applyInArrow(look, "_id bigint, found array<struct<id:bigint,n:bigint>>, root bigint")
    )


def audit(vectors: DataFrame, found: DataFrame, threshold: float, queries: int = 200) -> tuple[int, int]:
    """Links of ``queries`` vectors drawn by a hash: how many there are, and how many were found.

    The sample is scanned against all vectors, block by block, in the tasks that hold them.
    """
    drawn = vectors.orderBy(F.xxhash64("_id", F.lit("audit")), "_id").limit(queries)
    sample = [(r["_group"], r["_id"], np.array(r["_v"], np.float64)) for r in drawn.collect()]
    shared = vectors.sparkSession.sparkContext.broadcast(sample)  # at most ``queries`` vectors

    def run(batches):
        for batch in batches:
            row: list[int] = []
            other: list[int] = []
            groups = np.array(batch.column(0).to_pylist(), object)
            sizes = np.array([len(v) for v in batch.column(2)])
            for group, vec_id, v in shared.value:
                here = np.flatnonzero((groups == group) & (sizes == len(v)))
                if not len(here):
                    continue
                unit = _unit_by_length(pa.chunked_array([batch.column(2).take(pa.array(here))]))
                v = v / np.abs(v).max()
                near = here[unit @ (v / np.sqrt((v**2).sum())) >= threshold]
                near = near[batch.column(1).to_numpy()[near] != vec_id]
                row += [vec_id] * len(near)
                other += batch.column(1).to_numpy()[near].tolist()
            yield pa.RecordBatch.from_pydict({"_id": pa.array(row, pa.int64()), "_to": pa.array(other, pa.int64())})

    true = vectors.select("_group", "_id", "_v").mapInArrow(run, "_id bigint, _to bigint")
    asked = found.join(drawn.select("_id"), "_id", "left_semi")
    flat = asked.select("_id", F.explode("found.id").alias("_to")).distinct().withColumn("_hit", F.lit(1))
    row = true.join(flat, ["_id", "_to"], "left").agg(F.count("*"), F.count("_hit")).first()
    return row[0], row[1]


def _angles(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """``_cell`` (the nearest pivot) and ``_angles`` to the pivots of that length; one cell without any."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)  # at most ``PIVOTS`` vectors
    names = [*vectors.columns, "_cell", "_angles"]
    place = vectors.columns.index("_v")

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                sizes = np.array([len(v) for v in batch.column(place)])
                cell, angles = np.zeros(len(sizes), np.int32), [[0.0]] * len(sizes)
                for size in np.unique(sizes):
                    of = shared.value.get(int(size))
                    if of is None:
                        continue
                    here = np.flatnonzero(sizes == size)
                    unit = _unit_by_length(pa.chunked_array([batch.column(place).take(pa.array(here))]))
                    wide = np.arccos(np.clip(unit @ of.T, -1, 1)).astype(np.float32)
                    cell[here] = wide.argmin(axis=1)
                    for i, row in zip(here, wide):
                        angles[i] = row
                more = [pa.array(cell), pa.array(angles, pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *more], names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema.fields)
    return vectors.mapInArrow(run, f"{kinds}, _cell int, _angles array<float>")


def block_pairs(vectors: DataFrame, threshold: float, block_rows: int | None = None) -> DataFrame:
    """``_a``, ``_b``, ``_id``, ``_n``, ``_v`` once per pair of blocks (``_low``, ``_high``) and ``_block``, the own one.

    ``vectors`` has ``_group`` and those five.  Any two vectors of a group and length within range meet in
    exactly one pair of blocks; groups up to ``block_rows`` are one block.
    """
    spark = vectors.sparkSession
    rows = vectors.select("_a", "_b", "_id", "_n", "_v", F.xxhash64("_group", F.size("_v")).alias("_set"))
    sizes = rows.groupBy("_set").agg(F.count("*").alias("_size"), F.max(F.size("_v")).alias("_dims"))
    sizes = write_table(sizes, work_path(spark, "vector-sizes"))
    n, dims = sizes.agg(F.sum("_size"), F.max("_dims")).first()
    if block_rows is None:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        block_rows = max(1, min(max(512, (n or 0) // (2 * tasks)), BLOCK_VALUES // (dims or 1)))
    large = write_table(sizes.filter(F.col("_size") > block_rows).select("_set", "_size"), work_path(spark, "vector-large"))
    largest = large.agg(F.max("_size")).first()[0]
    alone = F.col("_set").alias("_low")
    columns = ["_a", "_b", "_id", "_n", "_v"]
    small = rows.join(large, "_set", "left_anti").select(*columns, alone, alone.alias("_high"), alone.alias("_block"))
    if largest is None:
        return small
    inside = rows.join(large.select("_set"), "_set")
    wanted = int(min(PIVOTS, max(2, -(-2 * largest // block_rows))))
    drawn = inside.select("_v", F.xxhash64("_a", F.lit("pivot")).alias("_h"), "_a").orderBy("_h", "_a").limit(wanted)
    by_size: dict[int, list] = {}
    for row in drawn.select("_v").collect():
        by_size.setdefault(len(row["_v"]), []).append(row["_v"])
    pivots = {size: _unit_by_length(pa.chunked_array([pa.array(of, pa.list_(pa.float64()))])) for size, of in by_size.items()}
    located = write_table(_angles(inside, pivots), work_path(spark, "vector-cells"))
    cells = located.groupBy("_set", "_cell").agg(
        F.count("*").alias("_rows"), F.max(F.get("_angles", F.col("_cell"))).alias("_radius")
    )
    cells = cells.select(
        F.col("_set").alias("_set_2"), F.col("_cell").alias("_to"), "_radius",
        F.ceil(F.col("_rows") / block_rows).cast("int").alias("_parts"),
    )
    cells = write_table(cells, work_path(spark, "vector-radii"))
    own = cells.select(F.col("_set_2").alias("_set"), F.col("_to").alias("_cell"), F.col("_parts").alias("_own_parts"))
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + ROUNDING
    part = F.pmod(F.xxhash64("_a", "_b"), F.col("_own_parts")).cast("int")
    placed = located.join(own, ["_set", "_cell"]).withColumn("_part", part)
    within = (F.col("_set") == F.col("_set_2")) & (
        (F.col("_to") == F.col("_cell")) | (F.get("_angles", F.col("_to")) <= F.col("_radius") + reach)
    )
    met = placed.join(cells, within).withColumn("_to_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))

    def block(cell: str, part: str) -> Column:
        return F.struct(F.col("_set").alias("set"), F.col(cell).alias("cell"), F.col(part).alias("part"))

    def name(of: Column) -> Column:
        return F.xxhash64(of["set"], of["cell"], of["part"])

    mine, theirs = block("_cell", "_part"), block("_to", "_to_part")
    met = met.select(*columns, name(F.least(mine, theirs)).alias("_low"), name(F.greatest(mine, theirs)).alias("_high"), name(mine).alias("_block"))
    return small.unionByName(met)


def compare(unit: np.ndarray, copies: np.ndarray, first: np.ndarray, threshold: float, alone: bool) -> tuple[np.ndarray, np.ndarray]:
    """Linked rows and smallest linked place of each vector; places of ``first`` meet the others, ``alone`` each other.

    The similarities are made a few rows at a time, and links are contracted as they are met.
    """
    left = np.arange(len(unit)) if alone else np.flatnonzero(first)
    right = left if alone else np.flatnonzero(~first)
    there, weight = unit[right], copies[right].astype(np.float64)
    linked = np.zeros(len(unit), np.int64)
    parent = np.arange(len(unit))
    for start in range(0, len(left) if len(right) else 0, BLOCK):
        here = left[start : start + BLOCK]
        near = unit[here] @ there.T >= threshold
        if alone:
            near[np.arange(len(here)), np.arange(start, start + len(here))] = False
        some = near.any(axis=1)
        here, near = here[some], near[some]
        if not len(here):
            continue
        linked[here] += (near.astype(np.float64) @ weight).astype(np.int64)
        if not alone:  # alone, every link is met from both ends
            linked[right] += (copies[here].astype(np.float64) @ near.astype(np.float64)).astype(np.int64)
        for place, row in zip(here, near):
            nodes = np.append(right[row], place)
            top = parent[nodes]
            while not np.array_equal(top, above := parent[top]):
                top = above
            parent[top] = parent[nodes] = top.min()
    while not np.array_equal(parent, above := parent[parent]):
        parent = above
    return linked, parent


def exact_links(pairs: DataFrame, threshold: float) -> DataFrame:
    """``_a``, ``_b``, ``_id``, ``_linked`` and ``root`` of the vectors that link inside a pair of blocks."""

    def look(key, table):
        table = table.sort_by([("_id", "ascending"), ("_a", "ascending"), ("_b", "ascending")])
        first = table.column("_block").to_numpy() == key[0].as_py()
        linked, root = compare(_unit(table), table.column("_n").to_numpy(), first, threshold, key[0] == key[1])
        some = np.flatnonzero(linked)
        ids = table.column("_id").to_numpy()
        taken = table.select(["_a", "_b", "_id"]).take(pa.array(some))
        return taken.append_column("_linked", pa.array(linked[some])).append_column("root", pa.array(ids[root[some]]))

    return pairs.groupBy("_low", "_high").applyInArrow(look, "_a bigint, _b bigint, _id bigint, _linked bigint, root bigint")


def near_duplicates(
    rows: DataFrame,
    threshold: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    group_column: str = "label",
    block_rows: int | None = None,
) -> DataFrame:
    """One row per row of the table: ``_id``, ``n_links``, ``component_id``, ``kept``.

    Vectors of one group (equal ``label``, not NULL) and length link if their cosine is at
    least ``threshold``; all links are found.  ``n_links`` counts the other rows a vector links with
    directly, ``component_id`` is the smallest id reachable, ``kept`` says whether that is its own.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components, and rows with
    a NULL label or id, link with nothing (``kept`` is false for a NULL id).  Equal
    vectors are compared once and counted each; rows with the same id are one node.
    An empty table gives no rows.
    """
    spark = rows.sparkSession
    named = rows.select(
        F.col(id_column).alias("_id"), F.col(group_column).alias("_group"), F.col(vector_column).alias("_v")
    ).withColumn(
        "_key", F.when(usable(F.col("_v")) & F.col("_group").isNotNull() & F.col("_id").isNotNull(),
                       F.struct(F.xxhash64("_group", "_v").alias("a"), F.xxhash64(F.lit(1), "_v", "_group").alias("b")))
    )
    copies = named.filter(F.col("_key").isNotNull()).groupBy("_key").agg(
        F.count("*").alias("_n"),
        F.min(F.struct("_id", "_group", "_v")).alias("_one"),
    )
    distinct = write_table(
        copies.select("_key", "_n", F.col("_one._id").alias("_id"), F.col("_one._group").alias("_group"), F.col("_one._v").alias("_v")),
        work_path(spark, "vectors"),
    )
    vectors = distinct.select("_key.a", "_key.b", "_id", "_n", "_group", "_v").withColumnsRenamed({"a": "_a", "b": "_b"})
    found = write_table(exact_links(block_pairs(vectors, threshold, block_rows), threshold), work_path(spark, "vector-links"))
    linked = found.groupBy(F.struct(F.col("_a").alias("a"), F.col("_b").alias("b")).alias("_key")).agg(F.sum("_linked").alias("_linked"))
    roots = connected_components(found, "_id", "root").select(F.col("node").alias("_id"), "root")
    answers = (
        distinct.select("_key", "_id", "_n")
        .join(linked, "_key", "left")
        .join(roots, "_id", "left")
        .select(
            F.col("_key").alias("_key_2"),
            (F.coalesce("_linked", F.lit(0)) + F.col("_n") - 1).alias("n_links"),
            F.coalesce("root", "_id").alias("component_id"),
        )
    )
    result = named.drop("_v", "_group").join(answers, F.col("_key") == F.col("_key_2"), "left")
    component = F.coalesce("component_id", "_id")
    return result.select(
        "_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("_id"), F.lit(False)).alias("kept"),
    )
