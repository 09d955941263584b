"""Embedding near-duplicates by counting collisions of one-dimensional projections."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import stage
from ontime.llm.components import connected_components

COSINE = 0.9
SEED = 20240229

# Half width of the window around a query, in units of a projected unit vector's spread.
HALF_WINDOW = 0.9
# Projections on which the collisions of a pair are counted, and the chance that a pair at the cosine
# limit reaches the required count; and the chance that it meets in some cell at all.
COUNTED = 48
COUNT_RECALL = 0.995
MEET_RECALL = 0.95
# Width of a cell in the same units; about where the fewest tables are needed for these chances.
CELL_WIDTH = 2.5
# Vectors expected beside a vector in its cell when nothing is similar; sets how many projections make a cell.
CROWD = 32.0
# Rows of a cell that are compared in one task; a larger cell is split into blocks and pairs of blocks.
BLOCK = 2048


def _normal_below(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2))


def same_cell_chance(width: float, spread: float) -> float:
    """Chance that two projections whose difference has this spread fall in the same cell of this width."""
    r = width / spread
    return 1 - 2 * _normal_below(-r) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


@dataclass(frozen=True)
class Plan:
    """How cells are made and what count a pair needs; all follows from the limit and the number of rows."""

    dims: int
    cosine: float
    depth: int
    tables: int
    least_count: int

    def directions(self, table: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Random directions and cell offsets of a table; without one, those on which collisions are counted."""
        rng = np.random.default_rng([SEED, self.dims, 0 if table is None else table + 1])
        k = COUNTED if table is None else self.depth
        return rng.standard_normal((self.dims, k)), rng.uniform(0, CELL_WIDTH, k)


def plan_for(rows: int, dims: int, cosine: float = COSINE) -> Plan:
    """Calibrate for recall at the cosine limit, where it is lowest.

    The difference of two unit vectors at cosine c has length sqrt(2 - 2c), which is the spread of its
    projections. Enough projections make a cell that unrelated vectors (spread sqrt 2) rarely share,
    enough tables that a pair at the limit meets in one, and the count that a pair needs is the
    binomial quantile that ``COUNT_RECALL`` of such pairs reach.
    """
    spread = math.sqrt(2 - 2 * cosine)
    near, far = same_cell_chance(CELL_WIDTH, spread), same_cell_chance(CELL_WIDTH, math.sqrt(2))
    depth = max(1, math.ceil(math.log(max(rows, 1) / CROWD) / -math.log(far))) if rows > CROWD else 1
    tables = max(1, math.ceil(math.log(1 - MEET_RECALL) / math.log1p(-(near**depth))))
    hit = 2 * _normal_below(HALF_WINDOW / spread) - 1
    below, count = 0.0, 0
    while True:
        below += math.comb(COUNTED, count) * hit**count * (1 - hit) ** (COUNTED - count)
        if below > 1 - COUNT_RECALL:
            return Plan(dims, cosine, depth, tables, count)
        count += 1


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1).astype(np.float64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled first, so that very long or short vectors neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def cell_keys(unit: np.ndarray, plan: Plan) -> np.ndarray:
    """One 32-bit key per row and table: the hashed cell numbers of the table's projections."""
    keys = np.empty((len(unit), plan.tables), np.int32)
    for t in range(plan.tables):
        a, offset = plan.directions(t)
        cells = np.floor((unit @ a + offset) / CELL_WIDTH).astype(np.int64).view(np.uint64)
        key = np.full(len(unit), t + 1, np.uint64)
        for k in range(plan.depth):
            key = (key ^ cells[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys[:, t] = (key >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return keys


def _keyed(plan: Plan):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = cell_keys(_unit(_matrix(batch.column(2))), plan)
                found = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), plan.tables).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, found], ["id", "copies", "v", "keys"])

    return rows


def _links_within(unit, spots, keys, table, left, right, plan: Plan):
    """The candidate pairs of positions that are links, each only in the first table in which both rows share a cell."""
    near = (np.abs(spots[left] - spots[right]) <= HALF_WINDOW).sum(axis=1) >= plan.least_count
    left, right = left[near], right[near]
    near = np.einsum("ij,ij->i", unit[left], unit[right]) >= plan.cosine
    left, right = left[near], right[near]
    first = np.ones(len(left), bool)
    for t in range(plan.tables):
        first &= (t >= table[left]) | (keys[left, t] != keys[right, t])
    return left[first], right[first]


def _hang(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes, the smallest node of its component under these links."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        before = label.copy()
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def _candidates(group: np.ndarray, side: np.ndarray, order: np.ndarray):
    """Position pairs to compare, for rows sorted by group (and by a projection within): windows over growing
    shifts. In a pair of blocks (side 0 and 1) only rows of different sides are compared."""
    n = len(group)
    for shift in range(1, n):
        same = np.flatnonzero(group[shift:] == group[:-shift])
        if not len(same):
            return
        inside = order[same + shift] - order[same] <= 2 * HALF_WINDOW
        i = same[inside]
        crossing = (side[i] < 0) | (side[i] != side[i + shift])
        yield i[crossing], i[crossing] + shift


def _verify(plan: Plan):
    """Compare the rows of each cell. Rows arrive sorted by group; a group's rows stay together in memory,
    which is at most two blocks. Returns link counts per row, and edges that connect what is linked."""

    def work(part: pa.Table) -> pa.RecordBatch | None:
        group = part["group"].to_numpy()
        ids, copies = part["id"].to_numpy(), part["copies"].to_numpy()
        table, side = part["table"].to_numpy(), part["side"].to_numpy()
        unit = _unit(_matrix(part["v"].combine_chunks()))
        keys = _keys_of(part["keys"].combine_chunks())
        spots = (unit @ plan.directions(None)[0]).astype(np.float32)
        order = np.lexsort((spots[:, 0], group))
        group, ids, copies, table, side, spots, unit, keys = (
            x[order] for x in (group, ids, copies, table, side, spots, unit, keys)
        )
        links, lefts, rights, waiting = np.zeros(len(ids), np.int64), [], [], []

        def settle() -> None:
            if not waiting:
                return
            i, j = (np.concatenate(x) for x in zip(*waiting))
            waiting.clear()
            i, j = _links_within(unit, spots, keys, table, i, j, plan)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            lefts.append(i)
            rights.append(j)

        held = 0
        for i, j in _candidates(group, side, spots[:, 0]):
            waiting.append((i, j))
            held += len(i)
            if held >= 1 << 16:
                settle()
                held = 0
        settle()
        if not lefts:
            return None
        root = _hang(len(ids), np.concatenate(lefts), np.concatenate(rights))
        told = np.flatnonzero(links)
        if not len(told):
            return None
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[told]), pa.array(links[told]), pa.array(ids[root[told]])], ["id", "links", "other"]
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        held = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            held += batch.num_rows
            if held < 4 * BLOCK:
                continue
            both = pa.Table.from_batches(waiting)
            group = both["group"].to_numpy()
            cut = int(np.searchsorted(group, group[-1]))  # the last group may go on in the next batch
            if cut:
                found = work(both.slice(0, cut))
                if found is not None:
                    yield found
            waiting = both.slice(cut).to_batches()
            held = both.num_rows - cut
        if waiting:
            found = work(pa.Table.from_batches(waiting))
            if found is not None:
                yield found

    return rows


def _keys_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def near_links(vectors: DataFrame, plan: Plan) -> DataFrame:
    """``(id, links, other)``: partial link counts of distinct vectors, and for each an edge to a linked vector.

    ``vectors`` is a stored table ``(id, copies, v)`` of distinct vectors of ``plan.dims`` numbers.
    Every vector is filed in one cell per table. Within a cell, vectors are sorted by a further projection
    and compared in windows around each; a pair whose collisions over all counted projections reach the
    required count is verified by its cosine in double precision. A pair that meets in several tables
    counts in the first only, which both rows' keys tell. A cell of many rows is split by id into
    blocks, each pair of which is a group of its own, so no group exceeds two blocks. What leaves a
    task is one row for each vector of a group, not one for each pair.
    """
    kind = dict(vectors.dtypes)["v"]
    keyed = stage(vectors.mapInArrow(_keyed(plan), f"id bigint, copies bigint, v {kind}, keys array<int>"), "keys")
    filed = keyed.select("id", "copies", "v", "keys", F.posexplode("keys").alias("table", "cell"))
    crowded = (
        keyed.select(F.posexplode("keys").alias("table", "cell")).groupBy("table", "cell")
        .agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > BLOCK)
        .select("table", "cell", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    )
    # Few cells are crowded: each holds more than BLOCK rows.
    placed = filed.join(stage(crowded.coalesce(1), "crowded"), ["table", "cell"], "left")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # A row of block b joins the pairs (b, c) for all c; in the pair (b, b) its rows are compared among themselves.
    pairs = F.when(F.col("blocks").isNull(), F.array(F.struct(F.lit(-1).alias("low"), F.lit(-1).alias("high"), F.lit(-1).alias("side")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda c: F.struct(
                F.least(own, c).alias("low"), F.greatest(own, c).alias("high"),
                F.when(own == c, -1).when(own < c, 0).otherwise(1).alias("side"),
            ),
        )
    )
    split = placed.withColumn("pair", F.explode(pairs)).select(
        F.xxhash64("table", "cell", "pair.low", "pair.high").alias("group"),
        "id", "copies", "v", "keys", F.col("table").cast("int").alias("table"), F.col("pair.side").alias("side"),
    )
    dealt = split.repartition("group").sortWithinPartitions("group")
    return dealt.mapInArrow(_verify(plan), "id bigint, links bigint, other bigint")


def near_duplicates(
    rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row.

    Rows link where the cosine of their vectors, in double precision, is at least ``cosine``. Exact
    copies are compared once and count in full. Vectors that are null, empty, zero, or hold null or
    non-finite numbers link with nothing, not even with their copies; so do vectors of different
    lengths with each other. A row is kept if it has the smallest id of its component. Repeated rows
    are rows of their own; null ids never name a component that has another; no rows give no rows.
    """
    number = "float" if dict(rows.dtypes)[vector] == "array<float>" else "double"
    own = stage(
        rows.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast(f"array<{number}>").alias("v"))
        # Adding zero turns a negative zero into a plain one, so that equal vectors are equal arrays.
        .withColumn("v", F.transform("v", lambda x: x + F.lit(0.0).cast(number)))
        .withColumn(
            "valid",
            F.coalesce(
                F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                & F.exists("v", lambda x: x != 0), F.lit(False),
            ),
        ),
        "vectors",
    )
    distinct = stage(
        own.where("valid").groupBy("v").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .select(F.monotonically_increasing_id().alias("id"), "first_id", "copies", "v"),
        "distinct",
    )
    sizes = distinct.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("rows")).orderBy("dims").collect()
    found = None
    for size in sizes:  # vectors have one length, or a few
        same = distinct.where(F.size("v") == size["dims"]).select("id", "copies", "v")
        part = near_links(same, plan_for(size["rows"], size["dims"], cosine))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return own.select(
            "id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
        )
    found = stage(found, "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("id").alias("a"), F.col("other").alias("b"))).withColumnRenamed("node", "id")
    rooted = distinct.join(counts, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    told = rooted.join(names, "root").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    joined = own.where("valid").join(told, "v").select("id", "n_links", "component_id")
    alone = own.where("NOT valid").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(alone).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))
