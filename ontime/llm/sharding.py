"""Sharding by balanced label propagation: linked documents gather in shards of even size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import stage

SHARDS = 24
# Rounds end when no wish can be granted; as half of the rows move at a time, their number grows with the logarithm of
# the links. So many that have not settled are an error.
MOST_ROUNDS = 200
# A star of copies has at most this part of a shard's even share; more copies make more stars.
STAR_SHARE = 0.5

_INDEX_BITS = 33  # of monotonically_increasing_id, below the partition number


def copy_links(nodes: DataFrame, n_rows: int, shards: int = SHARDS) -> DataFrame:
    """Edges ``(a, b)`` between rows of equal key: stars around the smallest row of each group.

    ``nodes`` has ``row`` and ``key``. A group that exceeds ``STAR_SHARE`` of a shard cannot stay together
    whatever its labels, so its rows are dealt to several stars, whose centres are linked to the first.
    """
    most = max(2, int(STAR_SHARE * n_rows / shards))
    groups = nodes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    dealt = nodes.join(groups, "key").withColumn(
        "star", F.pmod(F.xxhash64("row"), F.ceil(F.col("n") / most)).cast("int")
    )
    centres = stage(dealt.groupBy("key", "star").agg(F.min("row").alias("centre")), "stars")
    spokes = dealt.join(centres, ["key", "star"]).where("row != centre").select(F.col("row").alias("a"), F.col("centre").alias("b"))
    first = centres.groupBy("key").agg(F.min("centre").alias("first"))
    between = centres.join(first, "key").where("centre != first").select(F.col("centre").alias("a"), F.col("first").alias("b"))
    return spokes.unionByName(between)


def _home(row: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(row, F.lit("home")), F.lit(shards)).cast("int")


def _chance(row: Column, turn: int) -> Column:
    return F.pmod(F.xxhash64(row, F.lit(f"turn {turn}")), F.lit(1 << 20)) / F.lit(float(1 << 20))


def propagate(edges: DataFrame, quota: int, shards: int = SHARDS, rounds: int = MOST_ROUNDS) -> DataFrame:
    """``(row, label, anchor)`` for every linked row; ``anchor`` is the smallest row it links with, or itself.

    Rows start at a hash of themselves. In each round they look at where their neighbours are and wish to
    move where most of them are, if those are more than where they are now. Half of the rows, by hash, may
    move, so that neighbours do not change places for ever. A shard grants wishes, to rows drawn by hash, as
    far as its linked rows stay within ``quota``; rows without links fill what is left. Rounds go on until
    no row wishes to move where there is room. Only sizes and wishes per shard reach the driver.
    """
    both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "neighbours")
    labels = stage(both.select(F.col("a").alias("row")).distinct().withColumn("label", _home(F.col("row"), shards)), "labels")
    for turn in range(rounds):
        around = both.join(labels.select(F.col("row").alias("b"), "label"), "b")
        votes = around.groupBy("a", "label").agg(F.count(F.lit(1)).alias("votes"))
        own = labels.select(F.col("row").alias("a"), F.col("label").alias("own"))
        best = (
            votes.join(own, "a").groupBy("a", "own").agg(
                F.max(F.struct("votes", "label")).alias("top"),
                F.coalesce(F.max(F.when(F.col("label") == F.col("own"), F.col("votes"))), F.lit(0)).alias("stay"),
            )
            .where(F.col("top.votes") > F.col("stay"))
            .select(F.col("a").alias("row"), F.col("top.label").alias("to"))
        )
        sizes = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
        room = {s: quota - sizes.get(s, 0) for s in range(shards)}
        wishes = stage(best.where(F.col("to").isin([s for s in room if room[s] > 0])), "wishes")
        if wishes.isEmpty():
            break
        movers = wishes.where(_chance(F.col("row"), turn) < 0.5)
        wanted = {r["to"]: r["count"] for r in movers.groupBy("to").count().collect()}
        granted = [min(1.0, max(0, room[s]) / max(wanted.get(s, 0), 1)) for s in range(shards)]
        share = F.element_at(F.array(*[F.lit(g) for g in granted]), F.col("to") + 1)
        moves = movers.where(_chance(F.col("row"), rounds + turn) < share)
        labels = stage(
            labels.join(moves, "row", "left").select("row", F.coalesce("to", "label").alias("label")), "labels"
        )
    else:
        raise RuntimeError(f"labels have not settled after {rounds} rounds")
    nearest = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("anchor"))
    return labels.join(nearest.withColumnRenamed("a", "row"), "row")


def numbered(rows: DataFrame) -> DataFrame:
    """``rank`` from 0 without gaps in the order of a frame's partitions and their rows.

    The first pass stores each row with its partition and place; the second adds the rows of all
    partitions before, of which there is one number each.
    """
    placed = stage(rows.withColumn("__at", F.monotonically_increasing_id()), "placed").withColumns(
        {
            "__piece": F.shiftright("__at", _INDEX_BITS),
            "__index": F.col("__at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)),
        }
    )
    pieces = placed.groupBy("__piece").agg(F.count(F.lit(1)).alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = pieces.select("__piece", before.alias("__base"))
    return placed.join(F.broadcast(bases), "__piece").withColumn("rank", F.col("__base") + F.col("__index")).drop(
        "__at", "__piece", "__index", "__base"
    )


def _pick(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("bigint") for v in values]), at + 1)


def fill(linked: DataFrame, alone: DataFrame, n_rows: int, shards: int = SHARDS) -> DataFrame:
    """``shard`` and ``slot`` for linked rows ``(row, label, anchor)`` and rows ``(row)`` without links.

    Linked rows take the first places of their label, neighbours next to each other; those beyond its
    size join the rows without links, which fill the places left, shard after shard.
    """
    sizes = [n_rows // shards + (s < n_rows % shards) for s in range(shards)]
    counts = {r["label"]: r["count"] for r in linked.groupBy("label").count().collect()}
    own = [counts.get(s, 0) for s in range(shards)]
    starts = [sum(own[:s]) for s in range(shards)]
    order = ["label", "anchor", "row"]
    ranked = numbered(linked.repartitionByRange(*order).sortWithinPartitions(*order))
    within = ranked.withColumn("slot", F.col("rank") - _pick(starts, F.col("label")))
    fits = F.col("slot") < _pick(sizes, F.col("label"))
    taken = [min(o, size) for o, size in zip(own, sizes)]
    free_ends = [sum(sizes[: s + 1]) - sum(taken[: s + 1]) for s in range(shards)]
    rest = numbered(alone.select("row").unionByName(within.where(~fits).select("row")))
    ends = F.array(*[F.lit(e).cast("bigint") for e in free_ends])
    placed = rest.withColumn("shard", F.size(F.filter(ends, lambda e: e <= F.col("rank"))))
    gaps = [t - (free_ends[s - 1] if s else 0) for s, t in enumerate(taken)]
    return within.where(fits).select("row", F.col("label").alias("shard"), "slot").unionByName(
        placed.select("row", "shard", (F.col("rank") + _pick(gaps, F.col("shard"))).alias("slot"))
    )


def shard(docs: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, size, text_crc32, shard, slot)`` for every row, under the law ``rows``: counts differ by one at most.

    Rows of equal text are linked. Linked rows go where propagation puts them, others fill every shard to
    its exact count. ``slot`` numbers the rows of a shard from 0. A null text has no bytes, and equals
    null texts only; repeated rows are rows of their own; no rows give no rows; with fewer rows than
    shards some stay empty.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    nodes = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("id"),
            (F.octet_length(value) + 8).cast("bigint").alias("size"), F.crc32(value.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("hash"), F.col(text).isNull().alias("none"),
        ),
        "nodes",
    )
    n_rows = nodes.count()
    keyed = nodes.select("row", F.struct("hash", "text_crc32", "size", "none").alias("key"))
    edges = stage(copy_links(keyed, n_rows, shards), "links")
    linked = propagate(edges, n_rows // shards, shards)
    alone = nodes.select("row").join(linked, "row", "left_anti")
    return nodes.join(fill(linked, alone, n_rows, shards), "row").select("id", "size", "text_crc32", "shard", "slot")
