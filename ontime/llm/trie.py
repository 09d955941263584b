"""Prefix trie of conversations: union-find over the common prefixes of sorted neighbours.

Every conversation is a sequence of turn digests. Distinct sequences are sorted, and the longest
common prefix of two neighbours is an edge between them. Taking the edges from the deepest to the
shallowest, each union of two components makes (or extends) a branching node of the trie. That runs
on blocks of a sorted partition. Nodes that lie inside a block are final; those on the path of its
first or last row may go on in the next block, so the forest is contracted to them, with the sums of
what hangs below, and the contracted forests of all blocks are merged by node.

Long conversations are cut into chunks. A chunk is sorted under the hash of all turns before it, so
the tries of all chunk levels are built at once and no row ever holds more than one chunk; the merge
that joins blocks also hangs each chunk's trie under the node where the chunk before it ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import stage, word_count

DIGEST = 16
# Turns in a chunk, sorted rows in a block, ids in a block of a member list, chunks in a group of chunks.
CHUNK, BLOCK, IDS, GROUP = 256, 20_000, 16_384, 4096
# Conversations to a base, and the largest number of turns taken from it, plus one.
FAMILY, HEADS = 20, 4
NOTHING = hashlib.sha256(b"").hexdigest()

_CHUNK_ROWS = "j bigint, sa bigint, sb bigint, key binary, words array<bigint>, n bigint, first bigint, n_end bigint, ends string"
_NODE_ROWS = (
    "open boolean, id binary, parent binary, depth bigint, conv bigint, parent_conv bigint, n bigint, "
    "children bigint, leaves bigint, saved bigint, words bigint, ends string"
)


# -- turns in order, and conversations rebuilt from them


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``(conv, pos, digest, words)``: turns of each conversation counted from 0 in the order of ``turn``.

    ``turns`` has ``conv_id, turn, role, text``. Null turns come first; equal turn numbers are ordered by
    role, then by the digest. Rows are sorted across all partitions and counted in two levels, within a
    partition and by partition, so a conversation that holds a third of all rows is not one task's work.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    # Sorting looks at its rows twice, so texts are read and counted before.
    narrow = stage(
        turns.where(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("bigint").alias("conv"), "turn", role.alias("role"), digest.alias("digest"),
            word_count(text).alias("words"),
        ),
        "digests",
    )
    ordered = stage(
        narrow.orderBy("conv", F.asc_nulls_first("turn"), "role", "digest")
        .select("conv", F.monotonically_increasing_id().alias("at"), "digest", "words"),
        "turns",
    ).withColumn("part", F.shiftright("at", 33))
    # Only a conversation that began in an earlier partition has an offset: one at most for each partition.
    sizes = ordered.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("conv", "part", before.alias("before")).where("before > 0")
    here = F.row_number().over(Window.partitionBy("conv", "part").orderBy("at")) - 1
    return (
        ordered.withColumn("here", here).join(F.broadcast(offsets), ["conv", "part"], "left")
        .select("conv", (F.col("here") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "words")
    )


def rebuilt(numbered: DataFrame) -> DataFrame:
    """Turns of conversations that begin with their base's first turns: ``(conv, n_turns, pos, digest, words)``.

    The first ``crc32(conv) % 4`` turns are those of the base, conversation ``conv - conv % 20`` (all of
    its turns if it has fewer, none if there is none); its own turns after as many follow. Every
    conversation has one more row, with position -1 and no digest, so that one without turns is there.
    """
    own = stage(numbered, "numbered")
    lengths = own.groupBy("conv").agg(F.count(F.lit(1)).alias("n_own"))
    heads = (
        own.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < HEADS - 1))
        .groupBy(F.col("conv").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("head"))
    )
    asked = (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).cast("int")
    taken = F.coalesce(F.slice("head", 1, F.col("asked")), F.array().cast("array<struct<pos:bigint,digest:binary,words:bigint>>"))
    plans = stage(
        lengths.select("conv", "n_own", (F.col("conv") - F.col("conv") % FAMILY).alias("base"), asked.alias("asked"))
        .join(heads, "base", "left")
        .select("conv", "n_own", "asked", taken.alias("head"))
        .withColumn("n_turns", F.size("head") + F.greatest(F.col("n_own") - F.col("asked"), F.lit(0))),
        "plans",
    )
    marker = F.struct(
        F.lit(-1).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("bigint").alias("words")
    )
    begun = plans.select("conv", "n_turns", F.inline(F.concat(F.array(marker), "head")))
    rest = (
        own.join(plans.select("conv", "n_turns", "asked", F.size("head").alias("n_head")), "conv")
        .where("pos >= asked")
        .select("conv", "n_turns", (F.col("pos") - F.col("asked") + F.col("n_head")).alias("pos"), "digest", "words")
    )
    return begun.unionByName(rest)


# -- distinct chunks


def _half(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("bigint")


def _chunk_hash(j: int, key: bytes) -> tuple[int, int]:
    """As the columns of :func:`chunks` have it."""
    digest = hashlib.md5(b"%d:" % j + key).hexdigest()
    return int(digest[:15], 16), int(digest[15:30], 16)


def chunks(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``(conv, j, sa, sb, key, words, ends)``: chunk ``j`` of a conversation as joined digests, under the
    hash ``(sa, sb)`` of all chunks before it; ``ends`` tells the last one.

    That hash is the exclusive or of the chunks' hashes, each with its number, so it is summed up in two
    levels (chunks in a group, groups) for the conversations that have more than one chunk.
    """
    j = F.expr(f"greatest(pos, 0) div {chunk}")
    turn = F.when(F.col("pos") >= 0, F.struct("pos", "digest", "words"))
    found = stage(
        turns.groupBy("conv", "n_turns", j.alias("j")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select(
            "conv", "n_turns", "j",
            F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), "")).alias("key"),
            F.transform("turns", lambda t: t["words"]).alias("words"),
            ((F.col("j") + 1) * chunk >= F.col("n_turns")).alias("ends"),
        ),
        "chunks",
    )
    columns = ["conv", "j", "sa", "sb", "key", "words", "ends"]
    short = found.where(F.col("n_turns") <= chunk).withColumns({"sa": F.lit(0).cast("bigint"), "sb": F.lit(0).cast("bigint")})
    digest = F.md5(F.concat(F.concat(F.col("j").cast("string"), F.lit(":")).cast("binary"), F.col("key")))
    long = (
        found.where(F.col("n_turns") > chunk).withColumn("digest", digest)
        .withColumns({"a": _half(F.col("digest"), 1), "b": _half(F.col("digest"), 16), "group": F.expr(f"j div {GROUP}")})
    )
    inside = Window.partitionBy("conv", "group").orderBy("j").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("conv").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = long.groupBy("conv", "group").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).select(
        "conv", "group", F.bit_xor("a").over(across).alias("ga"), F.bit_xor("b").over(across).alias("gb")
    )
    zero = F.lit(0).cast("bigint")
    deep = (
        long.withColumns({"ia": F.bit_xor("a").over(inside), "ib": F.bit_xor("b").over(inside)})
        .join(groups, ["conv", "group"])
        .withColumns({
            "sa": F.coalesce("ia", zero).bitwiseXOR(F.coalesce("ga", zero)),
            "sb": F.coalesce("ib", zero).bitwiseXOR(F.coalesce("gb", zero)),
        })
    )
    return short.select(*columns).unionByName(deep.select(*columns))


def member_digests(members: DataFrame, ids: int = IDS) -> DataFrame:
    """``(rid, ends)``: SHA-256 of the decimal ids under each ``rid`` of ``(rid, conv)``, ascending, comma-joined.

    Sorted ids are first joined into texts of up to ``ids`` ids wherever they lie. This digest can only
    be taken in order, so the texts of one ``rid`` then pass one task as a stream, one at a time.
    """

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, held = None, []
        for batch in batches:
            for r, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if held and (r != rid or len(held) == ids):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([rid], pa.binary()), pa.array(held[:1]), pa.array([",".join(map(str, held))])], ["rid", "first", "text"]
                    )
                    held = []
                rid = r
                held.append(c)
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([rid], pa.binary()), pa.array(held[:1]), pa.array([",".join(map(str, held))])], ["rid", "first", "text"]
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, seen = None, None
        for batch in batches:
            done = []
            for r, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if r == rid:
                    seen.update(b"," + text.encode())
                    continue
                if seen:
                    done.append((rid, seen.hexdigest()))
                rid, seen = r, hashlib.sha256(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done]) for k in (0, 1)], ["rid", "ends"])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([rid], pa.binary()), pa.array([seen.hexdigest()])], ["rid", "ends"])

    joined = stage(
        members.select("rid", "conv").repartitionByRange("rid", "conv").sortWithinPartitions("rid", "conv")
        .mapInArrow(texts, "rid binary, first bigint, text string"),
        "members",
    )
    return joined.repartition("rid").sortWithinPartitions("rid", "first").select("rid", "text").mapInArrow(
        digests, "rid binary, ends string"
    )


def distinct_chunks(found: DataFrame, ids: int = IDS) -> DataFrame:
    """Each distinct chunk once, with its conversations counted: the columns of ``_CHUNK_ROWS``.

    Copies are combined before they are shuffled, so a sequence that a third of all conversations
    share is one row per task.
    """
    rid = F.unhex(F.md5(F.concat(F.concat_ws(":", "j", "sa", "sb", F.lit("")).cast("binary"), F.col("key"))))
    named = stage(found.withColumn("rid", rid), "named")
    rows = stage(
        named.groupBy("rid").agg(
            F.first("j").alias("j"), F.first("sa").alias("sa"), F.first("sb").alias("sb"), F.first("key").alias("key"),
            F.first("words").alias("words"), F.count(F.lit(1)).alias("n"), F.min("conv").alias("first"),
            F.count_if("ends").alias("n_end"), F.min(F.when(F.col("ends"), F.col("conv"))).alias("only"),
        ),
        "distinct",
    )
    many = rows.where("n_end > 1").select("rid")
    shared = member_digests(named.where("ends").select("rid", "conv").join(many, "rid"), ids)
    alone = F.when(F.col("n_end") == 1, F.sha2(F.col("only").cast("string").cast("binary"), 256))
    return rows.join(shared, "rid", "left").select(
        "j", "sa", "sb", "key", "words", "n", "first", "n_end", F.coalesce("ends", alone).alias("ends")
    )


# -- the trie of a block of sorted rows


def _common(a: bytes, b: bytes) -> int:
    """Turns that two keys have in common from their start."""
    most = min(len(a), len(b)) // DIGEST
    if a[: most * DIGEST] == b[: most * DIGEST]:
        return most
    low, high = 0, most - 1  # the common prefix is at least low and at most high turns long
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[: mid * DIGEST] == b[: mid * DIGEST] else (low, mid - 1)
    return low


class _Forest:
    """Compressed tries of sorted rows: ends of rows and branching nodes, deepest unions first."""

    def __init__(self, rows: list[tuple]):
        self.depth = [len(r[3]) // DIGEST for r in rows]
        self.row = list(range(len(rows)))  # the row that ends in a node, or -1 for a mere branching
        self.sample = list(range(len(rows)))  # any row below the node
        self.below: list[list[int]] = [[] for _ in rows]
        self.leader, self.top = list(range(len(rows))), list(range(len(rows)))
        edges = [
            (-_common(a[3], b[3]), i) for i, (a, b) in enumerate(zip(rows, rows[1:])) if a[:3] == b[:3]
        ]
        for lcp, i in sorted(edges):
            self._union(self._find(i), self._find(i + 1), -lcp)
        self.tops = sorted({self.top[self._find(i)] for i in range(len(rows))}, key=lambda x: self.sample[x])

    def _find(self, i: int) -> int:
        while self.leader[i] != i:
            self.leader[i] = i = self.leader[self.leader[i]]
        return i

    def _union(self, a: int, b: int, depth: int) -> None:
        """Edges of one depth come from left to right, so only the left component can end at that depth."""
        x, y = self.top[a], self.top[b]
        if self.depth[x] == depth:
            self.below[x].append(y)
        else:
            self.depth.append(depth)
            self.row.append(-1)
            self.sample.append(self.sample[x])
            self.below.append([x, y])
            x = len(self.depth) - 1
        self.leader[b] = a
        self.top[a] = x


def _block_nodes(rows: list[tuple], chunk: int) -> list[tuple]:
    """Nodes of the tries of sorted rows, in the columns of ``_NODE_ROWS``.

    A final node has all its numbers. An open one, on the path of the first or last row or above a chunk
    that goes on, has its own members and the sums of the final nodes right below it.
    """
    forest = _Forest(rows)
    size = len(forest.depth)
    order = sorted(range(size), key=lambda x: -forest.depth[x])
    n, first, opened = [0] * size, [None] * size, [False] * size
    for x in order:
        r = forest.row[x]
        members = [(rows[r][5], rows[r][6])] if r >= 0 else []
        members += [(n[y], first[y]) for y in forest.below[x]]
        n[x], first[x] = sum(m[0] for m in members), min(m[1] for m in members)
        opened[x] = any(opened[y] for y in forest.below[x]) or r >= 0 and (
            r in (0, len(rows) - 1) or rows[r][7] < rows[r][5]
        )
    out: list[tuple] = []
    leaves, saved = [0] * size, [0] * size  # of a final node and all below it, at the upper end of its path

    def write_path(x: int, top: int, parent: tuple[bytes | None, int | None], hashes: list[bytes]) -> None:
        """The nodes of depths ``top + 1`` to the node's own, the shallowest first."""
        j, _, _, _, words = rows[forest.sample[x]][:5]
        r, kids, end = forest.row[x], forest.below[x], forest.depth[x]
        ends = rows[r][8] if r >= 0 else None
        if opened[x]:
            done = [y for y in kids if not opened[y]]
            for d in range(top + 1, end + 1):
                last = d == end
                out.append((
                    True, hashes[d], hashes[d - 1], j * chunk + d, first[x], None, n[x], len(done) if last else 0,
                    sum(leaves[y] for y in done) if last else 0, sum(saved[y] for y in done) if last else 0,
                    words[d - 1], ends if last else None,
                ))
            return
        total = saved[x]
        up = parent
        for d in range(top + 1, end + 1):
            last = d == end
            out.append((
                False, None, up[0], j * chunk + d, first[x], up[1], n[x], len(kids) if last else 1, leaves[x], total, None,
                ends if last else None,
            ))
            total -= (n[x] - 1) * words[d - 1]
            up = (None, first[x])

    # Sums of final nodes first, children before parents; a path adds each of its turns.
    above = [0] * size
    for x in range(size):
        for y in forest.below[x]:
            above[y] = forest.depth[x]
    for x in order:
        if not opened[x]:
            kids, words = forest.below[x], rows[forest.sample[x]][4]
            leaves[x] = sum(leaves[y] for y in kids) or 1
            saved[x] = sum(saved[y] for y in kids) + (n[x] - 1) * sum(words[above[x] : forest.depth[x]])

    for t in forest.tops:
        j, sa, sb = rows[forest.sample[t]][:3]
        head = hashlib.md5(b"%d:%d:%d:" % (j, sa, sb))
        root = head.digest()
        # The root of a chunk's trie is the node that the chunk before ends in; of the first chunk, the trie's.
        kids, at_root = ([t], -1) if forest.depth[t] else (forest.below[t], forest.row[t])
        done = [y for y in kids if not opened[y]]
        own = (0, first[t], None, n[t]) if j == 0 else (None, None, None, 0)
        out.append((
            True, root, None, *own, len(done), sum(leaves[y] for y in done), sum(saved[y] for y in done),
            0 if j == 0 else None, rows[at_root][8] if at_root >= 0 else None,
        ))
        # From the top down: open nodes need the hashes of their path, and so do final ones right below them.
        todo = [(y, 0, [root], head, (root, None)) for y in kids]
        while todo:
            x, top, hashes, state, parent = todo.pop()
            if opened[x]:
                key, state, hashes = rows[forest.sample[x]][3], state.copy(), hashes[:]
                for d in range(top + 1, forest.depth[x] + 1):
                    state.update(key[(d - 1) * DIGEST : d * DIGEST])
                    if d == chunk:
                        a, b = _chunk_hash(j, key)
                        hashes.append(hashlib.md5(b"%d:%d:%d:" % (j + 1, sa ^ a, sb ^ b)).digest())
                    else:
                        hashes.append(state.digest())
                write_path(x, top, parent, hashes)
                todo += [(y, forest.depth[x], hashes, state, (hashes[-1], None)) for y in forest.below[x]]
            else:
                write_path(x, top, parent, hashes)
                todo += [(y, forest.depth[x], hashes, state, (None, first[x])) for y in forest.below[x]]
    return out


def _arrow(nodes: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in _NODE_ROWS.split(", ")]
    kinds = {"boolean": pa.bool_(), "binary": pa.binary(), "bigint": pa.int64(), "string": pa.string()}
    types = [kinds[part.split()[1]] for part in _NODE_ROWS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes), types)], names)


def block_forests(rows: DataFrame, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """Final and open nodes of all chunk tries, from rows sorted across partitions."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(c.to_pylist() for c in batch.columns))
            while len(held) >= block:
                yield _arrow(_block_nodes(held[:block], chunk))
                held = held[block:]
        if held:
            yield _arrow(_block_nodes(held, chunk))

    keys = ["j", "sa", "sb", "key"]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(nodes, _NODE_ROWS)


# -- contracted forests merged


def merged(opened: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Open nodes of all blocks as one forest, with their numbers:
    ``(id, parent, depth, conv, n, children, leaves, saved, ends)``.

    Parts of a node add up by its id. Sums over subtrees are taken by pointer doubling: after ``k``
    rounds a node has the sum of all that is fewer than ``2^k`` levels below it, so rounds grow with the
    logarithm of the depth, and each is a join and a sum by key.
    """
    parts = stage(
        opened.groupBy("id").agg(
            F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv").alias("conv"), F.sum("n").alias("n"),
            F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
            F.max("words").alias("words"), F.max("ends").alias("ends"),
        ),
        "parts",
    )
    kids = parts.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("kids"))
    nodes = stage(
        parts.join(kids, "id", "left")
        .withColumn("children", F.col("children") + F.coalesce("kids", F.lit(0)))
        .withColumns({
            "leaves": F.col("leaves") + (F.col("children") == 0).cast("bigint"),
            "saved": F.col("saved") + (F.col("n") - 1) * F.col("words"),
        })
        .select("id", "parent", "depth", "conv", "n", "children", "leaves", "saved", "ends"),
        "open-nodes",
    )
    sums = nodes.select("id", F.col("parent").alias("up"), "leaves", "saved")
    for _ in range(max_rounds):
        if sums.where("up IS NOT NULL").isEmpty():
            break
        sent = sums.where("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        further = sums.select(F.col("id").alias("up"), F.col("up").alias("next"))
        sums = stage(
            sums.join(further, "up", "left").join(sent, "id", "left").select(
                "id", F.col("next").alias("up"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "sums",
        )
    else:
        raise RuntimeError(f"the trie is deeper than 2^{max_rounds}")
    return nodes.drop("leaves", "saved").join(sums.select("id", "leaves", "saved"), "id")


def trie(turns: DataFrame, chunk: int = CHUNK, block: int = BLOCK, ids: int = IDS) -> DataFrame:
    """Nodes of the prefix trie of rebuilt conversations (``conv, n_turns, pos, digest, words``):
    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    A node is a distinct sequence of first turns; ``conv_id`` is the smallest conversation under it. Turns
    count as equal when their 128-bit digests of role and text are. No conversations give no nodes; one
    without turns is a member of the root.
    """
    found = stage(block_forests(distinct_chunks(chunks(turns, chunk), ids), chunk, block), "nodes")
    spine = stage(merged(found.where("open")), "spine")
    parents = spine.select(F.col("id").alias("parent"), F.col("conv").alias("up_conv"))
    final = found.where("NOT open")
    columns = ["conv", "depth", "parent_conv", "n", "children", "leaves", "saved", "ends"]
    settled = final.where("parent IS NULL").select(*columns)
    hanging = final.where("parent IS NOT NULL").join(parents, "parent").withColumn("parent_conv", F.col("up_conv")).select(*columns)
    joined = spine.join(parents, "parent", "left").withColumnRenamed("up_conv", "parent_conv").select(*columns)
    return settled.unionByName(hanging).unionByName(joined).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, chunk: int = CHUNK, block: int = BLOCK, ids: int = IDS) -> DataFrame:
    """:func:`trie` of a table ``(conv_id, turn, role, text)`` whose conversations begin with their base's turns.

    Null roles and texts are empty; rows without ``conv_id`` belong to no conversation and are left out;
    repeated rows are turns of their own; extra columns are not read; an empty table has no nodes.
    """
    turns = numbered_turns(conversations.select("conv_id", "turn", "role", "text"))
    return trie(rebuilt(turns), chunk, block, ids)


# What conversation_trie returns, as DuckDB SQL over a view ``conversations``: every prefix is written out. The first
# table steps the CRC of a decimal number bit by bit.
SQL = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT c, xor(list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: ascii(s)::BIGINT)),
      lambda crc, byte: list_reduce(
        list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, step: xor(x >> 1, 3988292384::BIGINT * (x & 1)))
    ), 4294967295::BIGINT) % {HEADS} AS h
  FROM (SELECT DISTINCT c FROM turns)
), rebuilt AS (
  SELECT v.c, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c - v.c % {FAMILY} AND t.pos < v.h
  UNION ALL SELECT v.c, t.pos, t.role, t.text FROM convs v JOIN turns t ON t.c = v.c AND t.pos >= v.h
), said AS (
  SELECT v.c, coalesce(list({{'role': r.role, 'text': r.text}} ORDER BY r.pos) FILTER (WHERE r.pos IS NOT NULL), []) AS turns
  FROM convs v LEFT JOIN rebuilt r ON r.c = v.c GROUP BY v.c
), prefixes AS (
  SELECT c, d, turns[1:d] AS node, d = len(turns) AS ends FROM (SELECT c, turns, unnest(range(0, len(turns) + 1)) AS d FROM said)
), nodes AS (
  SELECT node, d, min(c) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
  FROM prefixes GROUP BY node, d
), children AS (
  SELECT node[1:d - 1] AS node, count(*) AS kids FROM nodes WHERE d > 0 GROUP BY 1
), counted AS (
  SELECT n.*, coalesce(k.kids, 0) AS kids,
    CASE WHEN d > 0 THEN (n - 1) * len(regexp_extract_all(n.node[d].text, '[^\\x20\\x09-\\x0D]+')) ELSE 0 END AS own
  FROM nodes n LEFT JOIN children k ON k.node = n.node
), sums AS (
  SELECT node[1:e] AS node, count(*) FILTER (WHERE kids = 0) AS leaves, sum(own) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM counted) GROUP BY 1
)
SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n AS n_convs, c.kids AS n_children, s.leaves AS n_leaves,
  CAST(s.saved AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums s ON s.node = c.node LEFT JOIN nodes p ON c.d > 0 AND p.node = c.node[1:c.d - 1]
"""
