"""SimHash near-duplicates by a generalised pigeonhole over unequal bit partitions."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import stage, unused_name
from ontime.llm.components import connected_components

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42

# Buckets of up to this size are compared pair by pair; larger ones link through shared neighbours.
PAIRWISE_BUCKET = 64
# Cost of a probe row in candidate comparisons, used when thresholds are allotted.
PROBE_COST = 4.0
LAYOUTS = (2, 3, 4)
_BLOCK = 65536


def fingerprint(text: bytes | None) -> int:
    """Fingerprint of a whole UTF-8 text: a bit is set where over half of its shingles set it."""
    parts = (text or b"").lower().split()  # on bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    digest = xxhash.xxh64_intdigest
    if len(parts) < SHINGLE_WORDS:
        hashes = np.array([digest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = zip(starts[: 1 - SHINGLE_WORDS].tolist(), ends[SHINGLE_WORDS - 1 :].tolist())
        hashes = np.fromiter(
            (digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(parts) - SHINGLE_WORDS + 1
        )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _BLOCK):
        ones += _bits(hashes[at : at + _BLOCK]).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _bits(values: np.ndarray) -> np.ndarray:
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        found = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, fp)`` of every row; a null or blank text has fingerprint zero."""
    narrow = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    return narrow.mapInArrow(_fingerprint_batches, "id bigint, fp bigint")


# -- planning: which bits go together, and how far each partition may differ


@dataclass(frozen=True)
class Part:
    """A partition of the bits, and how many of them may differ for a probe to hit (-1: unused)."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return _signed(sum(1 << b for b in self.bits))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS))
    for batch in batches:
        rows = _bits(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)).astype(np.float32)
        total += rows.T @ rows
    yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()])], ["m"])


def bit_moments(distinct: DataFrame) -> np.ndarray:
    """How often each two bits are both set, over all fingerprints (the diagonal: each bit)."""
    sums = (
        distinct.select("fp").mapInArrow(_moments, "m array<double>")
        .select(F.posexplode("m").alias("cell", "n")).groupBy("cell").agg(F.sum("n").alias("n")).collect()
    )
    found = np.zeros(BITS * BITS)
    for row in sums:
        found[row["cell"]] = row["n"]
    return found.reshape(BITS, BITS)


def correlated_groups(moments: np.ndarray, n: int, parts: int) -> list[tuple[int, ...]]:
    """Bits dealt into ``parts`` groups of even width, each filled with its most correlated bits.

    Agreement within a group is then mostly repeated evidence, and groups among themselves are
    nearly independent, which is what makes a probe selective.
    """
    share = np.diag(moments) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-9))
    relation = np.abs(moments / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(relation, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        first = max(left, key=lambda b: (relation[b, left].sum(), -b))
        group = [first]
        left.remove(first)
        while len(group) < width:
            nearest = max(left, key=lambda b: (relation[b, group].sum(), -b))
            group.append(nearest)
            left.remove(nearest)
        groups.append(tuple(sorted(group)))
    return groups


def allot(costs: list[list[float]], total: int) -> tuple[float, tuple[int, ...]]:
    """Thresholds of least summed cost that add up to ``total``; ``costs[i][t + 1]`` is of t from -1 on."""
    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for row in costs:
        step: dict[int, tuple[float, tuple[int, ...]]] = {}
        for so_far, (cost, chosen) in best.items():
            for t, extra in enumerate(row, start=-1):
                option = (cost + extra, (*chosen, t))
                if so_far + t not in step or option < step[so_far + t]:
                    step[so_far + t] = option
        best = step
    return best[total]


def _masked(groups: list[tuple[int, ...]]) -> Column:
    return F.array(*[F.col("fp").bitwiseAND(F.lit(Part(g, 0).mask)) for g in groups])


def plan_parts(distinct: DataFrame, n: int, distance: int = MAX_DISTANCE) -> list[Part]:
    """Partitions and thresholds, by dynamic programming on candidate counts estimated from all rows.

    With ``m`` partitions, thresholds that add up to ``distance - m + 1`` catch every pair within
    the distance: if each partition differed by more than its threshold, the sum would exceed the
    distance. Equal partitions are counted exactly; those within one or more bits are estimated
    from how often the single bits agree.
    """
    moments = bit_moments(distinct)
    share = np.diag(moments) / max(n, 1)
    agree = share**2 + (1 - share) ** 2
    layouts = {m: correlated_groups(moments, n, m) for m in LAYOUTS}
    named = [(m, i, g) for m, groups in layouts.items() for i, g in enumerate(groups)]
    sizes = (
        distinct.select(F.posexplode(_masked([g for *_, g in named])).alias("part", "value"))
        .groupBy("part", "value").agg(F.count(F.lit(1)).cast("double").alias("n"))
        .groupBy("part").agg((F.sum(F.col("n") * (F.col("n") - 1)) / 2).alias("pairs"))
    )
    pairs = {row["part"]: row["pairs"] for row in sizes.collect()}
    options = []
    for m, groups in layouts.items():
        costs = []
        for i, group in enumerate(groups):
            odds = [(1 - agree[b]) / agree[b] for b in group]
            row, probes, hits = [0.0], 0, 0.0
            for t in range(distance + 1):
                probes += len(list(itertools.combinations(range(len(group)), t)))
                hits += _elementary(odds, t)
                row.append(PROBE_COST * probes * n + hits * pairs.get(named.index((m, i, group)), 0.0))
            costs.append(row)
        cost, thresholds = allot(costs, distance - m + 1)
        options.append((cost, m, [Part(g, t) for g, t in zip(groups, thresholds)]))
    return min(options, key=lambda o: o[:2])[2]


def _elementary(values: list[float], order: int) -> float:
    """Sum over all ``order``-subsets of the product of their values."""
    sums = [1.0] + [0.0] * order
    for v in values:
        for k in range(order, 0, -1):
            sums[k] += v * sums[k - 1]
    return sums[order]


# -- probing and verification


def _flips(bits: tuple[int, ...], most: int) -> list[int]:
    """Masks that flip up to ``most`` of the bits; the first flips none."""
    return [
        _signed(sum(1 << b for b in chosen)) for k in range(most + 1) for chosen in itertools.combinations(bits, k)
    ]


def near_pairs(distinct: DataFrame, parts: list[Part], distance: int = MAX_DISTANCE) -> DataFrame:
    """Edges ``(a, b)`` between fingerprints that connect exactly what lies within the distance.

    Every fingerprint is filed under its value in each used partition and probes all values within
    the partition's threshold. Buckets of up to ``PAIRWISE_BUCKET`` rows are joined with themselves
    and verified. In a larger bucket, a group of near copies, pairs are not formed: two fingerprints
    differ in two bits or fewer just when some value lies within one bit of both, so each is filed
    under itself and its 64 one-bit neighbours, and the at most 65 rows that meet in one of these
    link to the smallest. That is exact and grows in proportion to the rows.
    """
    if distance != 2:
        raise ValueError("large buckets are linked through one-bit neighbours, which holds for distance 2")
    def keys(at: int, part: Part) -> Column:
        own = F.col("fp").bitwiseAND(F.lit(part.mask))
        return F.transform(
            F.array(*[F.lit(x) for x in _flips(part.bits, part.threshold)]),
            lambda x: F.struct(F.lit(at).alias("part"), own.bitwiseXOR(x).alias("value"), (x == 0).alias("own")),
        )

    filed = F.flatten(F.array(*[keys(i, p) for i, p in enumerate(parts) if p.threshold >= 0]))
    rows = distinct.select("fp", F.inline(filed))
    sizes = (
        rows.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"), F.count_if("own").alias("n_own"))
        .where("n > 1 and n_own > 0")
    )
    met = stage(rows.join(sizes.select("part", "value", "n"), ["part", "value"]), "buckets")
    small = met.where(F.col("n") <= PAIRWISE_BUCKET)
    pairwise = (
        small.where("own").select("part", "value", F.col("fp").alias("a"))
        .join(small.select("part", "value", F.col("fp").alias("b")), ["part", "value"])
        .where((F.col("a") != F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
        .select("a", "b")
    )
    around = F.array(*[F.lit(x) for x in _flips(tuple(range(BITS)), 1)])
    shared = (
        met.where(F.col("n") > PAIRWISE_BUCKET).select("fp").distinct()
        .select("fp", F.explode(F.transform(around, lambda x: F.col("fp").bitwiseXOR(x))).alias("near"))
        .groupBy("near").agg(F.collect_set("fp").alias("members")).where(F.size("members") > 1)
        .select(F.array_min("members").alias("a"), F.explode("members").alias("b")).where("a != b")
    )
    return pairwise.unionByName(shared)


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, fp, component_id)`` of every row of ``docs``.

    Documents link when their fingerprints differ in two bits or fewer; a component is named by its
    smallest id. Blank and null texts share fingerprint zero and link like any other. Repeated rows
    stay, each with its component; extra columns are not read; a null id belongs to its component
    and does not name it unless the component has no other; no rows give no rows.
    """
    return components_of(stage(fingerprints(docs, id_column, text), "fingerprints"))


def components_of(prints: DataFrame) -> DataFrame:
    """``component_id`` beside the rows of a stored table with columns ``id`` and ``fp``."""
    distinct = stage(prints.groupBy("fp").agg(F.min("id").alias("first_id")), "distinct")
    n = distinct.count()
    edges = near_pairs(distinct, plan_parts(distinct, n))
    roots = connected_components(edges).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return prints.join(named, "fp")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component stays, in the columns of ``docs``: one with the smallest id.

    Of repeated rows with that id, the first in reading order stays.
    """
    row = unused_name(docs, "row")
    stored = stage(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    found = stage(
        stored.select(F.col(id_column).cast("bigint").alias("id"), row, F.col(text).alias("text"))
        .mapInArrow(_fingerprint_rows, "id bigint, row bigint, fp bigint"),
        "fingerprints",
    ).withColumnRenamed("row", row)
    grouped = stage(components_of(found), "components")
    return keep_smallest(stored, grouped, row, "component_id").select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_smallest(stored: DataFrame, grouped: DataFrame, row: str, group: str) -> DataFrame:
    """The rows of ``stored`` less those that ``grouped`` has beside the first with its component's smallest id.

    Rows are dealt by number and meet a hash of the dropped numbers of their share, at every size alike: the
    dropped ones are never sent to all tasks, and the texts are not sorted.
    """
    chosen = grouped.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy(group).agg(F.min(row).alias(row))
    dropped = grouped.join(chosen, row, "left_anti").select(row)
    return stored.join(dropped.hint("shuffle_hash"), row, "left_anti")


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        plain = pa.RecordBatch.from_arrays([batch.column(1), batch.column(2)], ["id", "text"])
        for found in _fingerprint_batches(iter([plain])):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), found.column(0), found.column(1)], ["id", "row", "fp"]
            )
