"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how common each pair is.

A first pass stores both tokenizers' ids of every document. The distinct linked pairs get a minimal
perfect hash, so a task counts the documents of each pair in a dense vector with one slot a pair and no
keys; the vectors are summed in a tree of groups of tasks. A second pass aligns the stored ids again,
looks each link's count up by its hash, and checks the key that the slot belongs to.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import stage
from ontime.llm.pieces import MARK, check_model, marked_words

# Pairs whose hash, keys and counts a task holds at once (12 bytes each and a few bits). More pairs are counted
# and looked up in as many passes as it takes, each over a range of first ids.
PAIRS_AT_ONCE = 4_000_000
# Pairs in a shard of the hash, slots in a piece of a count vector, vectors that one task adds up.
SHARD, SLOTS, FAN_IN = 1 << 16, 1 << 16, 16
SPACIOUS = 2  # bits a key and level of the hash
_MULTIPLY = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

# Characters on whose kind all versions of Unicode agree. Texts of these are encoded with the first tokenizer's
# ranks, which is several times as fast; others with the tokenizer itself. The ids are the same.
_SETTLED = re.compile("[^\u0000-\u024f\u2010-\u2027\u2030-\u205e\u20ac]")
# Fixed value: how byte-level tokenizers of this family part a text.
_PARTS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# -- tokens of a document


@cache
def _models(a_path: str, b_path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=b_path)


@cache
def _ranked(a_path: str, b_path: str):
    """The first tokenizer by its ranks: its ids rise with its merges."""
    import tiktoken

    ranks = {token: i for i, token in enumerate(token_bytes(a_path, b_path)[0])}
    return tiktoken.Encoding("ranked", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={})


def _encoded(paths: tuple[str, str], text: str) -> list[int]:
    """Ids of the first tokenizer."""
    if _SETTLED.search(text):
        return _models(*paths)[0].encode(text, add_special_tokens=False).ids
    return _ranked(*paths).encode_ordinary(text)


@cache
def token_bytes(a_path: str, b_path: str) -> tuple[list[bytes], list[bytes]]:
    """The bytes of each token of either tokenizer, by id."""
    a, b = _models(a_path, b_path)
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]  # fixed values: bytes that byte-level pieces write as themselves
    other = [x for x in range(256) if x not in kept]
    letters = {chr(x): x for x in kept} | {chr(256 + k): x for k, x in enumerate(other)}
    first = [bytes(letters[c] for c in a.id_to_token(i)) for i in range(a.get_vocab_size(with_added_tokens=False))]
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    second = [
        bytes([int(p[3:5], 16)]) if b.is_byte(i) else b"" if b.is_control(i) or b.is_unknown(i) else p.replace(MARK, " ").encode()
        for i, p in enumerate(pieces)
    ]
    return first, second


_TOKENS = "id bigint, a binary, b binary, n_groups bigint, groups {}"


def _second_ids(paths: tuple[str, str], texts: list[str]) -> list[bytes | None]:
    """Ids of the second tokenizer as 16-bit numbers, each distinct marked word encoded once; None where bytes get lost."""
    model, token = _models(*paths)[1], token_bytes(*paths)[1]
    lone = [model.piece_to_id(MARK)]
    words = [marked_words(text) for text in texts]
    distinct = list({word for some in words for word in some})
    table: dict[str, bytes | None] = {}
    for word, ids in zip(distinct, model.encode(distinct, num_threads=1)):
        ids = ids or lone
        table[word] = array("H", ids).tobytes() if b"".join([token[i] for i in ids]) == (" " + word).encode() else None
    found = [[table[word] for word in some] for some in words]
    # A marker in the text itself comes back as a space.
    return [None if MARK in text or None in parts else b"".join(parts) for text, parts in zip(texts, found)]


def _token_rows(paths: tuple[str, str], as_text: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        check_model(_models(*paths)[1])
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                texts = [t or "" for t in some.column(1).to_pylist()]
                b = _second_ids(paths, texts)
                a = [array("H", _encoded(paths, " " + t)).tobytes() if t and y is not None else b"" for t, y in zip(texts, b)]
                b = [y or b"" for y in b]
                n, groups = _groups(paths, *([np.frombuffer(x, np.uint16) for x in side] for side in (a, b)))
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0), pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(n, pa.int64()),
                        pa.array([g.decode() if as_text else hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string()),
                    ],
                    ["id", "a", "b", "n_groups", "groups"],
                )

    return rows


@cache
def _written() -> list[bytes]:
    """Every 16-bit id in decimals, with a comma, then a bar, then a semicolon after it."""
    return [b"%d%c" % (i, sign) for sign in b",|;" for i in range(1 << 16)]


def _groups(paths: tuple[str, str], a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, list[bytes]]:
    """How many groups each document has, and the groups as text."""
    a_ids, b_ids = np.concatenate(a), np.concatenate(b)
    a_sizes, b_sizes = _byte_sizes(paths)
    a_end, b_end = np.cumsum(a_sizes[a_ids]), np.cumsum(b_sizes[b_ids])
    a_last, b_last = _ends_at(b_end)[a_end], _ends_at(a_end)[b_end]  # the tokens that end a group
    a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
    # A group's tokens of the first tokenizer stand before those of the second.
    a_after, b_after = np.cumsum(np.bincount(a_group)), np.cumsum(np.bincount(b_group))
    b_before = np.concatenate(([0], b_after))
    told = np.empty(len(a_ids) + len(b_ids), np.int64)
    told[np.arange(len(a_ids)) + b_before[a_group]] = a_ids + (a_last.astype(np.int64) << 16)
    told[np.arange(len(b_ids)) + a_after[b_group]] = b_ids + (b_last.astype(np.int64) << 17)
    written, out, at = _written(), [], 0
    for x, y in zip(a, b):
        size = len(x) + len(y)
        out.append(b"".join([written[i] for i in told[at : at + size].tolist()])[:-1])
        at += size
    ends = np.concatenate(([0], np.cumsum(a_last)))
    stops = np.cumsum([0] + [len(x) for x in a])
    return np.diff(ends[stops]), out


def _ends_at(ends: np.ndarray) -> np.ndarray:
    """For each place in a text, whether a token ends there."""
    flags = np.zeros(ends[-1] + 1 if len(ends) else 1, bool)
    flags[ends] = True
    return flags


def aligned_tokens(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text: str = "text", as_text: bool = True
) -> DataFrame:
    """``(id, a, b, n_groups, groups)``: both tokenizers' ids of ``" " + text`` as little-endian 16-bit numbers, and
    the groups between bytes where both have a token's end, as ``a1,a2|b1;a3|b2`` or as that text's SHA-256.

    A null or empty text, or one whose bytes either tokenizer does not give back, has no tokens.
    """
    return docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _token_rows((a_path, b_path), as_text), _TOKENS.format("string")
    )


# -- links of stored documents


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """16-bit ids of all rows in one array, and how many each row has."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), "<u2"), np.array([len(r) // 2 for r in rows], np.int64)


def links(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of all overlapping pairs, from the sizes in bytes of two coverings of the same text.

    Documents lie one after the other, as a document's end is a token's end in both.
    """
    a_end, b_end = np.cumsum(a_sizes[a]), np.cumsum(b_sizes[b])
    ended = np.cumsum(_ends_at(b_end), dtype=np.int64)  # tokens of the second that end at a place or before
    first = ended[a_end - a_sizes[a]]
    n = ended[a_end - 1] - first + 1
    left = np.repeat(np.arange(len(a)), n)
    return left, np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


@cache
def _byte_sizes(paths: tuple[str, str]) -> tuple[np.ndarray, np.ndarray]:
    a, b = token_bytes(*paths)
    return np.array(list(map(len, a)), np.int64), np.array(list(map(len, b)), np.int64)


def _batch_links(paths: tuple[str, str], batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Of each link in a batch: the row, and the pair of ids as one number."""
    a, a_count = _joined(batch.column("a"))
    b, _ = _joined(batch.column("b"))
    left, right = links(a, b, *_byte_sizes(paths))
    rows = np.repeat(np.arange(batch.num_rows), a_count)[left]
    return rows, a[left].astype(np.uint32) << np.uint32(16) | b[right].astype(np.uint32)


def _small(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices with about so many bytes of ids, and one row at least."""
    for batch in batches:
        sizes = np.array([len(x) + len(y) for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())])
        part = np.cumsum(sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(i, j - i) for i, j in zip(cuts, cuts[1:]) if j > i)


# -- a minimal perfect hash over distinct pairs


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLY[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLY[1]
    return x ^ (x >> np.uint64(31))


def shard_levels(keys: np.ndarray, most: int = 64) -> list[np.ndarray]:
    """Bits per level: a key stands at the first level where no other key of that level has its place."""
    levels = []
    for level in range(most):
        if not len(keys):
            return levels
        at = (_mixed(keys, level) % np.uint64(max(64, SPACIOUS * len(keys)))).astype(np.int64)
        alone = np.bincount(at, minlength=max(64, SPACIOUS * len(keys))) == 1
        levels.append(alone)
        keys = keys[~alone[at]]
    raise RuntimeError("keys repeat")


@dataclass
class PairHash:
    """A minimal perfect hash of 32-bit keys: shards of bit levels, ranked over all their bits in one row."""

    starts: np.ndarray  # shard x level: the first bit, and the number of bits (0: no such level)
    sizes: np.ndarray
    bits: np.ndarray  # packed into 64-bit words
    ranks: np.ndarray  # bits set before each word

    @classmethod
    def of(cls, shards: list[list[np.ndarray]]) -> PairHash:
        depth = max(map(len, shards), default=0)
        sizes = np.array([[len(x) for x in s] + [0] * (depth - len(s)) for s in shards], np.int64).reshape(len(shards), depth)
        starts = (np.cumsum(sizes) - sizes.ravel()).reshape(sizes.shape)
        flat = np.concatenate([x for s in shards for x in s]) if shards else np.zeros(0, bool)
        packed = np.packbits(np.pad(flat, (0, -len(flat) % 64)), bitorder="little").view(np.uint64)
        ranks = np.cumsum(np.bitwise_count(packed).astype(np.int64))
        return cls(starts, sizes, packed, ranks - np.bitwise_count(packed))

    @property
    def n(self) -> int:
        return int(self.ranks[-1] + np.bitwise_count(self.bits[-1])) if len(self.bits) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; what is not a key gets some slot or -1, so slots are to be verified."""
        shard = (_mixed(keys, 1 << 20) % np.uint64(max(1, len(self.sizes)))).astype(np.int64)
        found, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level in range(self.sizes.shape[1] if len(self.sizes) else 0):
            size = self.sizes[shard[todo], level]
            todo, size = todo[size > 0], size[size > 0]
            at = self.starts[shard[todo], level] + (_mixed(keys[todo], level) % size.astype(np.uint64)).astype(np.int64)
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit & np.uint64(1)).astype(bool)
            before = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            found[todo[here]] = (self.ranks[at >> 6] + before)[here]
            todo = todo[~here]
        return found


def hash_shards(pairs: DataFrame, n: int, shard: int = SHARD) -> list[list[np.ndarray]]:
    """The levels of every shard, each built in a task from some ``shard`` pairs."""
    count = -(-n // shard)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy().astype(np.uint32)
            at = (_mixed(keys, 1 << 20) % np.uint64(count)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(0)], ["shard", "pair"])

    def build(table: pa.Table) -> pa.Table:
        levels = shard_levels(np.sort(table.column("pair").to_numpy()).astype(np.uint32))
        packed = [np.packbits(x, bitorder="little").tobytes() for x in levels]
        return pa.table({
            "shard": table.column("shard").slice(0, 1), "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int64())),
            "bits": pa.array([packed], pa.list_(pa.binary())),
        })

    built = pairs.mapInArrow(numbered, "shard int, pair bigint").groupBy("shard").applyInArrow(
        build, "shard int, sizes array<bigint>, bits array<binary>"
    )
    found: list[list[np.ndarray]] = [[] for _ in range(count)]
    for r in built.collect():
        found[r.shard] = [
            np.unpackbits(np.frombuffer(bits, np.uint8), count=size, bitorder="little").astype(bool)
            for size, bits in zip(r.sizes, r.bits)
        ]
    return found


# -- counts by slot


def _split(vector: np.ndarray, task: int, slots: int) -> pa.RecordBatch:
    """A dense vector in pieces; pieces without a count are left out."""
    pieces = [(k // slots, vector[k : k + slots]) for k in range(0, len(vector), slots)]
    pieces = [(k, x) for k, x in pieces if x.any()]
    packed = [pa.compress(x.astype("<i8").tobytes(), codec="zstd", asbytes=True) for _, x in pieces]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in pieces], pa.int32()), pa.array([task] * len(pieces), pa.int32()),
         pa.array([len(x) for _, x in pieces], pa.int32()), pa.array(packed, pa.binary())],
        ["piece", "task", "size", "counts"],
    )


_VECTORS = "piece int, task int, size int, counts binary"


def _unpacked(size: int, packed: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, decompressed_size=8 * size, codec="zstd", asbytes=True), "<i8")


def tree_sum(vectors: DataFrame, tasks: int, fan_in: int = FAN_IN) -> DataFrame:
    """One vector for each piece: ``fan_in`` vectors at most are added in a task, in as many rounds as it takes."""

    def add(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        total = reduce(np.add, (_unpacked(r["size"], r["counts"]) for r in rows))
        return pa.table({
            "piece": pa.array([key[0].as_py()], pa.int32()), "task": pa.array([key[1].as_py()], pa.int32()),
            "size": pa.array([len(total)], pa.int32()),
            "counts": pa.array([pa.compress(total.tobytes(), codec="zstd", asbytes=True)], pa.binary()),
        })

    while tasks > 1:
        vectors = stage(
            vectors.withColumn("task", F.expr(f"task div {fan_in}").cast("int")).groupBy("piece", "task").applyInArrow(add, _VECTORS),
            "vectors",
        )
        tasks = -(-tasks // fan_in)
    return vectors


def _within(pairs: np.ndarray, low: int, high: int) -> np.ndarray:
    return (pairs >> np.uint32(16) >= low) & (pairs >> np.uint32(16) < high)


def _unique(rows: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Each pair once for each row that has it."""
    return (np.unique(rows.astype(np.uint64) << np.uint64(32) | pairs) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def distinct_pairs(tokens: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """``pair``: each linked pair of ids once, combined in a task before it is shuffled."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, fresh = np.zeros(0, np.uint32), []
        for batch in _small(batches):
            fresh.append(np.unique(_batch_links(paths, batch)[1]))
            if sum(map(len, fresh)) > max(1 << 20, len(seen)):
                seen, fresh = np.unique(np.concatenate([seen, *fresh])), []
        seen = np.unique(np.concatenate([seen, *fresh]))
        for k in range(0, len(seen), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(seen[k : k + (1 << 16)].astype(np.int64))], ["pair"])

    return tokens.select("a", "b").mapInArrow(rows, "pair bigint").distinct()


def id_ranges(pairs: DataFrame, at_once: int) -> list[tuple[int, int, int]]:
    """``(low, high, pairs)``: ranges of first ids with at most ``at_once`` pairs each (or a single id).

    The counts by id that come to the driver are bounded by the vocabulary.
    """
    by_id = pairs.groupBy(F.shiftright("pair", 16).alias("a")).agg(F.count(F.lit(1)).alias("n")).orderBy("a").collect()
    ranges: list[list[int]] = []
    for r in by_id:
        if not ranges or ranges[-1][2] + r.n > at_once:
            ranges.append([r.a, r.a + 1, 0])
        ranges[-1][1] = r.a + 1
        ranges[-1][2] += r.n
    return [tuple(x) for x in ranges]


def _counted(tokens: DataFrame, paths: tuple[str, str], hashed, low: int, high: int, slots: int) -> DataFrame:
    """Dense vectors of one task each: how many of its documents hold a pair linked, by the pair's slot."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, keys = hashed.value
        vector = np.zeros(index.n, np.int64)
        for batch in _small(batches):
            pairs = _unique(*_batch_links(paths, batch))
            pairs = pairs[_within(pairs, low, high)]
            vector += np.bincount(_verified(index, keys, pairs), minlength=index.n)
        yield _split(vector, TaskContext.get().partitionId(), slots)

    return tokens.select("a", "b").mapInArrow(rows, _VECTORS)


def _verified(index: PairHash, keys: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    at = index.find(pairs)
    if len(at) and (at.min() < 0 or not np.array_equal(keys[at], pairs)):
        raise RuntimeError("a linked pair is not among the distinct pairs")
    return at


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
_RESULT = (
    "row bigint, id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def _looked_up(tokens: DataFrame, paths: tuple[str, str], counted, low: int, high: int) -> DataFrame:
    """Every row, with ``n_links, n_best, count_sum`` over the links whose first id is in the range."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, keys, counts, best = counted.value
        for batch in _small(batches):
            row, pairs = _batch_links(paths, batch)
            inside = _within(pairs, low, high)
            row, pairs = row[inside], pairs[inside]
            found = counts[_verified(index, keys, pairs)]
            highest = found == best[(pairs >> np.uint32(16)).astype(np.int64) - low]
            n = batch.num_rows
            sums = np.zeros(n, np.int64)
            np.add.at(sums, row, found)
            columns = {name: batch.column(name) for name in batch.schema.names}
            columns |= {"n_a": pa.array(_joined(batch.column("a"))[1]), "n_b": pa.array(_joined(batch.column("b"))[1])}
            columns |= {"n_links": pa.array(np.bincount(row, minlength=n)), "n_best": pa.array(np.bincount(row[highest], minlength=n))}
            columns |= {"count_sum": pa.array(sums), "groups_sha256": batch.column("groups")}
            names = [part.split()[0] for part in _RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays([columns[name] for name in names], names)

    return tokens.select("row", "id", "a", "b", "n_groups", "groups").mapInArrow(rows, _RESULT)


def align(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text: str = "text", pairs_at_once: int = PAIRS_AT_ONCE,
    shard: int = SHARD, slots: int = SLOTS, fan_in: int = FAN_IN,
) -> DataFrame:
    """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` of every row.

    Tokens are linked where their bytes overlap; a pair of ids counts the rows that hold it linked. A null
    or empty text, or one whose bytes either tokenizer changes, has no tokens and zeros. Repeated rows count
    again; an id may be null; extra columns are not read; no rows give no rows.

    What tasks get of the pairs is bounded by ``pairs_at_once``: hash, keys and counts of one range of
    first ids at a time.
    """
    paths, spark = (a_path, b_path), docs.sparkSession
    tokens = stage(
        aligned_tokens(docs, a_path, b_path, id_column, text, as_text=False).withColumn("row", F.monotonically_increasing_id()), "tokens"
    )
    pairs = stage(distinct_pairs(tokens, paths), "pairs")
    partitions = tokens.rdd.getNumPartitions()
    found = []
    for low, high, n in id_ranges(pairs, pairs_at_once):
        here = pairs.where(F.shiftright("pair", 16).between(low, high - 1))
        index = PairHash.of(hash_shards(here, n, shard))
        keys = np.zeros(index.n, np.uint32)
        own = here.toArrow().column(0).to_numpy().astype(np.uint32)
        keys[index.find(own)] = own
        hashed = spark.sparkContext.broadcast((index, keys))
        vectors = stage(_counted(tokens, paths, hashed, low, high, slots), "vectors")
        counts = np.zeros(index.n, np.int64)
        for r in tree_sum(vectors, partitions, fan_in).collect():
            counts[r.piece * slots : r.piece * slots + r.size] += _unpacked(r.size, r.counts)
        best = np.zeros(high - low, np.int64)
        np.maximum.at(best, (keys >> np.uint32(16)).astype(np.int64) - low, counts)
        found.append(_looked_up(tokens, paths, spark.sparkContext.broadcast((index, keys, counts, best)), low, high))
    if not found:  # no document has tokens
        zero = F.lit(0).cast("bigint")
        return tokens.select("id", *[zero.alias(c) for c in _NUMBERS], F.col("groups").alias("groups_sha256"))
    looked = reduce(DataFrame.unionByName, found)
    if len(found) > 1:
        sums = ["n_links", "n_best", "count_sum"]
        looked = looked.groupBy(*[c for c in looked.columns if c not in sums]).agg(*[F.sum(c).alias(c) for c in sums])
    return looked.select("id", *_NUMBERS, "groups_sha256")
