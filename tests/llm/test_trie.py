"""The prefix trie of conversations against a plain one."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from ontime.llm import queries, trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    """Nodes from a dictionary of all prefixes."""
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(found)] for c, found in turns.items()}
    full = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        full[c] = tuple(own.get(c - c % 20, [])[:h] + own[c][h:])
    members, kids = defaultdict(list), defaultdict(set)
    for c, said in full.items():
        for d in range(len(said) + 1):
            members[said[:d]].append(c)
            if d:
                kids[said[: d - 1]].add(said[:d])
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        tokens = len(brute.words(node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * tokens
    return Counter(
        (
            min(found), len(node), min(members[node[:-1]]) if node else None, len(found), len(kids[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(str(c) for c in sorted(found) if len(full[c]) == len(node)).encode()).hexdigest(),
        )
        for node, found in members.items()
    )


def nodes(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def talk(seed, n, longest, words=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 2, 3, 4, longest])):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(["a"] * rng.randint(0, words)), None))
    return rows


ODD = [
    (0, 0, "user", "hi there", "x"), (0, 1, "assistant", "hello", "x"), (0, 1, "assistant", "hello", "x"), (0, None, None, None, None),
    (1, None, "user", "hi there", None), (2, 5, "user", None, None), (2, 5, "user", "", None), (3, 0, "", "", None),
    (None, 0, "user", "nobody", None), (17, 0, "user", " \t\n\x0b\x0c\r ", None), (40, 0, "user", "w " * 50_000, None),
    (41, 0, "user", "w " * 50_000, None), (45, 0, "u", "x", None), (65, 9, "u", "x", None), (-21, 0, "u", "y", None),
]


def test_query_equals_plain(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = queries.op13_conversation_trie(spark, folder)
    assert found.columns == COLUMNS
    assert nodes(found) == plain(rows)


def sql_nodes(path):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}'")
    found = connection.sql(trie.SQL)
    assert found.columns == COLUMNS and set(map(str, found.types)) == {"BIGINT", "VARCHAR"}
    return Counter(found.fetchall())


def test_sql_equals_plain(spark, folder, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sql_nodes(f"{folder}/conversations.parquet") == plain(rows)
    some = [r for r in ODD if r[0] is None or r[0] >= 0] + talk(8, 90, 9)[60:]
    spark.createDataFrame(some, SCHEMA).write.parquet(str(tmp_path / "odd"))
    assert sql_nodes(f"{tmp_path}/odd/*.parquet") == plain(some)


@pytest.mark.parametrize("chunk,block,ids", [(256, 20_000, 16_384), (2, 3, 2), (3, 1, 1)])
def test_odd_rows(spark, chunk, block, ids):
    rows = [r for r in ODD if r[0] is None or r[0] >= 0]
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert nodes(trie.conversation_trie(table, chunk, block, ids)) == plain(rows)
    assert trie.conversation_trie(table.limit(0), chunk, block, ids).count() == 0


@pytest.mark.parametrize("chunk,block", [(2, 2), (4, 7), (256, 5)])
def test_chunks_and_blocks_change_nothing(spark, chunk, block):
    rows = talk(chunk, 150, 13)
    # A third of all rows are copies of one conversation, and one conversation is long.
    rows += [(c, t, "user", "same", None) for c in range(1000, 1060) for t in range(3)]
    rows += [(2001, t, "user", "long", None) for t in range(90)] + [(2002, t, "user", "long", None) for t in range(85)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert nodes(trie.conversation_trie(table, chunk, block, 7)) == plain(rows)


def test_turns_are_numbered_across_partitions(spark):
    """One conversation spread over all partitions, beside others."""
    rows = [(5, t, "user", f"t{t}", None) for t in range(400)] + [(c, t, "user", "x", None) for c in (4, 6) for t in range(9)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = trie.numbered_turns(table).groupBy("conv").agg(F.sort_array(F.collect_list("pos")).alias("pos")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.conv: r.pos for r in found} == {5: list(range(400)), 4: list(range(9)), 6: list(range(9))}
