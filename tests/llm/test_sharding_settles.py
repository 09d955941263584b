"""Propagation goes on until no wish can be granted: copies that fit together are together."""

from collections import defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from ontime.llm import sharding


def cut_groups(rows, texts):
    """Groups of equal texts under half a shard that lie in more than one shard."""
    shards, sizes = defaultdict(set), defaultdict(int)
    for r in rows:
        shards[texts[r.id]].add(r.shard)
        sizes[texts[r.id]] += 1
    most = len(rows) / (2 * sharding.SHARDS)
    return [t for t, found in shards.items() if len(found) > 1 and sizes[t] <= most], sum(n > 1 for n in sizes.values())


def test_no_group_is_cut(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", F.xxhash64("text").alias("text")).collect()}
    rows = sharding.shard(docs).collect()
    cut, groups = cut_groups(rows, texts)
    assert cut == [] and groups > 500


def test_many_pairs_settle(spark):
    rows = [(i, f"pair {i // 2}", "en", "s", 0, None) for i in range(4000)] + [(4000 + i, f"own {i}", "en", "s", 0, None) for i in range(4000)]
    texts = {r[0]: r[1] for r in rows}
    cut, groups = cut_groups(sharding.shard(brute.odd_docs(spark, rows)).collect(), texts)
    assert cut == [] and groups == 2000


def test_labels_that_do_not_settle_are_an_error(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)], "a bigint, b bigint")
    with pytest.raises(RuntimeError):
        sharding.propagate(edges, 1000, shards=2, rounds=1)
    found = {r.row: r.label for r in sharding.propagate(edges, 1000, shards=2).collect()}
    for row in range(61):  # nobody has more neighbours elsewhere than at home
        around = [found[b] for b in (row - 1, row + 1) if b in found]
        assert around.count(found[row]) >= around.count(1 - found[row])
