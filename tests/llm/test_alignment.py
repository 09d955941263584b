"""Token alignment against a plain version on whole texts."""

import hashlib
import random
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ontime.llm import alignment, queries

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
A.encode_special_tokens = True
BASIC = {chr(n): n for n in [*range(33, 127), *range(161, 173), *range(174, 256)]}
BASIC |= {chr(256 + k): n for k, n in enumerate(n for n in range(256) if chr(n) not in BASIC)}


def spans(text):
    """Both tokenizers' ids with their byte ranges; nothing where bytes get lost."""
    if not text:
        return [], []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    a_bytes = [bytes(BASIC[c] for c in A.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, map(B.id_to_piece, b))]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], []

    def ranges(ids, parts):
        at, out = 0, []
        for i, part in zip(ids, parts):
            out.append((i, at, at + len(part)))
            at += len(part)
        return out

    return ranges(a, a_bytes), ranges(b, b_bytes)


def plain(texts):
    found, counts = [], Counter()
    for text in texts:
        a, b = spans(text)
        linked = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = ";".join(
            ",".join(str(i) for i, _, e in a if low < e <= high) + "|" + ",".join(str(i) for i, _, e in b if low < e <= high)
            for low, high in zip([0, *ends], ends)
        )
        counts.update(set(linked))
        found.append((len(a), len(b), len(ends), linked, hashlib.sha256(groups.encode()).hexdigest() if a else ""))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    return [
        (n_a, n_b, n_groups, len(linked), sum(counts[p] == best[p[0]] for p in linked), sum(counts[p] for p in linked), sha)
        for n_a, n_b, n_groups, linked, sha in found
    ]


def odd_texts():
    rng = random.Random(11)
    signs = [" ", "  ", "\n", " \n", "\t", "▁", "a", "The", "é", "é", "好", "👍🏽", "\x00", "\x1c", " ", "ﬁ", "<|endoftext|>", "</s>", "12",
             "don't", " 's", "==", "\u0085", "　", "ing", " the", "…", "'"]
    return ["".join(rng.choices(signs, k=rng.randint(1, 25))) for _ in range(600)] + [" ", "  ", "▁", "", None, "x" * 3000, "好" * 700]


def test_query_equals_plain(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = [r for r in docs if r.text is None or len(r.text) < 4000]
    found = {r.doc_id: r for r in queries.op11_token_alignment(spark, folder).collect()}
    assert len(found) == len(docs)
    for r, expected in zip(docs, plain([r.text for r in docs])):
        assert tuple(found[r.doc_id])[1:] == expected
    assert short


@pytest.mark.parametrize("at_once,shard,slots,fan_in", [(4_000_000, 1 << 16, 1 << 16, 16), (300, 64, 50, 2)])
def test_odd_texts(spark, at_once, shard, slots, fan_in):
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = alignment.align(docs, A_PATH, B_PATH, pairs_at_once=at_once, shard=shard, slots=slots, fan_in=fan_in).collect()
    assert {r.id: tuple(r)[1:] for r in got} == dict(enumerate(plain(texts)))


def test_odd_rows(spark):
    docs = brute.odd_docs(spark, [r for r in brute.ROWS if len(r[1] or "") < 5000]).withColumnsRenamed({"lang": "row", "row": "a", "source": "n_a"})
    rows = docs.collect()
    found = Counter(map(tuple, alignment.align(docs, A_PATH, B_PATH).collect()))
    assert found == Counter((r.doc_id, *x) for r, x in zip(rows, plain([r.text for r in rows])))
    assert alignment.align(docs.limit(0), A_PATH, B_PATH).count() == 0
    blank = alignment.align(docs.where("doc_id IN (3, 4)"), A_PATH, B_PATH).collect()
    assert [tuple(r)[1:] for r in blank] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_ranks_give_the_ids_of_the_tokenizer():
    rng = random.Random(5)
    settled = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]]
    common = list(" \n  etaoinsrhld'.,1230\u00a0\u0085\t") + ["'s", "'ll", "  ", "\r\n", " the", "ing"]
    for k in range(20_000):
        text = " " + "".join(rng.choices(settled if k % 3 else common, k=rng.randint(1, 30)))
        assert not alignment._SETTLED.search(text)
        assert alignment._encoded((A_PATH, B_PATH), text) == A.encode(text, add_special_tokens=False).ids, repr(text)


def test_groups_are_given_as_text(spark):
    docs = spark.createDataFrame([(1, "don't stop")], "doc_id bigint, text string")
    row = alignment.aligned_tokens(docs, A_PATH, B_PATH).first()
    sides = [g.split("|") for g in row.groups.split(";")]
    assert row.n_groups == len(sides)
    assert [int(i) for a, _ in sides for i in a.split(",")] == A.encode(" don't stop").ids
    assert [int(i) for _, b in sides for i in b.split(",")] == B.encode("don't stop")


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 32, 50_000, dtype=np.uint32))
    count = 9
    shard = (alignment._mixed(keys, 1 << 20) % np.uint64(count)).astype(int)
    index = alignment.PairHash.of([alignment.shard_levels(keys[shard == s]) for s in range(count)])
    assert index.n == len(keys) and sorted(index.find(keys)) == list(range(len(keys)))
    table = np.zeros(index.n, np.uint32)
    table[index.find(keys)] = keys
    strange = np.setdiff1d(rng.integers(0, 1 << 32, 1000, dtype=np.uint32), keys)
    with pytest.raises(RuntimeError):
        alignment._verified(index, table, strange)
