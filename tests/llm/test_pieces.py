"""SentencePiece ids and decoded texts against the library on whole texts."""

import hashlib
import random
from collections import Counter

import brute
import public_tokenizers
import pytest
import sentencepiece

from ontime.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


def plain(text):
    ids = MODEL.encode(text or "")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(MODEL.decode(ids))


def odd_texts():
    rng = random.Random(3)
    signs = [" ", "  ", "   ", "\n", "\t", "▁", "▁▁", "a", "The", "é", "é", "好", "👍🏽", "\x00", " ", "ﬁ", "<s>", "</s>", "<unk>",
             "<0x41>", "⁇", "\r\n", " ", "﻿", "1234", "don't", "==", "ß", "‍", "퟿", "\U0010ffff", "ing", "  the"]
    texts = ["".join(rng.choices(signs, k=rng.randint(1, 30))) for _ in range(3000)]
    return texts + [" ", "  ", "▁", "", None, "x" * 20_000, "好" * 5000, " " * 3000, "a b " * 20_000]


def test_query_equals_library(spark, folder):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op12_piece_encoding(spark, folder).collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {i: plain(t) for i, t in texts.items()}
    assert len(rows) == len(texts)


@pytest.mark.parametrize("block", [pieces.BLOCK_BYTES, 40])
def test_odd_texts(spark, block):
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in pieces.encode_texts(docs, PATH, block_bytes=block).collect():
        assert r.ids == MODEL.encode(texts[r.id] or ""), repr(texts[r.id])
        assert r.decoded == MODEL.decode(r.ids), repr(texts[r.id])


def test_odd_rows(spark):
    docs = brute.odd_docs(spark).withColumnsRenamed({"row": "ids", "lang": "id"})
    found = pieces.text_digests(pieces.encode_texts(docs, PATH)).collect()
    assert Counter(map(tuple, found)) == Counter((r[0], *plain(r[1])) for r in brute.ROWS)
    assert pieces.encode_texts(docs.limit(0), PATH).count() == 0


def test_models_that_cross_markers_raise():
    class Crossing:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    with pytest.raises(ValueError):
        pieces.check_model(Crossing())
