"""Concatenate and cut: token ids of all documents in one stream, cut into fixed windows."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ontime.llm.common import stage

WINDOW = 4096
END_ID = 2
# Words whose ids a worker remembers. More distinct words are encoded again when they come.
REMEMBERED_WORDS = 600_000
_MARKS = frozenset(b"%c" % c for c in b".,;:!?")
_LATIN_END = "\u0250"  # the first letter after the Latin blocks that have no combining forms
_ID_BYTES = 4


@cache
def _tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, pre_tokenizers

    return Tokenizer.from_file(path), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)


class _Ids(dict):
    """Ids of words as little-endian 32-bit numbers, encoded when first asked for."""

    def __init__(self, path: str):
        super().__init__()
        self.path = path

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        if word[-1:] in _MARKS and _only_letters(text[:-1]):
            found = self[word[:-1]] + self[word[-1:]]  # the tokenizer parts letters from what follows them
        else:
            found = np.array(_encode(self.path, text), "<u4").tobytes()
        if len(self) < REMEMBERED_WORDS:
            self[word] = found
        return found


def _only_letters(text: str) -> bool:
    """Lower-case Latin letters only: such a word passes normalisation and splitting unchanged."""
    return text.isalpha() and text == text.lower() and max(text) < _LATIN_END


def _encode(path: str, word: str) -> list[int]:
    tokenizer, as_bytes = _tokenizer(path)
    if _only_letters(word):
        return [token.id for token in tokenizer.model.tokenize(as_bytes.pre_tokenize_str(word)[0][0])]
    return tokenizer.encode(word, add_special_tokens=False).ids


@cache
def _remembered(path: str) -> _Ids:
    return _Ids(path)


def token_bytes(path: str, text: bytes | None) -> bytes:
    """The ids of a whole text as little-endian 32-bit numbers.

    This tokenizer drops white space and never joins what stands on both sides of it, and it lowers
    case itself. So each word is encoded once and its ids are looked up where it comes again. Only
    A-Z is lowered first, and not in texts that may name a special token.
    """
    if not text:
        return b""
    words = (text if b"<|" in text else text.lower()).split()
    return b"".join(map(_remembered(path).__getitem__, words))


def _token_rows(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                ids = [token_bytes(path, t) + end for t in some.column(2).cast(pa.binary()).to_pylist()]
                sizes = np.fromiter((len(x) // _ID_BYTES for x in ids), np.int64, len(ids))
                starts = at + np.cumsum(sizes) - sizes
                at += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(starts), pa.array(sizes), pa.array(ids, pa.binary())],
                    ["id", "part", "start_in_part", "tokens", "ids"],
                )

    return rows


def pack(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text: str = "text",
    window: int = WINDOW, end_id: int = END_ID,
) -> DataFrame:
    """Pieces of documents in windows of ``window`` tokens: ``(id, start, length, ids, doc_tokens,
    sequence_id, offset)``.

    The first pass stores every document's ids with its place among the tokens of its partition. The
    second adds the tokens of all partitions before (one row for each input partition, so it is small
    enough to send to every task) and cuts each document where a window ends; a document that crosses
    a border leaves a record on either side. Only the last window is not full. No row is shuffled.

    A null or blank text is its end token alone; no rows give no pieces; repeated rows are packed
    again; extra columns are not read.
    """
    tokens = stage(
        docs.select(
            F.col(id_column).cast("bigint").alias("id"), F.spark_partition_id().alias("part"), F.col(text).alias("text")
        ).mapInArrow(
            _token_rows(tokenizer_path, end_id),
            "id bigint, part int, start_in_part bigint, tokens bigint, ids binary",
        ),
        "tokens",
    )
    totals = tokens.groupBy("part").agg(F.sum("tokens").alias("total"))
    before = F.coalesce(
        F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    bases = totals.select("part", before.alias("base"))
    placed = tokens.join(F.broadcast(bases), "part").withColumn("at", F.col("base") + F.col("start_in_part"))
    cut = placed.withColumn(
        "sequence_id",
        F.explode(F.sequence(F.expr(f"at div {window}"), F.expr(f"(at + tokens - 1) div {window}"))),
    )
    first = F.greatest(F.col("sequence_id") * window, F.col("at"))
    last = F.least((F.col("sequence_id") + 1) * window, F.col("at") + F.col("tokens"))
    return cut.withColumns({"start": first - F.col("at"), "length": last - first}).select(
        "id", "start", "length",
        F.expr(f"substring(ids, cast(start * {_ID_BYTES} + 1 as int), cast(length * {_ID_BYTES} as int))").alias("ids"),
        F.col("tokens").alias("doc_tokens"), "sequence_id",
        (F.col("at") + F.col("start") - F.col("sequence_id") * window).alias("offset"),
    )


def piece_digests(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )
