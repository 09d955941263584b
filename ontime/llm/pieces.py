"""SentencePiece ids and decoded texts by a table of distinct chunks.

The model's pieces hold white-space markers at their start only, so no merge ever joins what stands
before a run of markers to the run. A text is therefore the sequence of its marked words, and its ids
are theirs. A task takes its documents in blocks, codes every word of a block by its place in the
block's table of distinct words, segments and decodes each word of that table once, and joins ids and
text back by position. Nothing is shuffled and a block bounds the memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
# A block ends with the document that reaches so many bytes of text.
BLOCK_BYTES = 6 << 20
_ANCHOR = f"{MARK}a"
_MARKED = re.compile(" +[^ ]*")


class _Places(dict):
    """Distinct words in the order in which they come."""

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self)
        return found


@cache
def _processor(path: str):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    check_model(model)
    return model


def check_model(model) -> None:
    """Raise unless ids of a text are those of its marked words: markers at the start of pieces only, none
    added, dropped or merged beside the one that begins a text, and every character kept."""
    inside = re.compile(f"[^{MARK}]{MARK}")
    if any(inside.search(model.id_to_piece(i)) for i in range(model.get_piece_size())):
        raise ValueError("some pieces hold a white-space marker after another character")
    probe = " a  B ﬁ\t\n   "
    if model.decode(model.encode(probe)) != probe or model.encode_as_pieces("a")[0][0] != MARK:
        raise ValueError("this model changes texts before it segments them")
    if model.piece_to_id(_ANCHOR) == model.unk_id() or model.piece_to_id(MARK) == model.unk_id():
        raise ValueError("this model has no piece for the marker, or for a marked letter")


def marked_words(text: str) -> list[str]:
    """The words of a text, each without the space before it; a longer run of spaces stays with the word after it.

    The marker character counts as a space, as it does to the model. An empty text has no words.
    """
    if not text:
        return []
    text = text.replace(MARK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return [word[1:] for word in _MARKED.findall(" " + text)]
    return text.split(" ")


def word_table(path: str, words: list[str]) -> tuple[list[bytes], list[str]]:
    """Ids (little-endian 32-bit) and decoded text of each marked word, its own space included."""
    model = _processor(path)
    lone, anchor = model.piece_to_id(MARK), model.piece_to_id(_ANCHOR)
    ids = [found or [lone] for found in model.encode(words, num_threads=1)]
    # A decoded sequence loses the space that begins it, so an anchor takes that place.
    texts = [text[1:] for text in model.decode([[anchor, *found] for found in ids], num_threads=1)]
    return [np.array(found, "<i4").tobytes() for found in ids], texts


def _coded_rows(path: str, block_bytes: int):
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])

    def finish(ids: list, codes: list[np.ndarray], places: _Places) -> Iterator[pa.RecordBatch]:
        table, texts = word_table(path, list(places)) if places else ([], [])
        for k in range(0, len(ids), 256):
            some = [c.tolist() for c in codes[k : k + 256]]
            found = [b"".join(map(table.__getitem__, c)) for c in some]
            ends = np.cumsum([0] + [len(x) // 4 for x in found], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))
            decoded = ["".join(map(texts.__getitem__, c))[1:] for c in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[k : k + 256], pa.int64()), lists, pa.array(decoded, pa.string())], schema=schema
            )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, codes, places, held = [], [], _Places(), 0
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                for i, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    words = marked_words(text or "")
                    ids.append(i)
                    codes.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
                    held += len(text or "")
                    if held >= block_bytes:
                        yield from finish(ids, codes, places)
                        ids, codes, places, held = [], [], _Places(), 0
        yield from finish(ids, codes, places)

    return rows


def encode_texts(
    docs: DataFrame, model_path: str, id_column: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``(id, ids, decoded)`` of every row: the ids that the model's library gives the whole text, without
    begin or end ids, and what it decodes them to.

    A null text is empty and has no ids; an id may be null; repeated rows stay; extra columns are not read;
    no rows give no rows. Models whose pieces cross markers, or that change texts, raise.
    """
    return docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _coded_rows(model_path, block_bytes), "id bigint, ids array<int>, decoded string"
    )


def text_digests(coded: DataFrame) -> DataFrame:
    """Number and SHA-256 of the ids, and SHA-256 of the decoded text, in place of both."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(joined.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
