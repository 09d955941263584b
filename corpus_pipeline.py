"""From raw documents to packed sequences: quality, near-duplicates, mixture, packing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read
again as the next one's ``docs``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ontime.llm import mixing, packing, quality, simhash
from ontime.llm.common import stage, table
from ontime.staging import owner, release

# Owns what a stage keeps on disk beside its result.
INNER = "corpus pipeline"

Step = Callable[[SparkSession, DataFrame, str], DataFrame]


def freeing(step: Step) -> Step:
    """The stage, once what the one before it kept is removed: that one's result is stored by now.

    Folders that ``docs`` itself still reads stay, so stages may also be put together unstored.
    """

    @wraps(step)
    def freed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, INNER, read=docs.inputFiles())
        with owner(spark, INNER, keep=True):
            return step(spark, docs, sf_dir)

    return freed


@freeing
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


@freeing
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: three-word fingerprints linked at two or fewer differing bits."""
    return simhash.keep_one(docs)


@freeing
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs)


@freeing
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens."""
    return packing.piece_digests(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("packing", packed),
]

# Robust estimates take rounds of concentration, components rounds of joins, and tokens a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's own folders go once its result is stored, and that once the next one's is."""
    docs, former = table(spark, sf_dir, "documents"), None
    for name, step in STAGES[:-1]:
        with owner(spark):
            found = step.__wrapped__(spark, docs, sf_dir)
            with owner(spark, f"{name}-{uuid.uuid4().hex}", keep=True) as result:
                docs = stage(found, name)
        if former:
            release(spark, former)
        former = result
    return STAGES[-1][1].__wrapped__(spark, docs, sf_dir)
