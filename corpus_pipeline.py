"""A training corpus from raw documents: drop toxic ones, drop copies, drop near copies, mix, pack.

Each stage takes (spark, docs, folder) and returns a frame, which is written and read again as the
next stage's documents. All but the last return the columns of ``documents``; the last one returns
the pieces of the packed sequences.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillmarts.llm import exact_dedup, jaccard_join, mixing, packing, toxicity
from tillmarts.llm.common import table
from tillmarts.llm.queries import held_out
from tillmarts.storage import materialize

TOKENIZER = "word_bpe_49k.json"
END_ID = 1


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that score below the threshold; the held-out fold of labels is left alone."""
    labels = table(spark, folder, "labels").filter(~held_out())
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One row of each text, the one with the largest key."""
    index = f"corpus_digests_{uuid.uuid4().hex}"
    kept = exact_dedup.drop_duplicates(spark, docs, index)
    spark.sql(f"DROP TABLE {index}")  # the fates of all rows are written by now
    return kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 on five-word shingles."""
    return jaccard_join.keep_one(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Sources repeated to their target weights."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""
    path = public_tokenizers.path(TOKENIZER)
    pieces = packing.cut(docs, path, end_id=END_ID, drops_space=True)
    return packing.pack(pieces).drop("task", "number")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can't express the toxicity model nor the tokenizer; tests/llm compares with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, folder), f"pipeline-{name}")
    return docs
