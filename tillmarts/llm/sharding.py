"""Shards by rendezvous hashing.

Every shard gives a record a score from the record's stable key, the shard's number and the
shard's weight; the highest score wins. A new shard changes no other shard's score, so adding one
moves only the records it wins, and removing one moves only its own. Nothing but the key and the
weights decides, so placing a record needs no shuffle; only the slot numbers do.

Defined results: a NULL key is a key like any other (all such records share a shard); a NULL text
has size 1 like an empty one; repeated rows get the same shard and slots of their own; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmarts.storage import materialize

#: Rows that one task numbers, about.
CHUNK_ROWS = 200_000


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard, 0 to ``len(weights) - 1``, that wins ``key``.

    With u uniform in (0, 1), the score -weight / ln(u) makes a shard win in proportion to its
    weight. Shards of weight 0 win nothing.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("at least one weight must be above 0")

    def score(shard: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.coalesce(key.cast("string"), F.lit("null")), F.lit(shard)), 12)
        u = (bits + F.lit(0.5)) / F.lit(float(1 << 52))
        return F.struct((F.lit(-float(weight)) / F.log(u)).alias("score"), F.lit(shard).alias("shard"))

    scores = [score(i, w) for i, w in enumerate(weights) if w > 0]
    return (F.greatest(*scores) if len(scores) > 1 else scores[0])["shard"]


def slots(df: DataFrame, shard: str, spread: Sequence[str]) -> DataFrame:
    """``df`` with ``slot``: 0, 1, 2 ... within each shard.

    No shard is numbered in one task: rows are dealt to chunks by a hash of ``spread``, chunks are
    counted, and each chunk numbers its rows from the sum of the chunks before it.
    """
    chunks = max(1, -(-df.count() // CHUNK_ROWS))
    dealt = df.withColumn("_chunk", F.pmod(F.xxhash64(F.lit(7), *spread), F.lit(chunks)).cast("int"))
    counts = dealt.groupBy(shard, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(shard).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select(shard, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    numbered = dealt.withColumn(
        "_number", F.row_number().over(W.partitionBy(shard, "_chunk").orderBy(*spread)) - 1
    )
    return numbered.join(firsts, [shard, "_chunk"]).select(
        *df.columns, (F.col("_first") + F.col("_number")).cast("long").alias("slot")
    )


def place(
    docs: DataFrame, weights: Sequence[float], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per record: doc_id, size (bytes of the text and 1), text_crc32, law, shard, slot and
    grown_shard, the shard it would have if one more of the mean weight were added."""
    grown = [*weights, sum(weights) / len(weights)]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    rows = rows.select(
        "*",
        F.lit("key").alias("law"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), grown).alias("grown_shard"),
    )
    # Written once: counting and numbering then read narrow rows, not texts.
    rows = materialize(rows, "placed")
    return slots(rows, "shard", ["doc_id", "text_crc32", "size"])


def write_shards(docs: DataFrame, weights: Sequence[float], path: str, key: str = "doc_id") -> None:
    """The records as files, one folder ``shard=N`` each; a heavy shard is written by many tasks."""
    placed = docs.withColumn("shard", rendezvous(F.col(key), weights))
    placed.hint("rebalance", F.col("shard")).write.partitionBy("shard").parquet(path)
