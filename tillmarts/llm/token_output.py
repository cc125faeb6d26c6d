"""Token ids as Simple-8b blocks.

A block is a row of a Parquet table:

* ``part`` and ``seq``: blocks in this order hold the documents in ascending order of their key;
* ``doc_ids``, ``id_known``: the keys (int64) and whether each is not NULL (one byte);
* ``ends``: per document, where its ids end within the block (uint32), so any document can be
  taken out of a decoded block;
* ``n_ids`` and ``words``: the ids of all its documents as little-endian 64-bit words.

A word's upper four bits are a selector, its lower sixty bits hold the number of ids the selector
names, lowest bits first, each with the same number of bits. Selectors 0 and 1 stand for runs of
zeros without payload; selector 15 is the escape: one id that needs more than 30 bits. Slots of
the last word after ``n_ids`` ids are zero. A block holds whole documents, some ``BLOCK_IDS`` ids
or one longer document, so memory is bounded by the longest document.

Defined results: a NULL or empty text has the end id alone; NULL keys come first; among equal keys
texts are ordered by hash; repeated rows are written once each; an empty table writes no
block; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmarts.llm.common import map_batches
from tillmarts.llm.tokens import encoder

BLOCK_IDS = 1 << 18

# Fixed values of the format: how many ids a word of each selector holds, and bits per id.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

#: What each selector's ids stay below; selector 1 adds nothing to what selector 0 holds.
_LIMITS = np.array([1 << b for b in BITS[:-1]], np.uint64)
_NARROWEST = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)

BLOCK = "part int, seq int, doc_ids binary, id_known binary, ends binary, n_ids int, words binary"


def pack_words(ids: np.ndarray) -> np.ndarray:
    """Ids (below 2**60) as Simple-8b words; each word takes as many ids as fit."""
    n = len(ids)
    values = np.zeros(n + COUNTS[0], np.uint64)
    values[:n] = ids
    if n and int(values.max()) >= 1 << 60:
        raise ValueError("an id needs more than 60 bits")
    # The first selector whose bits hold the value; the zeros behind the end fit any.
    narrowest = _NARROWEST[np.minimum(values, len(_NARROWEST) - 1).astype(np.int64)]
    large = np.nonzero(values >= len(_NARROWEST))[0]
    narrowest[large] = np.searchsorted(_LIMITS, values[large], side="right")
    choice = np.full(n, len(COUNTS) - 1, np.uint8)
    for selector in range(len(COUNTS) - 2, -1, -1):
        fits, length = narrowest <= selector, 1
        while length < COUNTS[selector]:  # so many in a row fit, by doubling
            more = min(length, COUNTS[selector] - length)
            fits = fits[:-more] & fits[more:]
            length += more
        choice[fits[:n]] = selector
    steps = np.array(COUNTS)[choice].tolist()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    begin = np.array(starts, np.int64)
    chosen = choice[begin] if len(begin) else choice[:0]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen):
        count, bits = COUNTS[selector], BITS[selector]
        if bits:
            which = np.nonzero(chosen == selector)[0]
            taken = values[begin[which][:, None] + np.arange(count)]
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            words[which] |= np.bitwise_or.reduce(taken << shifts, axis=1)
    return words


def unpack_words(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of Simple-8b words, one numpy step per selector in use."""
    selectors = (words >> np.uint64(60)).astype(np.uint8)
    ends = np.cumsum(np.array(COUNTS)[selectors])
    out = np.zeros(int(ends[-1]) if len(words) else 0, np.uint64)
    for selector in np.unique(selectors):
        count, bits = COUNTS[selector], BITS[selector]
        if bits:
            which = np.nonzero(selectors == selector)[0]
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            values = (words[which][:, None] >> shifts) & np.uint64((1 << bits) - 1)
            out[(ends[which] - count)[:, None] + np.arange(count)] = values
    return out[:n]


def _encode(path: str, drops_space: bool, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, drops_space)
        part = TaskContext.get().partitionId()
        seq = size = 0
        keys: list = []
        texts: list[bytes] = []

        def block() -> pa.RecordBatch:
            ends = np.cumsum([len(t) // 4 for t in texts]).astype(np.uint32)
            words = pack_words(np.frombuffer(b"".join(texts), "<u4"))
            row = [
                part, seq, np.array([k or 0 for k in keys], np.int64).tobytes(),
                np.array([k is not None for k in keys], np.uint8).tobytes(),
                ends.tobytes(), int(ends[-1]), words.tobytes(),
            ]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
            names = ["part", "seq", "doc_ids", "id_known", "ends", "n_ids", "words"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                if texts and size + len(ids) // 4 > BLOCK_IDS:
                    yield block()
                    seq, size, keys, texts = seq + 1, 0, [], []
                keys.append(key)
                texts.append(ids)
                size += len(ids) // 4
        if texts:
            yield block()

    return run


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 0,
    drops_space: bool = False,
    key: str = "doc_id",
    text: str = "text",
) -> None:
    """Encode every text, append ``end_id`` and write the blocks to ``path`` in the key's order."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)
    map_batches(ordered, BLOCK, _encode(tokenizer, drops_space, end_id)).write.parquet(path)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            words = np.frombuffer(row["words"], "<u8")
            ids = unpack_words(words, row["n_ids"]).astype("<u4")
            ends = np.frombuffer(row["ends"], np.uint32).astype(np.int64)
            begins = np.concatenate([[0], ends[:-1]])
            known = np.frombuffer(row["id_known"], np.uint8).astype(bool)
            keys = np.frombuffer(row["doc_ids"], np.int64)
            data = ids.tobytes()
            sums = [zlib.crc32(memoryview(data)[4 * a : 4 * b]) for a, b in zip(begins, ends)]
            n = len(keys)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, row["part"], np.int32)),
                    pa.array(np.full(n, row["seq"], np.int32)),
                    pa.array(keys, mask=~known),
                    pa.array(begins),
                    pa.array(ends - begins),
                    pa.array(sums, pa.int64()),
                ],
                ["part", "seq", "doc_id", "begin", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the written blocks."""
    blocks = spark.read.schema(BLOCK).parquet(path)
    # Ids before a block: those of earlier parts, and of earlier blocks of its part.
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_part_first"))
    before = W.partitionBy("part").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)
    firsts = blocks.select(
        "part", "seq", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("_block_first")
    ).join(parts, "part")
    found = map_batches(
        blocks, "part int, seq int, doc_id long, begin long, n_tokens long, ids_crc32 long", _decode
    )
    return found.join(firsts, ["part", "seq"]).select(
        "doc_id",
        (F.col("_part_first") + F.col("_block_first") + F.col("begin")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack_words(np.frombuffer(row["words"], "<u8"), row["n_ids"]).astype(np.int64)
            ends = np.frombuffer(row["ends"], np.uint32).astype(np.int32)
            known = np.frombuffer(row["id_known"], np.uint8).astype(bool)
            lists = pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(row["doc_ids"], np.int64), mask=~known), lists], ["doc_id", "ids"]
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids (array of long) of every document."""
    return map_batches(spark.read.schema(BLOCK).parquet(path), "doc_id long, ids array<long>", _texts)
