"""Packing documents into sequences of fixed length.

Token ids are cut into pieces of at most ``capacity``; a full piece is a sequence of its own. The
rest of each document goes into one of many random groups, and each group is packed by itself,
longest piece first, each into the first sequence with room (first-fit decreasing). A tournament
tree over the sequences' free room finds it in logarithmic time.

Groups are drawn by hashing a piece's place in the written table of pieces, so they are even
whatever the keys are, and stay the same when a task runs again.

Defined results: a NULL or empty text is the end id alone; NULL and repeated keys are documents
like any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmarts.llm.common import map_batches
from tillmarts.llm.tokens import encoder
from tillmarts.storage import materialize

CAPACITY = 2048
#: Pieces in a group, about. Padding is at most a few sequences per group.
GROUP_PIECES = 8192

PIECE = "task int, number long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece; no length may exceed ``capacity``."""
    n = len(lengths)
    leaves = 1
    while leaves < n:
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins[piece], offsets[piece] = node - leaves, capacity - room[node]
        room[node] -= length
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def _pieces(path: str, drops_space: bool, end_id: int, capacity: int, with_ids: bool):
    end = np.array([end_id], "<u4").tobytes()
    names = ["task", "number", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    kinds = [pa.int32(), *[pa.int64()] * 6]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, drops_space)
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            columns: list[list] = [[] for _ in names]
            bodies: list[bytes] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = encode(text.as_py()) + end
                total = len(data) // 4
                for start in range(0, total, capacity):
                    body = data[4 * start : 4 * (start + capacity)]
                    row = (task, number, key, start, len(body) // 4, zlib.crc32(body), total)
                    for column, value in zip(columns, row):
                        column.append(value)
                    if with_ids:
                        bodies.append(body)
                    number += 1
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            if with_ids:
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(bodies, pa.binary())], [*names, "ids"])
            else:
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def cut(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    drops_space: bool,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """The written pieces of all documents; ``ids`` (little-endian uint32) on request."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = PIECE + ", ids binary" * with_ids
    function = _pieces(tokenizer, drops_space, end_id, capacity, with_ids)
    return materialize(map_batches(rows, schema, function), "pieces")


def _pack_group(capacity: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["task", "number"], ignore_index=True)
        bins, offsets = first_fit_decreasing(pieces["length"].to_numpy(), capacity)
        return pieces.assign(bin=bins, offset=offsets)

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """A place for each piece: the columns of ``pieces`` but ids, sequence_id and offset.

    Sequence ids are unique, not consecutive: odd ones hold one full piece, even ones name a
    group and a sequence in it.
    """
    columns = [c for c in pieces.columns if c != "ids"]
    rows = pieces.select(columns)
    whole = rows.filter(F.col("length") == capacity).select(
        "*",
        ((F.shiftleft(F.col("task").cast("long"), 36) + F.col("number")) * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rest = rows.filter(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_pieces))
    rest = rest.withColumn("group", F.pmod(F.xxhash64("task", "number"), F.lit(groups)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rest.schema) + ", bin long, offset long"
    packed = rest.groupBy("group").applyInPandas(_pack_group(capacity), schema)
    packed = packed.select(
        *columns, ((F.shiftleft(F.col("group"), 24) + F.col("bin")) * 2).alias("sequence_id"), "offset"
    )
    return whole.unionByName(packed)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """sequence_id, length and ids (array of little-endian uint32 pieces, in order) for training;
    ``pieces`` must have been cut with ids."""
    bodies = placed.select("task", "number", "sequence_id", "offset", "length").join(
        pieces.select("task", "number", "ids"), ["task", "number"]
    )
    in_order = F.sort_array(F.collect_list(F.struct("offset", "ids")))["ids"]
    return bodies.groupBy("sequence_id").agg(F.sum("length").alias("length"), in_order.alias("ids"))
