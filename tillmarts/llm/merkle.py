"""A Merkle manifest of a dataset, folded again from stored hash states.

Every row is a leaf: the SHA-256 of its fields, each as ``-`` for NULL or else byte count, ``:``,
value. The leaves of a group (a source), in the order of their keys, form one tree in which every
three consecutive nodes are hashed to their parent until one is left; the groups' roots, in
the order of the groups, form the tree above in the same way. A parent keeps, for each of its child
slots, a copy of the hash state as it was before that child. Folding a replaced leaf resumes that
state with the replacement and the siblings to its right only; siblings to the left are in the
state already.

Trees are built in storeys of ``LEVELS`` levels. A unit of work is one block of 3^LEVELS
consecutive nodes; its root is a node of the next storey, so a tree of any size, one that holds a
third of all rows included, is built from bounded pieces, and each storey is a written table 243
times smaller than the one below. Leaves are folded inside their block at once; what lies above is
one path per block, which all its rows share. Rows are numbered by range partitions and counts of
those, so no group is ordered in one task. The driver receives the root.

Defined results: NULL fields are ``-``; the NULL group comes first; rows with a NULL key come first in
their group, repeated keys in the order of their leaves; equal rows are leaves of their own; a
row without siblings has the digest of the empty text as proof; long texts are hashed whole; an
empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillmarts.llm import sha_states as sha
from tillmarts.llm.common import map_batches, whole_groups
from tillmarts.storage import materialize

#: Children of a node, levels of a storey, nodes of its blocks.
FAN, LEVELS = 3, 5
BLOCK = FAN**LEVELS
#: Rows worked on at once; a block more at most.
ROWS = 16_384

#: One level of a path: the child's slot, all children, the siblings in order, the state before the child.
STEP = np.dtype([("slot", "<u4"), ("width", "<u4"), ("siblings", "<u4", (FAN - 1, 8)), ("state", "<u4", 8)])

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_of(fields: Sequence[Column]) -> Column:
    """The leaf's digest in hex."""

    def written(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)), 256)


def numbered(df: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``df``, written, with ``pos`` (0, 1, 2 ... within ``tree`` by ``order``) and ``n``, the rows of the tree.

    Rows are cut into ranges of even size, which may cut through a tree; each range numbers its
    own from the counts of those before it.
    """
    ranges = df.repartitionByRange(tree, *order).withColumn("_part", F.spark_partition_id())
    ranges = materialize(ranges, "ranges")
    counts = ranges.groupBy(tree, "_part").agg(F.count(F.lit(1)).alias("_n"))
    whole = W.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select(
        tree,
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
        F.sum("_n").over(whole).alias("n"),
    )
    inside = F.row_number().over(W.partitionBy(tree, "_part").orderBy(*order)) - 1
    rows = ranges.withColumn("_inside", inside).join(firsts, [tree, "_part"])
    return rows.select(*df.columns, (F.col("_first") + F.col("_inside")).cast("long").alias("pos"), "n")


def levels_of(n: np.ndarray) -> np.ndarray:
    """Levels that this storey adds to trees of ``n`` nodes: all, or as many as lead to one node."""
    return np.minimum(np.searchsorted(FAN ** np.arange(LEVELS + 1), np.minimum(n, BLOCK)), LEVELS)


def climb(block: np.ndarray, place: np.ndarray, levels: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, list]:
    """The roots of blocks, and the nodes' paths to them.

    Rows lie in the order of ``block`` (0, 1, 2 ...) and ``place``, which counts from 0 in each block.
    A path is given level by level, as (rows that take the level, their steps).
    """
    above, path = np.arange(len(nodes)), []
    for level in range(LEVELS):
        climbs = levels > level
        if not climbs.any():
            break
        # A block that is done keeps its single node.
        first = (place % FAN == 0) | ~climbs
        parent = np.cumsum(first) - 1
        width = np.bincount(parent)
        heads = np.nonzero(first)[0]
        slot = np.where(climbs, place % FAN, 0)
        before = np.empty((len(nodes), 8), np.uint32)
        siblings = np.zeros((len(heads), FAN, 8), np.uint32)
        siblings[parent, slot] = nodes
        state = sha.started(len(heads))
        for child in range(FAN):
            has = np.nonzero(width > child)[0]
            before[heads[has] + child] = state[has]
            state[has] = sha.absorb(state[has], nodes[heads[has] + child])
        taken = np.nonzero(climbs[above])[0]
        at = above[taken]
        steps = np.empty(len(taken), STEP)
        steps["slot"], steps["width"], steps["state"] = slot[at], width[parent[at]], before[at]
        family, own = siblings[parent[at]], slot[at]
        for other in range(FAN - 1):
            steps["siblings"][:, other] = family[np.arange(len(at)), other + (own <= other)]
        path.append((taken, steps))
        done = ~climbs[heads]
        nodes = np.where(done[:, None], nodes[heads], sha.finish(state, width))
        block, place, levels = block[heads], place[heads] // FAN, levels[heads]
        above = parent[above]
    return nodes, path


def fold(rows: np.ndarray, steps: np.ndarray, folded: np.ndarray, proof: np.ndarray, taken: np.ndarray) -> None:
    """Takes ``rows`` one level up, in place: the folded digest, and the proof's state with its siblings."""
    state = sha.absorb(steps["state"], folded[rows])
    for other in range(FAN - 1):
        right = np.nonzero((other >= steps["slot"]) & (other + 1 < steps["width"]))[0]
        state[right] = sha.absorb(state[right], steps["siblings"][right, other])
        any_side = np.nonzero(other + 1 < steps["width"])[0]
        proof[rows[any_side]] = sha.absorb(proof[rows[any_side]], steps["siblings"][any_side, other])
    taken[rows] += steps["width"].astype(np.int64) - 1
    folded[rows] = sha.finish(state, steps["width"])


def _climbed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list]:
    """First rows of the blocks, their roots, and the paths of the rows."""
    pos, n = table.column("pos").to_numpy(), table.column("n").to_numpy()
    place = pos % BLOCK
    block = np.cumsum(place == 0) - 1
    nodes = sha.from_bytes(b"".join(table.column("digest").to_pylist()))
    roots, path = climb(block, place, levels_of(n), nodes)
    return np.nonzero(place == 0)[0], roots, path


def _in_blocks(nodes: DataFrame) -> DataFrame:
    block = F.floor(F.col("pos") / BLOCK)
    return nodes.withColumn("block", block).repartition("tree", "block").sortWithinPartitions("tree", "pos")


#: Rows of a storey: a node with its path inside its block, or a block with its root.
_STOREY = "tree string, pos long, n long, digest binary, path binary"


def _storey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, ["tree", "block"], ROWS):
        heads, roots, path = _climbed(table)
        blobs = [b""] * table.num_rows
        for rows, steps in path:
            for row, step in zip(rows.tolist(), steps):
                blobs[row] += step.tobytes()
        heads = pa.array(heads)
        below = [table.column(c).combine_chunks() for c in ("tree", "pos", "n")]
        none = pa.nulls(table.num_rows, pa.binary())
        yield pa.RecordBatch.from_arrays([*below, none, pa.array(blobs, pa.binary())], _names(_STOREY))
        yield pa.RecordBatch.from_arrays(
            [*_block_columns(table, heads), pa.array(sha.to_bytes(roots), pa.binary()), pa.nulls(len(heads), pa.binary())],
            _names(_STOREY),
        )


def _block_columns(table: pa.Table, heads: pa.Array) -> list[pa.Array]:
    tree, block, n = (table.column(c).combine_chunks().take(heads) for c in ("tree", "block", "n"))
    more = -(-n.to_numpy() // BLOCK)
    return [tree, block, pa.array(more, pa.int64())]


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def tree_paths(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths (tree, pos, path) of all nodes (tree, pos, n, digest) and the roots (tree, digest)."""
    built = materialize(map_batches(_in_blocks(nodes), _STOREY, _storey), "storey")
    own = built.filter(F.col("path").isNotNull()).select("tree", "pos", "path")
    blocks = built.filter(F.col("digest").isNotNull()).drop("path")
    roots = blocks.filter("n = 1").select("tree", "digest")
    more = blocks.filter("n > 1")
    if more.isEmpty():
        return own, roots
    above, higher = tree_paths(more)
    above = above.select("tree", F.col("pos").alias("_block"), F.col("path").alias("_above"))
    joined = own.withColumn("_block", F.floor(F.col("pos") / BLOCK)).join(above, ["tree", "_block"], "left")
    path = F.concat("path", F.coalesce("_above", F.lit(b"")))
    return materialize(joined.select("tree", "pos", path.alias("path")), "paths"), roots.unionByName(higher)


_FOLDED = (
    "tree string, pos long, n long, digest binary, doc_id long, folded binary, proof binary, taken long"
)


def _fold_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves folded to the roots of their blocks (rows with ``folded``), and these roots."""
    for table in whole_groups(batches, ["tree", "block"], ROWS):
        heads, roots, path = _climbed(table)
        count = table.num_rows
        folded = sha.from_bytes(b"".join(table.column("changed").to_pylist())).copy()
        proof, taken = sha.started(count), np.zeros(count, np.int64)
        for rows, steps in path:
            fold(rows, steps, folded, proof, taken)
        columns = [table.column(c).combine_chunks() for c in ("tree", "block", "n", "digest", "doc_id")]
        blobs = [pa.array(sha.to_bytes(x), pa.binary()) for x in (folded, proof)]
        yield pa.RecordBatch.from_arrays([*columns, *blobs, pa.array(taken)], _names(_FOLDED))
        heads = pa.array(heads)
        size = len(heads)
        yield pa.RecordBatch.from_arrays(
            [
                *_block_columns(table, heads), pa.array(sha.to_bytes(roots), pa.binary()), pa.nulls(size, pa.int64()),
                pa.nulls(size, pa.binary()), pa.nulls(size, pa.binary()), pa.nulls(size, pa.int64()),
            ],
            _names(_FOLDED),
        )


_ENDS = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def _fold_to_root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        folded, proof = (sha.from_bytes(b"".join(batch.column(c).to_pylist())).copy() for c in ("folded", "proof"))
        taken = batch.column("taken").to_numpy().copy()
        paths = [np.frombuffer(p, STEP) for p in batch.column("path").to_pylist()]
        lengths = np.array([len(p) for p in paths], np.int64)
        starts = np.cumsum(lengths) - lengths
        steps = np.concatenate(paths) if paths else np.empty(0, STEP)
        for level in range(lengths.max(initial=0)):
            rows = np.nonzero(lengths > level)[0]
            fold(rows, steps[starts[rows] + level], folded, proof, taken)
        ends = [
            [d.hex() for d in batch.column("digest").to_pylist()],
            [d.hex() for d in batch.column("subroot").to_pylist()],
            [d.hex() for d in sha.to_bytes(sha.finish(proof, taken))],
            [d.hex() for d in sha.to_bytes(folded)],
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(c, pa.string()) for c in ends]], _names(_ENDS)
        )


def manifest(
    docs: DataFrame,
    changed: Column | None = None,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    text: str = "text",
) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    ``changed`` is what ``text`` has become since; the row's leaf with it is folded against the manifest
    of the rows as they are, and ``verified`` says whether that gives the root.
    """
    # NULL before every name, names by their bytes.
    tree = F.coalesce(F.concat(F.lit(":"), F.col(group).cast("string")), F.lit("-"))
    body = F.col(text) if changed is None else changed
    leaves = docs.select(
        tree.alias("tree"),
        F.col(key).cast("long").alias("doc_id"),
        F.unhex(leaf_of([F.col(c) for c in fields])).alias("digest"),
        F.unhex(leaf_of([body if c == text else F.col(c) for c in fields])).alias("changed"),
        F.monotonically_increasing_id().alias("_row"),
    )
    leaves = materialize(leaves, "leaves")  # texts are read once; ``_row`` is now fixed
    placed = numbered(leaves, "tree", ["doc_id", "digest", "_row"]).drop("_row")
    built = materialize(map_batches(_in_blocks(placed), _FOLDED, _fold_leaves), "leaf-storey")
    rows = built.filter(F.col("folded").isNotNull()).withColumnRenamed("pos", "block")
    blocks = built.filter(F.col("folded").isNull()).select("tree", "pos", "n", "digest")
    paths, subroots = tree_paths(blocks)
    subroots = materialize(subroots, "subroots")

    tops = numbered(subroots.select(F.lit("").alias("all"), "tree", "digest"), "all", ["tree"])
    tops = materialize(tops.select("all", F.col("tree").alias("name"), "pos", "n", "digest"), "tops")
    top_paths, root = tree_paths(tops.select(F.col("all").alias("tree"), "pos", "n", "digest"))
    ends = tops.join(top_paths.select("pos", F.col("path").alias("_top")), "pos")
    ends = ends.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "_top")
    above = paths.join(ends, "tree").select(
        "tree", F.col("pos").alias("block"), F.concat("path", "_top").alias("path"), "subroot"
    )
    above = materialize(above, "block-paths")
    found = root.first()  # one digest
    whole = found["digest"].hex() if found else None
    folded = map_batches(rows.join(above, ["tree", "block"]).drop("tree", "block", "n"), _ENDS, _fold_to_root)
    return folded.select(
        "doc_id", "leaf", "subroot", F.lit(whole).cast("string").alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(whole)).alias("verified"),
    )
