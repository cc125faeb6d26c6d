"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Two words differ by one such edit exactly if the lengths of their longest common prefix and their longest
common suffix add up to the longer word's length less one. So words are laid out as matrices of
code points, padded to one width, and blocks of them are compared with each other column by
column, from the left for the prefixes and from the right for the suffixes.

Of the two parts one has at least half of the longer word (m // 2 code points of m). Tiles
therefore are blocks of words that share their first, or their last, m // 2 code points, for every
longer length m; a pair that shares both is left to the first. A set of words with more than
``BLOCK`` members is cut into blocks, and every pair of these is a tile of its own, so no set is compared
in one task. A tile returns one row per word, not its pairs.

A word's form is its near word of the largest count, where that is at least ``ratio`` times its own; its
root is found by following forms, with pointers doubled in each round. Counts grow
along a chain, so there are no cycles and a few rounds suffice.

Defined results: a NULL text has no words; a NULL word or count is left out; equal words are added up; a word
without near words has n_near 0 and no form; of near words with equal counts the first in
code-point order is the form; words may have any code points and any length; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmarts.llm.common import ascii_lower, map_batches, whole_groups
from tillmarts.storage import materialize

#: Words of a block, about; fewer if they have more than ``WIDTH`` code points, so that blocks stay small.
BLOCK, WIDTH = 1024, 64
#: Rows of tiles that a task reads at once, or a tile more.
ROWS = 4096
#: A form is at least so many times as frequent as its variant.
RATIO = 5

LETTERS = r"A-Za-zÀ-ÿ"

_TILE = ["longer", "side", "part", "low", "high"]
_FOUND = "word string, n_near long, form_n long, form string"


def word_counts(
    docs: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    key: str = "doc_id",
    text: str = "text",
    change: Callable[[Column, Column], Column] | None = None,
) -> DataFrame:
    """word and n: lower-cased (A-Z) runs of letters of whole texts, with the least length and count.

    ``change`` turns (key, run) into another word that is not longer; what is counted is its result.
    """
    # Shorter runs cannot give a long enough word.
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    found = docs.select(F.col(key).alias("_key"), F.explode(runs).alias("_run"))
    found = found.select("_key", ascii_lower(F.col("_run")).alias("_run"))
    word = F.col("_run") if change is None else change(F.col("_key"), F.col("_run"))
    counted = found.select(word.alias("word")).filter(F.length("word") >= least_length)
    return counted.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def code_points(words: list[str], width: int, from_right: bool = False) -> np.ndarray:
    """Words as rows of ``width`` code points, in the smallest type that holds them, padded with 0 behind
    the word or, ``from_right``, in reading order from its end."""
    if from_right:
        words = [w[::-1] for w in words]
    flat = "".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(flat, "<u4").reshape(len(words), width)


def common_lengths(left: np.ndarray, right: np.ndarray, most: int) -> np.ndarray:
    """How many columns from the first on are equal, of every row with every row, up to ``most``."""
    alive = np.ones((len(left), len(right)), bool)
    lengths = np.zeros(alive.shape, np.uint16 if most < 1 << 15 else np.int64)
    for column in range(most):
        alive &= left[:, column, None] == right[None, :, column]
        if not alive.any():
            break
        lengths += alive
    return lengths


class _Block:
    """Words of one length as matrices from both ends."""

    def __init__(self, words: list[str], at: np.ndarray, length: int, width: int):
        self.at, self.length = at, length
        own = [words[i] for i in at.tolist()]
        codes = code_points(own, width)
        small = np.uint8 if codes.max(initial=0) < 1 << 8 else np.uint16 if codes.max(initial=0) < 1 << 16 else np.uint32
        self.ahead = codes.astype(small)
        self.back = code_points(own, width, from_right=True).astype(small)


def single_edits(a: _Block, b: _Block, half: int, by_suffix: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of words one edit apart; ``a`` holds the longer ones."""
    most = min(a.length, b.length)
    prefix = common_lengths(a.ahead, b.ahead, most)
    suffix = common_lengths(a.back, b.back, most)
    near = prefix + suffix + 1 >= a.length
    if by_suffix:
        near &= prefix < half  # else they share a tile of prefixes
    return np.nonzero(near)


def compare_tile(
    words: list[str], lengths: np.ndarray, blocks: np.ndarray, longer: int, by_suffix: bool, low: int, high: int
) -> tuple[np.ndarray, np.ndarray]:
    """Both directions of the near pairs between blocks ``low`` and ``high``, or within one, whose
    longer word has ``longer`` code points."""

    def block(number: int, length: int) -> _Block:
        return _Block(words, np.nonzero((blocks == number) & (lengths == length))[0], length, longer)

    long, other_long = block(low, longer), block(high, longer)
    jobs = [(long, other_long), (long, block(high, longer - 1))]
    if low != high:
        jobs.append((other_long, block(low, longer - 1)))
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for a, b in jobs:
        if len(a.at) and len(b.at):
            i, j = single_edits(a, b, longer // 2, by_suffix)
            i, j = a.at[i], b.at[j]
            if low == high and a.length == b.length:
                i, j = i[i < j], j[i < j]  # each pair once, no word with itself
            left += [i, j]
            right += [j, i]
    return np.concatenate(left), np.concatenate(right)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, _TILE, ROWS):
        words = table.column("word").to_pylist()
        counts = table.column("n").to_numpy()
        blocks = table.column("block").to_numpy()
        keys = list(zip(*(table.column(k).to_pylist() for k in _TILE)))
        starts = [i for i, k in enumerate(keys) if not i or k != keys[i - 1]]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        found: list[tuple] = []
        for start, end in zip(starts, [*starts[1:], len(keys)]):
            own = words[start:end]
            longer, side, _, low, high = keys[start]
            word, near = compare_tile(own, lengths[start:end], blocks[start:end], longer, side == 1, low, high)
            if not len(word):
                continue
            rank = np.empty(len(own), np.int64)
            rank[sorted(range(len(own)), key=own.__getitem__)] = np.arange(len(own))
            n = counts[start:end]
            order = np.lexsort((rank[near], -n[near], word))
            word, near = word[order], near[order]
            heads = np.nonzero(np.diff(word, prepend=-1))[0]
            totals = np.diff(np.append(heads, len(word)))
            for at, total in zip(heads.tolist(), totals.tolist()):
                best = near[at]
                found.append((own[word[at]], total, int(n[best]), own[best]))
        columns = list(zip(*found)) or [()] * 4
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "n_near", "form_n", "form"]
        )


def tiles(words: DataFrame) -> DataFrame:
    """The rows of all tiles: longer, side (0: same beginning, 1: same end), part, low, high, block, word, n."""
    length = F.length("word")
    half = F.floor(F.col("longer") / 2).cast("int")
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.substring(F.col("word"), F.lit(1), half).alias("part")),
        F.struct(F.lit(1).alias("side"), F.substring(F.col("word"), length - half + 1, half).alias("part")),
    )
    keyed = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("longer"))
    keyed = keyed.select("word", "n", "longer", F.explode(sides).alias("_side"))
    keyed = keyed.select("word", "n", "longer", "_side.*")
    sizes = keyed.groupBy("longer", "side", "part").agg(F.count(F.lit(1)).alias("_size"))
    room = F.lit(float(BLOCK)) / F.greatest(F.lit(1.0), F.col("longer") / WIDTH)
    sizes = sizes.filter("_size > 1").withColumn("_blocks", F.ceil(F.col("_size") / room).cast("int"))
    cut = keyed.join(sizes, ["longer", "side", "part"]).withColumn(
        "block", F.pmod(F.xxhash64("word"), F.col("_blocks")).cast("int")
    )
    met = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return met.select(
        "longer", "side", "part",
        F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"),
        "block", "word", "n",
    )


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, form_n and form (the most frequent near word) of words that have a near word."""
    rows = tiles(words).repartition(*_TILE).sortWithinPartitions(*_TILE)
    found = map_batches(rows, _FOUND, _compare)
    best = F.min(F.struct(-F.col("form_n"), F.col("form")))
    met = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
    return met.select("word", "n_near", (-F.col("_best.col1")).alias("form_n"), F.col("_best.form").alias("form"))


def roots(forms: DataFrame, most_rounds: int = 64) -> DataFrame:
    """word and root from word and form, which must have no cycle."""
    links = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(most_rounds):
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = links.join(ahead, "root", "left")
        links = materialize(moved.select("word", F.coalesce("_next", "root").alias("root"), "_next"), "roots")
        if links.filter(F.col("_next").isNotNull()).isEmpty():
            return links.drop("_next")
        links = links.drop("_next")
    raise RuntimeError(f"forms still lead on after {most_rounds} rounds")


def variants(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``counts`` (word, n)."""
    usable = counts.filter(F.col("word").isNotNull() & F.col("n").isNotNull())
    words = materialize(usable.groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    judged = words.join(near_words(words), "word", "left")
    is_form = F.col("form_n") >= ratio * F.col("n")
    judged = judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"),
    )
    judged = materialize(judged, "judged")
    ends = roots(judged.filter(F.col("form").isNotNull()))
    out = judged.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
