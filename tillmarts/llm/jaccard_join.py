"""Near duplicates: a Jaccard join of word-shingle sets with filters under several token orders.

Two documents link when 100 * |x & y| >= percent * |x | y|. Whatever the global order of tokens
(shingles, as 64-bit hashes), a linked pair shares tokens among the first ones of both sets: with
m(x) = |x| - ceil(percent * |x| / 100) tokens that x may have for itself, the first m(x) + l of x and
m(y) + l of y share at least l. The join uses four orders, and what one lets pass the next must
let pass too:

1. By hash, over all documents. The first 1.3 (m + 1) tokens of every set are met with those of all
   others; a set of which too few occur elsewhere has no partner. Documents that merely
   share a passage end here, mostly. Tokens travel packed and once per chunk of documents, so the
   most frequent one costs one entry per chunk.
2. By hash, in the opposite direction, over what is left: the same with 3.3 (m + 1) tokens.
3. Rarest first, ties by hash. Tokens are counted among the sets that are left. The first m + 1 of
   a set are mostly its own; where they are not, stars from each token to the smallest set that
   has it join the sets into groups, within which all links lie.
4. Rarest first, ties by hash in the opposite direction. Within a group a pair must share a prefix
   token under orders 3 and 4 before its whole sets are compared.

Equal sets are one class from the start. Groups are compared in blocks of bounded size, a large
group as pairs of blocks, and each block returns a spanning forest of its links, never all
pairs. Before a large group is cut into blocks, its sets are compared with one of them; those
that link with it are connected already and their blocks need not meet each other.

Defined results: a document without words has no shingle, links with nothing and is its own
component; with fewer words than a shingle takes, all its words are one shingle; repeated rows are
one class; a NULL key never is a component's name unless all its keys are NULL; an empty table
gives no rows; very long texts are taken whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmarts.llm.common import LOWERED, WORDS, fresh_name, map_batches
from tillmarts.llm.graph import components
from tillmarts.storage import materialize

#: Tokens of a chunk of documents, sets of a block, and sets that one task compares, about.
CHUNK_TOKENS, BLOCK_SETS, UNIT_SETS = 1_000_000, 512, 2048
#: Words a task remembers the hash of.
MEMO_WORDS = 150_000
#: The longer prefixes of orders 1 and 2, in tenths of the plain one.
LONGER, LONGEST = 13, 33

#: Stands for a NULL key in joins.
_NO_KEY = -(1 << 63)
_MANY = np.uint32(0xFFFFFFFF)
# Odd multipliers for mixing.
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        digest = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        value = self[word] = int.from_bytes(digest, "little")
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * _MULTIPLIERS[3]
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int, hashes: dict[str, int]) -> np.ndarray:
    """The sorted, distinct hashes (uint64) of all runs of ``words`` lower-cased words."""
    if not text:
        return np.empty(0, np.uint64)
    found = WORDS.findall(text.lower() if text.isascii() else text.translate(LOWERED))
    if not found:
        return np.empty(0, np.uint64)
    values = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    width = min(words, len(values))
    total = np.full(len(values) - width + 1, width, np.uint64)
    for i in range(width):
        # Mixed after each word, so order counts.
        total = _mixed(total * _MULTIPLIERS[i % 3] + values[i : len(values) - width + 1 + i])
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def signature(tokens: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return (
        int.from_bytes(digest[:8], "little", signed=True),
        int.from_bytes(digest[8:], "little", signed=True),
    )


def own_tokens(n: int, percent: int) -> int:
    """How many tokens of a set of ``n`` a linked set may lack."""
    return n - -(-n * percent // 100)


def longer_prefix(n: int, percent: int, tenths: int = LONGER) -> int:
    return min(n, -(-tenths * (own_tokens(n, percent) + 1) // 10))


def least_shared(n: Column, percent: int, tenths: int = LONGER) -> Column:
    """How many of its longer prefix a set of ``n`` shares at least with a linked set.

    The number does not fall as sets grow, so the smallest possible partner decides.
    """
    ceil = lambda c: F.floor((c * percent + 99) / 100)
    smallest = ceil(n)
    own = smallest - ceil(smallest)
    return F.least(smallest, F.floor(((own + 1) * tenths + 9) / 10)) - own


# Orders 1 and 2. Rows of the shuffle: packed tokens of one chunk and range, or a chunk's documents.
_PACKED = "range int, chunk long, tokens binary, owners binary, sigs binary, docs binary"
_MET = "doc_id long, id_known boolean, n long, sig long, sig2 long, chunk long, hits long"


def _from_texts(batch: pa.RecordBatch, words: int, hashes: dict[str, int]) -> Iterator[tuple]:
    for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
        yield key, shingles(text.as_py(), words, hashes)


def _from_sets(batch: pa.RecordBatch, words: int, hashes: dict[str, int]) -> Iterator[tuple]:
    for tokens in batch.column(1):
        yield 0, tokens.values.to_numpy().view(np.uint64)


def _pack(read, words: int, percent: int, ranges: int, tenths: int, backwards: bool):
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    names = ["range", "chunk", "tokens", "owners", "sigs", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        task, seq = TaskContext.get().partitionId(), 0
        docs: list[tuple] = []
        owner_of: dict[tuple, int] = {}
        prefixes: list[np.ndarray] = []
        sizes: list[int] = []
        size = 0

        def chunk() -> pa.RecordBatch:
            number = (task << 24) + seq
            tokens = np.concatenate(prefixes) if prefixes else np.empty(0, np.uint64)
            owners = np.repeat(np.arange(len(prefixes), dtype=np.uint32), [len(p) for p in prefixes])
            order = np.argsort(tokens, kind="stable")
            tokens, owners = tokens[order], owners[order]
            first = np.concatenate([[True], tokens[1:] != tokens[:-1]])[: len(tokens)]
            runs = np.diff(np.append(np.nonzero(first)[0], len(tokens)))
            several = np.repeat(runs > 1, runs)
            local = np.bincount(owners[several], minlength=len(prefixes))
            # A token of several sets here is sent once, without an owner: it counts as met already.
            tokens, owners = tokens[first], np.where(several, _MANY, owners)[first]
            sigs = np.array([s for s, _ in owner_of], np.int64)
            to = (_mixed(tokens) % np.uint64(ranges)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            cuts = np.searchsorted(to[order], np.arange(ranges + 1))
            rows = []
            for r in range(ranges):
                at = order[cuts[r] : cuts[r + 1]]
                if len(at):
                    rows.append((r, number, tokens[at].tobytes(), owners[at].tobytes(), sigs.tobytes(), None))
            met = [(0, False, n, *key, number, int(h)) for n, key, h in zip(sizes, owner_of, local)]
            table = np.array([(*d, 0, -1) for d in docs] + met, np.dtype([(c, np.int64) for c in "abcdefg"]))
            rows.append((number % ranges, number, None, None, None, table.tobytes()))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names
            )

        for batch in batches:
            for key, found in read(batch, words, hashes):
                n = len(found)
                sig = signature(found)
                docs.append((key or 0, key is not None, n, *sig))
                if n and sig not in owner_of:
                    owner_of[sig] = len(owner_of)
                    sizes.append(n)
                    k = longer_prefix(n, percent, tenths)
                    prefixes.append(found[n - k :] if backwards else found[:k])
                    size += n
                if size >= CHUNK_TOKENS or len(docs) >= CHUNK_TOKENS // 10:
                    yield chunk()
                    seq, size, docs, owner_of, prefixes, sizes = seq + 1, 0, [], {}, [], []
        if docs:
            yield chunk()

    return run


def _meet(packed: pd.DataFrame) -> pd.DataFrame:
    """Tokens of one range from all chunks: which occur in different sets, per owner how many."""
    out = []
    for blob in packed["docs"].dropna():
        table = np.frombuffer(blob, np.int64).reshape(-1, 7)
        out.append(pd.DataFrame(table, columns=["doc_id", "id_known", "n", "sig", "sig2", "chunk", "hits"]))
    rows = packed[packed["tokens"].notna()]
    if len(rows):
        tokens = np.concatenate([np.frombuffer(b, np.uint64) for b in rows["tokens"]])
        owners = [np.frombuffer(b, np.uint32) for b in rows["owners"]]
        tables = [np.frombuffer(b, np.int64) for b in rows["sigs"]]
        sigs = np.concatenate([t[np.where(o == _MANY, 0, o)] for o, t in zip(owners, tables)])
        chunk = np.repeat(rows["chunk"].to_numpy(), [len(o) for o in owners])
        many = np.concatenate(owners) == _MANY
        order = np.argsort(tokens, kind="stable")
        tokens, sigs, chunk, many = tokens[order], sigs[order], chunk[order], many[order]
        first = np.nonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))[0]
        runs = np.diff(np.append(first, len(tokens)))
        differ = np.minimum.reduceat(sigs, first) != np.maximum.reduceat(sigs, first)
        shared = np.repeat((runs > 1) & (differ | np.logical_or.reduceat(many, first)), runs) & ~many
        met = pd.DataFrame({"sig": sigs[shared], "chunk": chunk[shared]})
        met = met.groupby(["sig", "chunk"], as_index=False).size().rename(columns={"size": "hits"})
        out.append(met.assign(doc_id=0, id_known=0, n=0, sig2=0))
    frame = pd.concat(out)[["doc_id", "id_known", "n", "sig", "sig2", "chunk", "hits"]]
    return frame.astype({"id_known": bool})


def _sets(words: int):
    """Whole sets of the documents that are left: sig, n and sorted tokens (as signed longs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in batches:
            found = [shingles(text.as_py(), words, hashes) for text in batch.column(0)]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            flat = np.concatenate(found).view(np.int64) if found else np.empty(0, np.int64)
            sigs = [signature(f)[0] for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(sigs, pa.int64()), pa.ListArray.from_arrays(ends, flat)], ["sig", "tokens"]
            )

    return run


def _links(tokens: list[np.ndarray], second: list[np.ndarray], third: list[np.ndarray], percent: int, skip: np.ndarray) -> np.ndarray:
    """Which pairs of sets link, but those in ``skip``: a symmetric matrix."""
    allowed = (_common(second) > 0) & (_common(third) > 0) & ~skip
    np.fill_diagonal(allowed, False)
    if not allowed.any():
        return allowed
    used = np.nonzero(allowed.any(axis=1))[0]
    common = np.zeros(allowed.shape, np.int64)
    common[np.ix_(used, used)] = _common([tokens[i] for i in used])
    n = np.array([len(t) for t in tokens], np.int64)
    return allowed & (100 * common >= percent * (n[:, None] + n[None, :] - common))


def _common(sets: list[np.ndarray], width: int = 8192) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices ``width`` tokens at a time."""
    g = len(sets)
    owner = np.repeat(np.arange(g), [len(s) for s in sets])
    flat = np.concatenate(sets) if g else np.empty(0, np.int64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.concatenate([[True], flat[1:] != flat[:-1]])[: len(flat)]
    starts = np.nonzero(first)[0]
    runs = np.diff(np.append(starts, len(flat)))
    kept = np.repeat(runs > 1, runs)  # the others are in one set only
    number = np.cumsum(first[kept]) - 1
    owner = owner[kept]
    out = np.zeros((g, g), np.int64)
    cuts = np.searchsorted(number, np.arange(0, (number[-1] + 1 if len(number) else 0) + width, width))
    for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if b > a:
            part = np.zeros((g, min(width, int(number[b - 1]) - i * width + 1)), np.float32)
            part[owner[a:b], number[a:b] - i * width] = 1
            out += np.rint(part @ part.T).astype(np.int64)
    return out


def _forest(links: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the graph: each node with the first one of its tree."""
    left = np.ones(len(links), bool)
    found = []
    for root in range(len(links)):
        if left[root]:
            left[root] = False
            front = np.zeros(len(links), bool)
            front[root] = True
            while front.any():
                front = links[front].any(axis=0) & left
                left &= ~front
                found += [(root, int(i)) for i in np.nonzero(front)[0]]
    return found


def _compare(percent: int):
    def run(unit: pd.DataFrame) -> pd.DataFrame:
        edges = []
        for (_, i, j), rows in unit.groupby(["group", "i", "j"]):
            if len(rows) < 2:
                continue
            sig, block, joined = rows["sig"].to_numpy(), rows["block"].to_numpy(), rows["joined"].to_numpy()
            skip = joined[:, None] & joined[None, :]
            if i != j:
                skip |= block[:, None] == block[None, :]  # compared where the block meets itself
            links = _links(
                rows["tokens"].tolist(), rows["second"].tolist(), rows["third"].tolist(), percent, skip
            )
            edges += [(sig[a], sig[b]) for a, b in _forest(links)]
        return pd.DataFrame(edges, columns=["a", "b"], dtype=np.int64)

    return run


def _hub_link(percent: int):
    """For sets of large groups, next to their group's hub: whether they link with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, hub = batch.column(0), batch.column(1)
            linked = []
            for mine, other in zip(batch.column(2), batch.column(3)):
                x, y = mine.values.to_numpy(), other.values.to_numpy()
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([sig, hub, pa.array(linked)], ["sig", "hub", "linked"])

    return run


def _meeting(rows: DataFrame, read, words: int, percent: int, tenths: int, backwards: bool) -> DataFrame:
    """The packed tokens of ``rows`` brought together: rows of ``_MET``, written."""
    # Half as many ranges as shuffle partitions: every range carries its chunks' signatures.
    ranges = -(-int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 2)
    packed = map_batches(rows, _PACKED, _pack(read, words, percent, ranges, tenths, backwards))
    return materialize(packed.groupBy("range").applyInPandas(_meet, _MET), "met")


def _passed(met: DataFrame, percent: int, tenths: int) -> DataFrame:
    """sig and n of the sets that share enough. One in several chunks is judged by the best of them."""
    hits = met.filter("hits >= 0").groupBy("sig", "chunk").agg(F.sum("hits").alias("hits"), F.max("n").alias("n"))
    hits = hits.groupBy("sig").agg(F.max("hits").alias("hits"), F.max("n").alias("n"))
    return hits.filter(F.col("hits") >= least_shared(F.col("n"), percent, tenths)).select("sig", "n")


@contextmanager
def _runtime_filters(spark: SparkSession) -> Iterator[None]:
    """Let Spark filter the large side of a shuffle join by a Bloom filter of the small one, whatever
    the size of the large one; where the small one is too large for that, it just shuffles."""
    name = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "0")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _prefixes(sets: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """sig, second, third: the shared tokens in the prefixes of orders 3 and 4, where there are any."""
    tokens = sets.select("sig", F.explode("tokens").alias("token"))
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = tokens.join(counts, "token").groupBy("sig").agg(F.collect_list(F.struct("df", "token")).alias("shared"))
    rows = shared.join(sizes, "sig")
    own = F.col("n") - F.floor((F.col("n") * percent + 99) / 100)
    # Tokens of no other set come first in both orders; what is left of the prefix is shared ones.
    room = (own + 1 - (F.col("n") - F.size("shared"))).cast("int")
    opposite = F.transform("shared", lambda s: F.struct(s["df"], F.bitwise_not(s["token"]).alias("token")))
    return rows.filter(room > 0).select(
        "sig",
        F.slice(F.sort_array("shared"), 1, room)["token"].alias("second"),
        F.transform(F.slice(F.sort_array(opposite), 1, room)["token"], F.bitwise_not).alias("third"),
    )


def _group_edges(prefixes: DataFrame) -> DataFrame:
    """Stars from each prefix token to the smallest set that has it."""
    prefix = prefixes.select("sig", F.explode("second").alias("token"))
    hubs = prefix.groupBy("token").agg(F.min("sig").alias("hub"), F.max("sig").alias("top")).filter("hub <> top")
    return prefix.join(hubs.select("token", "hub"), "token").select(F.col("sig").alias("a"), F.col("hub").alias("b"))


def _blocks(groups: DataFrame, sets: DataFrame, prefixes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """The sets of each group dealt to units of comparison, and the links that were found on the
    way. ``groups`` (sig, group) and what follows from it stays narrow until the end."""
    sizes = groups.groupBy("group").agg(
        F.count(F.lit(1)).alias("g"), F.min(F.struct(F.xxhash64("sig"), "sig"))["sig"].alias("hub")
    )
    members = materialize(groups.join(sizes, "group"), "members")
    large = members.filter(F.col("g") > BLOCK_SETS).join(sets, "sig")
    hubs = large.filter("sig = hub").select("group", F.col("tokens").alias("hub_tokens")).dropDuplicates(["group"])
    stars = large.join(hubs, "group").select("sig", "hub", "tokens", "hub_tokens")
    stars = map_batches(stars, "sig long, hub long, linked boolean", _hub_link(percent)).filter("linked")
    stars = materialize(stars, "hub-links")
    members = members.join(stars.select("sig", F.lit(True).alias("joined")).distinct(), "sig", "left")
    members = members.withColumn("joined", F.coalesce("joined", F.lit(False)))
    # Blocks hold either sets that link with the hub or sets that don't; two blocks of the
    # first kind need not meet.
    blocks = lambda which: F.ceil(F.count(F.when(which, 1)) / BLOCK_SETS).cast("int")
    counts = members.groupBy("group").agg(
        blocks(F.col("joined")).alias("with_hub"), blocks(~F.col("joined")).alias("without")
    )
    members = members.join(counts, "group")
    spread = F.xxhash64("sig", F.lit(11))
    block = F.when(F.col("joined"), F.pmod(spread, F.greatest("with_hub", F.lit(1)))).otherwise(
        F.col("with_hub") + F.pmod(spread, F.greatest("without", F.lit(1)))
    )
    members = materialize(members.withColumn("block", block.cast("int")), "blocks")
    every = F.sequence(F.lit(0), F.col("with_hub") + F.col("without") - 1)
    met = F.when(F.col("joined"), F.filter(every, lambda k: k >= F.col("with_hub"))).otherwise(every)
    units = 4 * max(1, -(-members.count() // UNIT_SETS))
    dealt = members.join(sets, "sig").join(prefixes, "sig").withColumn("other", F.explode(met))
    dealt = dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    # Small groups share units, each pair of blocks of a large one is its own.
    at = F.xxhash64("group", "i", "j")
    unit = F.when(F.col("g") > BLOCK_SETS, at).otherwise(F.pmod(at, F.lit(units)))
    dealt = dealt.select(unit.alias("unit"), "group", "i", "j", "block", "joined", "sig", "tokens", "second", "third")
    return dealt, stars.select(F.col("sig").alias("a"), F.col("hub").alias("b"))


def join(
    docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest key it is linked with,
    directly or through others, itself included)."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    met = _meeting(rows, _from_texts, words, percent, LONGER, False)
    known = met.filter("hits = -1").select(
        F.when(F.col("id_known"), F.col("doc_id")).alias("doc_id"), "n", "sig", "sig2"
    )
    classes = known.filter("n > 0").groupBy("sig", "sig2").agg(F.min("doc_id").alias("least_id"))

    # Order 1, then the whole sets of what is left, by one document of each class.
    left = _passed(met, percent, LONGER)
    at = F.coalesce(F.col("least_id"), F.lit(_NO_KEY))
    left = materialize(classes.join(left, "sig").select(at.alias("_least"), "n"), "left").filter("n > 0")
    rows = rows.withColumn("_key", F.coalesce("doc_id", F.lit(_NO_KEY)))
    texts = rows.join(left, F.col("_key") == F.col("_least"), "left_semi")
    with _runtime_filters(docs.sparkSession):
        sets = map_batches(texts.select("text"), "sig long, tokens array<long>", _sets(words))
        sets = materialize(sets.filter(F.size("tokens") > 0), "sets")
    # Order 2.
    met = _meeting(sets, _from_sets, words, percent, LONGEST, True)
    left = materialize(_passed(met, percent, LONGEST), "left")
    sets = materialize(sets.join(left.select("sig"), "sig", "left_semi"), "sets")
    # Orders 3 and 4.
    prefixes = materialize(_prefixes(sets, left, percent), "prefixes")
    groups = components(_group_edges(prefixes)).select(F.col("node").alias("sig"), F.col("label").alias("group"))
    dealt, stars = _blocks(groups, sets, prefixes, percent)
    compared = materialize(dealt.groupBy("unit").applyInPandas(_compare(percent), "a long, b long"), "links")
    linked = components(compared.union(stars))
    # A component is named after the smallest key of all its classes.
    named = classes.join(linked.withColumnRenamed("node", "sig"), "sig", "left")
    named = named.withColumn("label", F.coalesce("label", "sig"))
    named = materialize(named.select("sig", "label", "least_id"), "named")
    names = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    names = named.join(names, "label").groupBy("sig").agg(F.min("component_id").alias("component_id"))
    out = known.join(materialize(names, "names"), "sig", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def keep_one(
    docs: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents of ``docs``, whole, but those linked with one of a smaller key. Documents with
    a NULL key stay, and rows that share a key stay or go together: they go if all of them would."""
    found = join(docs, words, percent, key, text)
    gone = found.groupBy("doc_id").agg(F.min(F.col("component_id") != F.col("doc_id")).alias("all_gone"))
    name = fresh_name(docs, "gone")
    gone = materialize(gone.filter("all_gone").select(F.col("doc_id").alias(name)), "near-copies")
    return docs.join(gone, F.col(key).cast("long") == F.col(name), "left_anti")
