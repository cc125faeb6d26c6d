"""Removal of passages that an earlier document has, by suffix sorting with bucket pointers.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller
key. Strings are compared on the input, byte by byte; nothing is decided by a hash alone.

**Which strings can meet.** Every string of ``LENGTH`` bytes (a window) has an anchor, the smallest of its
grams of ``GRAM`` bytes under a hash, the leftmost of equals. Equal windows have equal anchors, so an
anchor that stands in one document only takes its windows out. Neighbouring windows mostly share an
anchor; such a run of windows is sent as one piece of text, about 65 bytes for fifteen windows,
and only once per chunk of documents.

**Suffix sorting** (bucket-pointer refinement). Pieces are dealt by their anchors to ranges. There all
suffixes of the pieces are first put into buckets by their first ``FIRST`` bytes, and each gets a
pointer to its bucket. A bucket is refined by sorting its suffixes on the pointers found a
bucket's depth further on, which doubles the depth; the refined pointers serve the next round.
Buckets of one suffix are final and are never sorted again. Buckets of depth ``LENGTH`` are the equal windows,
and the smallest key in a bucket is what each of its windows is told. A piece whose anchor no other
piece has needs no sorting.

An anchor with more than ``HOT`` occurrences is not sent to one task: its windows are dealt one by one,
by their own bytes. Texts are written once, bucketed by chunk, and read three times without being
shuffled: for the anchors, for the pieces, and to cut. Chunks and ranges have bounded size however
large the corpus; long texts are read in overlapping parts.

Defined results: a NULL text counts as empty; a text shorter than ``LENGTH`` stays whole; rows with a NULL
key neither lose anything nor take anything from others; rows with equal keys take nothing from
each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmarts.llm.common import map_batches, ship_code
from tillmarts.storage import fresh_path, materialize

#: Bytes of a string that counts as repeated, and of the grams that anchors are chosen from.
LENGTH, GRAM = 50, 24
#: Grams of a window.
SPAN = LENGTH - GRAM + 1
#: Bytes of text in a chunk, for each range, for each bucket of the table; bytes worked on at once.
CHUNK, RANGE, BUCKET, PART = 8 << 20, 16 << 20, 32 << 20, 1 << 20
#: Spark writes at most so many buckets.
MOST_BUCKETS = 50_000
#: Occurrences from which on an anchor's windows are dealt one by one.
HOT = 1 << 15
#: Depth of the first buckets.
FIRST = 8

_PLACE = np.uint64(PART * 2 - 1)
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
#: The last byte of an anchor's hash gives way to a note: in several documents, and the logarithm of its occurrences.
_NOTE = np.uint64(0xFF)
_SEVERAL = 0x80


# Anchors and runs of windows


def words_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``data`` (uint8) on, as one number; zeros behind the end."""
    out = np.empty(len(data) + 8 - len(data) % 8, np.uint64)
    padded = np.concatenate([data, np.zeros(24, np.uint8)])
    for k in range(8):
        out[k::8] = np.frombuffer(padded[k : k + len(out)].tobytes(), "<u8")
    return out[: len(data)]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on."""
    words, count = words_of(data), len(data) - GRAM + 1
    total = np.zeros(count, np.uint64)
    for k in range(0, GRAM, 8):
        total = (total ^ (total >> np.uint64(29))) * _MULTIPLIERS[3] + words[k : k + count] * _MULTIPLIERS[k // 8]
    total ^= total >> np.uint64(32)
    total *= _MULTIPLIERS[3]
    return total ^ (total >> np.uint64(29))


def _sliding_minima(values: np.ndarray, span: int) -> np.ndarray:
    reach = 1
    while 2 * reach <= span:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = span - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Runs:
    """Windows of ``data`` as runs with one anchor: text, first byte there and in ``data``, windows, anchor."""

    data: bytes
    doc: np.ndarray
    start: np.ndarray
    at: np.ndarray
    count: np.ndarray
    anchor: np.ndarray

    def some(self, which: np.ndarray) -> Runs:
        return Runs(self.data, *(x[which] for x in (self.doc, self.start, self.at, self.count, self.anchor)))

    def one_by_one(self) -> Runs:
        """Every window as a run of its own."""
        inside = np.arange(self.count.sum()) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        doc, start, at, anchor = (np.repeat(x, self.count) for x in (self.doc, self.start, self.at, self.anchor))
        return Runs(self.data, doc, start + inside, at + inside, np.ones(len(inside), np.int64), anchor)


def window_runs(texts: Sequence[bytes]) -> Iterator[Runs]:
    """All windows of ``texts``."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for number, text in enumerate(texts):
        for start in range(0, max(len(text) - LENGTH + 1, 0), PART):
            part = text[start : start + PART + LENGTH - 1]
            if size and size + len(part) > PART:
                yield _runs_of(held)
                held, size = [], 0
            held.append((number, start, part))
            size += len(part)
    if held:
        yield _runs_of(held)


def _runs_of(parts: list[tuple[int, int, bytes]]) -> Runs:
    joined = b"".join(p for _, _, p in parts)
    data = np.frombuffer(joined, np.uint8)
    sizes = np.array([len(p) for _, _, p in parts])
    begins = np.cumsum(sizes) - sizes
    hashes = gram_hashes(data)
    placed = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    anchors = (_sliding_minima(placed, SPAN) & _PLACE).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), sizes)[: len(anchors)]
    whole = np.arange(len(anchors)) + LENGTH <= (begins + sizes)[owner]
    anchors[~whole] = -1
    first = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (owner[1:] != owner[:-1])])
    heads = np.nonzero(first)[0]
    counts = np.diff(np.append(heads, len(anchors)))
    usable = anchors[heads] >= 0
    heads, counts = heads[usable], counts[usable]
    part = owner[heads]
    number = np.array([n for n, _, _ in parts])[part]
    start = np.array([s for _, s, _ in parts])[part] + heads - begins[part]
    return Runs(joined, number, start, heads, counts, hashes[anchors[heads]] & ~_NOTE)


# Step 1: anchors that stand in several documents

_ANCHORS = "range int, chunk long, anchors binary"
_SHARED = "chunk long, anchors binary"


def _noted(anchors: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Each different anchor once, with its note."""
    order = np.argsort(anchors)
    anchors, docs = anchors[order], docs[order]
    heads = np.nonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]])[: len(anchors)])[0]
    ends = np.append(heads[1:], len(anchors))
    several = np.minimum.reduceat(docs, heads) < np.maximum.reduceat(docs, heads)
    note = np.ceil(np.log2(ends - heads)).astype(np.uint64) | np.where(several, _SEVERAL, 0).astype(np.uint64)
    return anchors[heads] | note


def _list_anchors(ranges: int):
    def run(chunk: pd.DataFrame) -> pd.DataFrame:
        texts = chunk["text"].tolist()
        found = [_noted(runs.anchor, runs.doc) for runs in window_runs(texts)]
        if not found:
            return pd.DataFrame({"range": [], "chunk": [], "anchors": []})
        merged = np.concatenate(found)
        # Parts of a chunk hold different documents, or the same long one.
        merged = _merged(merged) if len(found) > 1 else merged
        to = ((merged >> np.uint64(8)) % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.nonzero(np.diff(to[order], prepend=-1))[0]
        rows = [(int(to[o[0]]), merged[o].tobytes()) for o in np.split(order, cuts[1:])]
        return pd.DataFrame({"range": [r for r, _ in rows], "chunk": chunk["chunk"].iloc[0], "anchors": [b for _, b in rows]})

    return run


def _merged(noted: np.ndarray) -> np.ndarray:
    """Anchors of several lists, each once; those that occur in more than one count as shared."""
    noted = np.sort(noted)
    plain = noted & ~_NOTE
    heads = np.nonzero(np.concatenate([[True], plain[1:] != plain[:-1]])[: len(plain)])[0]
    counts = np.diff(np.append(heads, len(plain)))
    notes = noted & _NOTE
    times = np.add.reduceat(np.exp2((notes & np.uint64(0x7F)).astype(np.float64)), heads)
    several = (np.maximum.reduceat(notes, heads) >= _SEVERAL) | (counts > 1)
    note = np.ceil(np.log2(times)).astype(np.uint64) | np.where(several, _SEVERAL, 0).astype(np.uint64)
    return plain[heads] | note


def _find_shared(rows: pd.DataFrame) -> pd.DataFrame:
    """The anchors of one range that occur in several documents, for each chunk that has them."""
    lists = [np.frombuffer(b, np.uint64) for b in rows["anchors"]]
    merged = _merged(np.concatenate(lists))
    merged = merged[(merged & np.uint64(_SEVERAL)) > 0]
    plain = merged & ~_NOTE
    out = []
    for chunk, own in zip(rows["chunk"], lists):
        at = np.searchsorted(plain, own & ~_NOTE)
        at = at[(at < len(plain)) & (plain[np.minimum(at, len(plain) - 1)] == own & ~_NOTE)] if len(plain) else at[:0]
        if len(at):
            out.append((chunk, merged[at].tobytes()))
    return pd.DataFrame({"chunk": [c for c, _ in out], "anchors": [b for _, b in out]})


# Step 2: pieces of text, sorted by their suffixes

_PIECES = "range int, chunk long, text binary, pieces binary"
_PIECE = np.dtype([("route", "<u4"), ("size", "<u4"), ("several", "u1"), ("least", "<i8")])
_REPLIES = "chunk long, range int, replies binary"
#: ``count`` windows of a piece from ``first`` on, and the smallest key of a document that has them.
_REPLY = np.dtype([("piece", "<u4"), ("first", "u1"), ("count", "u1"), ("least", "<i8")])


class _Numbers(dict):
    """Numbers for values in the order in which they are first met."""

    def __missing__(self, value: bytes) -> int:
        number = self[value] = len(self)
        return number


class Pieces:
    """The pieces of a chunk with shared anchors: each text once, and where it occurs.

    The order follows from the chunk's rows and the shared anchors, so the task that cuts finds the
    same pieces as the one that sent them. A piece's text decides its anchor, so its route too.
    """

    def __init__(self, keys: Sequence[int], texts: Sequence[bytes], shared: np.ndarray, ranges: int):
        numbers = _Numbers()
        of, docs, starts, routes = ([np.empty(0, np.int64)] for _ in range(4))
        shared = np.sort(shared)
        plain = shared & ~_NOTE
        hot = (shared & np.uint64(0x7F)) >= np.uint64(HOT.bit_length() - 1)
        for runs in window_runs(texts) if len(plain) else ():
            at = np.minimum(np.searchsorted(plain, runs.anchor), len(plain) - 1)
            kept = plain[at] == runs.anchor
            for part, one_by_one in ((runs.some(kept & ~hot[at]), False), (runs.some(kept & hot[at]), True)):
                if not len(part.doc):
                    continue
                part = part.one_by_one() if one_by_one else part
                data, ends = part.data, part.at + part.count + (LENGTH - 1)
                found = [data[a:b] for a, b in zip(part.at.tolist(), ends.tolist())]
                before = len(numbers)
                number = np.fromiter(map(numbers.__getitem__, found), np.int64, len(found))
                new = np.nonzero(number >= before)[0]
                first = new[np.unique(number[new], return_index=True)[1]]
                if one_by_one:
                    routes.append(np.array([zlib.crc32(found[i]) for i in first.tolist()], np.int64))
                else:
                    routes.append((part.anchor[first] >> np.uint64(32)).astype(np.int64))
                of.append(number)
                docs.append(part.doc)
                starts.append(part.start)
        self.of, self.docs, self.starts, route = (np.concatenate(x) for x in (of, docs, starts, routes))
        self.texts = list(numbers)
        self.pieces = np.zeros(len(numbers), _PIECE)
        self.pieces["route"] = route
        self.pieces["size"] = np.fromiter(map(len, self.texts), np.int64, len(numbers))
        self.range = route % ranges
        owners = np.asarray(keys, np.int64)[self.docs]
        order = np.argsort(self.of, kind="stable")
        heads = np.nonzero(np.diff(self.of[order], prepend=-1))[0]
        if len(heads):
            owners = owners[order]
            least = np.minimum.reduceat(owners, heads)
            self.pieces["least"], self.pieces["several"] = least, np.maximum.reduceat(owners, heads) > least

    def dealt(self) -> Iterator[tuple[int, np.ndarray]]:
        """Every range with its pieces, in the order in which they are sent."""
        order = np.argsort(self.range, kind="stable")
        cuts = np.nonzero(np.diff(self.range[order], prepend=-1))[0]
        for own in np.split(order, cuts[1:]) if len(order) else ():
            yield int(self.range[own[0]]), own


def _shared_of(rows: pd.DataFrame) -> np.ndarray:
    lists = [np.frombuffer(b, np.uint64) for b in rows["anchors"].dropna()]
    return np.concatenate(lists) if lists else np.empty(0, np.uint64)


def _in_order(chunk: pd.DataFrame) -> pd.DataFrame:
    return chunk.sort_values("row", kind="stable")


def _send_pieces(ranges: int):
    def run(chunk: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(chunk) and len(shared):
            chunk = _in_order(chunk)
            found = Pieces(chunk["doc_id"].tolist(), chunk["text"].tolist(), _shared_of(shared), ranges)
            name = chunk["chunk"].iloc[0]
            rows = [(r, name, b"".join(found.texts[i] for i in own), found.pieces[own].tobytes()) for r, own in found.dealt()]
        return pd.DataFrame(rows, columns=["range", "chunk", "text", "pieces"])

    return run


def refine(pointers: np.ndarray, places: np.ndarray, ahead: int) -> tuple[np.ndarray, np.ndarray]:
    """One round: buckets of ``places`` sorted on the pointers ``ahead`` places further on.

    ``pointers`` is updated: a part of a bucket points to its own first rank. Returns the places that
    still share a bucket, in order, and the heads of their buckets.
    """
    own, further = pointers[places], pointers[places + ahead]
    order = np.argsort(own * len(pointers) + further)  # below 2^63 for any batch that fits in memory
    places, own, further = places[order], own[order], further[order]
    new_own = np.concatenate([[True], own[1:] != own[:-1]])[: len(own)]
    new = new_own | np.concatenate([[True], further[1:] != further[:-1]])[: len(own)]
    rank = np.arange(len(own))
    bucket = np.maximum.accumulate(np.where(new_own, rank, 0))
    part = np.maximum.accumulate(np.where(new, rank, 0))
    pointers[places] = own + part - bucket
    return _shared_buckets(places, np.nonzero(new)[0])


def _shared_buckets(places: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(np.append(heads, len(places)))
    kept = np.repeat(sizes > 1, sizes)
    sizes = sizes[sizes > 1]
    return places[kept], np.cumsum(sizes) - sizes


def equal_windows(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places where equal windows of the pieces in ``data`` start, bucket by bucket, and the buckets' heads."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    room = ends - np.arange(len(data))
    words = words_of(data)
    places = np.nonzero(room >= FIRST)[0]
    order = np.argsort(words[places])
    places = places[order]
    keys = words[places]
    heads = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])[0]
    counts = np.diff(np.append(heads, len(keys)))
    # A pointer is the first rank of the bucket; a suffix alone in its bucket meets no other.
    pointers = np.full(len(data), -1, np.int64)
    pointers[places] = np.repeat(heads, counts)
    places, heads = _shared_buckets(places, heads)
    depth = FIRST
    while depth < LENGTH and len(places):
        ahead = min(depth, LENGTH - depth)
        alive = room[places] >= depth + ahead
        places, heads = refine(pointers, places[alive], ahead)
        depth += ahead
    return (places, heads) if depth >= LENGTH else (places[:0], heads[:0])


def least_keys(texts: list[bytes], sizes: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one smallest key among the pieces that have them: piece, first window, windows, key."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    keys = np.repeat(least, sizes)
    places, heads = equal_windows(data, sizes)
    if len(places):
        smallest = np.minimum.reduceat(keys[places], heads)
        keys = keys.copy()
        keys[places] = np.repeat(smallest, np.diff(np.append(heads, len(places))))
    begins = np.cumsum(sizes) - sizes
    piece = np.repeat(np.arange(len(sizes)), sizes)
    inside = np.arange(len(data)) - begins[piece]
    windows = np.nonzero(inside + LENGTH <= sizes[piece])[0]
    piece, inside, keys = piece[windows], inside[windows], keys[windows]
    heads = np.nonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (piece[1:] != piece[:-1])])[: len(keys)])[0]
    return piece[heads], inside[heads], np.diff(np.append(heads, len(keys))), keys[heads]


def _sort_suffixes(rows: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one range: which windows a document with a smaller key has."""
    tables = [np.frombuffer(b, _PIECE) for b in rows["pieces"]]
    texts: list[bytes] = []
    for blob, table in zip(rows["text"], tables):
        at = np.cumsum(table["size"], dtype=np.int64).tolist()
        texts += [blob[a:b] for a, b in zip([0, *at[:-1]], at)]
    pieces = np.concatenate(tables)
    row_of = np.repeat(np.arange(len(tables)), [len(t) for t in tables])
    number = np.concatenate([np.arange(len(t)) for t in tables])
    # Equal pieces are one; pieces with different routes never share a window.
    numbers = _Numbers()
    same = np.fromiter(map(numbers.__getitem__, texts), np.int64, len(texts))
    different = list(numbers)
    first = np.unique(same, return_index=True)[1]
    least = np.full(len(different), np.iinfo(np.int64).max)
    np.minimum.at(least, same, pieces["least"])
    told = _told(different, pieces["route"][first], pieces["size"][first].astype(np.int64), least)
    piece, begin, count, key = told
    firsts, times = np.searchsorted(piece, np.arange(len(different))), np.bincount(piece, minlength=len(different))
    times = times[same]
    of = np.repeat(np.arange(len(same)), times)
    at = firsts[same][of] + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
    useful = (key[at] < pieces["least"][of]) | (pieces["several"][of] > 0)
    of, at = of[useful], at[useful]
    replies = np.zeros(len(of), _REPLY)
    replies["piece"], replies["first"], replies["count"], replies["least"] = number[of], begin[at], count[at], key[at]
    row = row_of[of]
    cuts = np.searchsorted(row, np.arange(len(tables) + 1)).tolist()
    kept = [i for i in range(len(tables)) if cuts[i] < cuts[i + 1]]
    return pd.DataFrame(
        {
            "chunk": rows["chunk"].iloc[kept].to_numpy(),
            "range": rows["range"].iloc[kept].to_numpy(),
            "replies": [replies[cuts[i] : cuts[i + 1]].tobytes() for i in kept],
        }
    )


def _told(texts: list[bytes], routes: np.ndarray, sizes: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, ...]:
    """``least_keys`` of different pieces, in the order of the pieces, worked out in bounded batches."""
    order = np.argsort(routes, kind="stable")
    routes = routes[order]
    # A piece alone with its route meets no other: its windows have its own key.
    alone = np.concatenate([[True], routes[1:] != routes[:-1]]) & np.concatenate([routes[1:] != routes[:-1], [True]])
    single = order[alone]
    found = [(single, np.zeros(len(single), np.int64), sizes[single] - LENGTH + 1, least[single])]
    order, routes = order[~alone], routes[~alone]
    ends, start = np.cumsum(sizes[order]), 0
    while start < len(order):
        # As many pieces as fit, and the rest of the last route.
        end = np.searchsorted(ends, (ends[start - 1] if start else 0) + PART, "right")
        end = np.searchsorted(routes, routes[max(end, start + 1) - 1], "right")
        own = order[start:end]
        piece, *rest = least_keys([texts[i] for i in own.tolist()], sizes[own], least[own])
        found.append((own[piece], *rest))
        start = int(end)
    columns = [np.concatenate(c) for c in zip(*found)]
    order = np.argsort(columns[0], kind="stable")
    return tuple(c[order] for c in columns)


# Step 3: cutting

_CUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removed_spans(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching spans as maximal ones."""
    order = np.argsort(begins, kind="stable")
    begins, ends = begins[order], np.maximum.accumulate(ends[order])
    heads = np.nonzero(np.concatenate([[True], begins[1:] > ends[:-1]])[: len(begins)])[0]
    return begins[heads], ends[np.append(heads[1:], len(begins))[: len(heads)] - 1]


def chunk_spans(keys: Sequence[int], found: Pieces, replies: dict[int, np.ndarray]) -> dict[int, tuple]:
    """Maximal removed spans of the documents of a chunk, by the document's place in it."""
    docs, begins, ends = [], [], []
    keys = np.asarray(keys, np.int64)
    by_piece = np.argsort(found.of, kind="stable")
    counts = np.bincount(found.of, minlength=len(found.texts))
    firsts = np.cumsum(counts) - counts
    for number, own in found.dealt():
        told = replies.get(number)
        if told is None:
            continue
        piece = own[told["piece"]]
        times = counts[piece]
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        at = by_piece[np.repeat(firsts[piece], times) + inside]
        least, first, count = (np.repeat(told[c].astype(np.int64), times) for c in ("least", "first", "count"))
        goes = least < keys[found.docs[at]]
        at, first, count = at[goes], first[goes], count[goes]
        docs.append(found.docs[at])
        begins.append(found.starts[at] + first)
        ends.append(found.starts[at] + first + count - 1 + LENGTH)
    if not docs:
        return {}
    docs, begins, ends = np.concatenate(docs), np.concatenate(begins), np.concatenate(ends)
    order = np.argsort(docs, kind="stable")
    docs, begins, ends = docs[order], begins[order], ends[order]
    heads = np.nonzero(np.diff(docs, prepend=-1))[0]
    return {
        int(docs[a]): removed_spans(begins[a:b], ends[a:b])
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(docs)])
    }


def _kept(text: bytes, begins: np.ndarray, ends: np.ndarray) -> Iterator[bytes]:
    at = 0
    for a, b in zip(begins.tolist(), ends.tolist()):
        yield text[at:a]
        at = b
    yield text[at:]


def _cut(ranges: int, whole_texts: bool):
    def run(chunk: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        chunk = _in_order(chunk)
        keys, texts = chunk["doc_id"].tolist(), chunk["text"].tolist()
        spans: dict[int, tuple] = {}
        answers = told[told["replies"].notna()]
        if len(chunk) and len(answers):
            found = Pieces(keys, texts, _shared_of(told), ranges)
            replies = {int(r): np.frombuffer(b, _REPLY) for r, b in zip(answers["range"], answers["replies"])}
            spans = chunk_spans(keys, found, replies)
        none = np.empty(0, np.int64)
        rows = []
        for i, (key, text) in enumerate(zip(keys, texts)):
            begins, ends = spans.get(i, (none, none))
            if whole_texts:
                rows.append((key, b"".join(_kept(text, begins, ends)), list(zip(begins.tolist(), ends.tolist()))))
                continue
            digest = hashlib.sha256()
            for part in _kept(text, begins, ends):
                digest.update(part)
            rows.append((key, len(text), int((ends - begins).sum()), len(begins), digest.hexdigest()))
        names = ["doc_id", "kept", "spans"] if whole_texts else [f.split()[0] for f in _CUT.split(", ")]
        return pd.DataFrame(rows, columns=names)

    return run


_KEPT = "doc_id long, kept binary, spans array<struct<begin:long,end:long>>"


def _in_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with the number of their chunk and their place in the task."""
    task, chunk, size, row = TaskContext.get().partitionId() << 32, 0, 0, 0
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_pylist()
        numbers = []
        for n in sizes:
            if size and size + n > CHUNK:
                chunk, size = chunk + 1, 0
            size += n
            numbers.append(task + chunk)
        places = np.arange(row, row + len(sizes))
        row += len(sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(places, pa.int64()), *batch.columns], ["chunk", "row", "doc_id", "text"]
        )


def _run(docs: DataFrame, key: str, text: str, whole_texts: bool) -> DataFrame:
    """The cut documents among those that can lose or give something; ``docs`` are key and text, usable."""
    spark = docs.sparkSession
    ship_code(spark)
    total = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(partitions, -(-total // RANGE))
    buckets = min(max(partitions, -(-total // BUCKET)), MOST_BUCKETS)
    usable = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    chunked = map_batches(usable, "chunk long, row long, doc_id long, text binary", _in_chunks)
    name = f"suffix_texts_{uuid.uuid4().hex}"
    # A task writes few chunks, so few files; nothing is shuffled. The folder is a shared one.
    chunked.write.format("parquet").option("compression", "zstd").option("path", fresh_path(spark, name)).bucketBy(
        buckets, "chunk"
    ).saveAsTable(name)
    try:
        texts = spark.table(name)
        by_chunk = texts.groupBy("chunk")
        listed = by_chunk.applyInPandas(_list_anchors(ranges), _ANCHORS)
        shared = listed.groupBy("range").applyInPandas(_find_shared, _SHARED)
        shared = materialize(shared, "shared-anchors")
        sent = by_chunk.cogroup(shared.groupBy("chunk")).applyInPandas(_send_pieces(ranges), _PIECES)
        replies = sent.groupBy("range").applyInPandas(_sort_suffixes, _REPLIES)
        replies = materialize(replies, "window-replies")
        none = F.lit(None)
        told = shared.select("chunk", "anchors", none.cast("int").alias("range"), none.cast("binary").alias("replies"))
        told = told.unionByName(replies.withColumn("anchors", none.cast("binary")))
        cut = by_chunk.cogroup(told.groupBy("chunk")).applyInPandas(
            _cut(ranges, whole_texts), _KEPT if whole_texts else _CUT
        )
        return materialize(cut, "cut-texts")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _usable(key: str, text: str):
    return F.col(key).isNotNull() & (F.octet_length(text) >= LENGTH)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("text"))
    usable = _usable("doc_id", "text")
    zero = F.lit(0).cast("long")
    rest = rows.filter(~usable).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"),
    )
    return _run(rows.filter(usable), "doc_id", "text", False).unionByName(rest)


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, kept (bytes, which may begin or end inside a character) and spans (removed, begin and end) of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), body.alias("text"))
    usable = _usable("doc_id", "text")
    spans = F.array().cast("array<struct<begin:long,end:long>>")
    rest = rows.filter(~usable).select("doc_id", F.col("text").cast("binary").alias("kept"), spans.alias("spans"))
    return _run(rows.filter(usable), "doc_id", "text", True).unionByName(rest)
