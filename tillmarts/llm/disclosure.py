"""Information-theoretic sanitisation of personal data.

Entities (e-mail and IP addresses, card and phone numbers) are found by their form and protected
everywhere. Terms in the same documents can reveal them as well: how strongly, the corpus tells. With
documents as units, a term t discloses an entity E as far as its pointwise mutual information,

    PMI(t; E) = log2( N df(t, E) / (df(t) df(E)) ),

covers the information E holds, IC(E) = log2(N / df(E)). A document counts for (t, E) wherever t
stands in it. Terms are whole words of any length: runs of letters, digits and underscores outside
entities, compared in lower case. Few observations prove little, and copies prove nothing new, so the share of t that
falls to E, df(t, E) / df(t), is smoothed:

    seen / (seen + df(t) - df(t, E) + SUPPORT),

where ``seen`` counts the different surroundings of E that t was met with: in one document as many as
E has there, but no more than t has places; surroundings that several documents share count once. There
is no least number of documents. Terms for which the smoothed PMI reaches ``DISCLOSURE`` of IC become
spans of kind ``term``, at every place of every document that holds E, or with ``everywhere`` of every
document. A term that never occurs without E is removed, others are generalised to the shape of a word.

All counts cover all documents. Words are counted per task before anything is shuffled, a document
gives each of its (entity, term) pairs once, summed per task before the shuffle, and only words whose
hash is that of a disclosing term are joined with those.

Defined results: NULL text counts as empty and has no spans; NULL and repeated keys are documents
like any other; overlapping spans of different kinds all stay in the list, and ``sanitise`` takes
the one that starts first, then the longer one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmarts.llm.common import map_batches
from tillmarts.storage import materialize

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("email", "ip", "card", "phone", "term")
#: Words on either side of an entity that tell its surroundings apart, and how far they are looked for.
WINDOW_WORDS, WINDOW_CHARS = 8, 160
#: Share of an entity's information from which a term discloses it; documents without the entity that
#: every term is taken to stand in besides those it does.
DISCLOSURE, SUPPORT = 0.75, 3
#: Different words a task counts before it hands them on, or remembers.
COUNTED_WORDS = 200_000
#: Bits that tell words that may be disclosing terms from the rest, by CRC-32.
BITS = 1 << 22

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: Possessive, and begun only at a number's first digit: as the plain pattern, but linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: Whole words, short ones, digits and user names included; the PMI decides.
_TERM = re.compile(r"\w+")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from their @, so long runs cost no more."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        after = at + 1
        if start < at and (m := _DOMAIN.match(text, after)):
            found.append((start, m.end()))
            free = after = m.end()
        at = text.find("@", after)
    return found


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all entities, in order; kinds by their place in ``KINDS``."""
    spans = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        spans += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = _NOT_DIGIT.sub("", m[0])
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    spans.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def _hashed(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _terms(text: str, start: int, end: int, last: bool) -> list[tuple[str, int, int]]:
    """Whole words between two places, the last or the first ``WINDOW_WORDS`` of them."""
    words = []
    for m in _TERM.finditer(text, start, end):
        before = m.start() > 0 and m.start() == start and _TERM.match(text, start - 1)
        after = m.end() < len(text) and m.end() == end and _TERM.match(text, end)
        if not before and not after:
            words.append((m[0].lower(), m.start(), m.end()))
    return words[-WINDOW_WORDS:] if last else words[:WINDOW_WORDS]


def uncovered(words: list[tuple[str, int, int]], spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
    """Those of ``words`` that no span overlaps; both in order of their start, so one merge finds them."""
    left, i, reach = [], 0, 0
    for word, a, b in words:
        while i < len(spans) and spans[i][0] < b:
            reach = max(reach, spans[i][2])
            i += 1
        if reach <= a:
            left.append((word, a, b))
    return left


def words_outside(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of all words of a text but those in its entities."""
    return uncovered([(m[0].lower(), m.start(), m.end()) for m in _TERM.finditer(text)], spans)


def _entity(text: str, start: int, kind: int, end: int) -> int:
    value = text[start:end].lower() if kind < 2 else _NOT_DIGIT.sub("", text[start:end])
    return _hashed(f"{kind}:{value}")


def contexts(text: str, spans: list[tuple[int, int, int]]) -> dict[int, set[int]]:
    """The entities of a text, each with the hashes of its surroundings."""
    found: dict[int, set[int]] = {}
    for start, kind, end in spans:
        left = _terms(text, max(0, start - WINDOW_CHARS), start, True)
        right = _terms(text, end, min(len(text), end + WINDOW_CHARS), False)
        around = _hashed(" ".join(w for w, _, _ in [*left, ("|", 0, 0), *right]))
        found.setdefault(_entity(text, start, kind, end), set()).add(around)
    return found


def surroundings(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, str, int, int]]:
    """(entity, hash of its first surroundings, term, start, end) for every term in an entity's text."""
    words = words_outside(text, spans)
    return [(entity, min(around), *word) for entity, around in contexts(text, spans).items() for word in words]


_NEAR = pa.struct([("entity", pa.int64()), ("around", pa.list_(pa.int64()))])
_TERMS = pa.struct([("term", pa.string()), ("n", pa.int32())])
FOUND = "near array<struct<entity: long, around: array<long>>>, terms array<struct<term: string, n: int>>"


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entities of every text and, once for all of them, its different terms and their number."""
    for batch in batches:
        near, terms = [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            spans = base_spans(text)
            near.append([{"entity": e, "around": sorted(a)} for e, a in contexts(text, spans).items()])
            counts = Counter(w for w, _, _ in words_outside(text, spans)) if spans else {}
            terms.append([{"term": w, "n": n} for w, n in counts.items()])
        columns = [pa.array(near, pa.list_(_NEAR)), pa.array(terms, pa.list_(_TERMS))]
        yield pa.RecordBatch.from_arrays(columns, ["near", "terms"])


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_PLACE = pa.struct([("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
MARKED = (
    "task int, number long, doc_id long, base array<struct<start: long, kind: int, end: long>>, "
    "entities array<long>, places array<struct<term: string, start: long, end: long>>"
)


def _mark(bits: bytes):
    """Entities and the words that may be disclosing terms, with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        known: dict[str, bool] = {}

        def wanted(word: str) -> bool:
            answer = known.get(word)
            if answer is None:
                bit = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % BITS
                answer = bool(bits[bit >> 3] >> (bit & 7) & 1)
                if len(known) >= COUNTED_WORDS:
                    known.clear()
                known[word] = answer
            return answer

        for batch in batches:
            base, entities, places = [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = base_spans(text)
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                entities.append(list({_entity(text, *span) for span in spans}))
                hits = {w for w in set(_TERM.findall(text)) if wanted(w)} if bits else ()
                words = [(m[0].lower(), *m.span()) for m in _TERM.finditer(text) if m[0] in hits] if hits else []
                places.append([{"term": w, "start": a, "end": b} for w, a, b in uncovered(words, spans)])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([task] * n, pa.int32()),
                    pa.array(range(number, number + n), pa.int64()),
                    batch.column(0),
                    pa.array(base, pa.list_(_SPAN)),
                    pa.array(entities, pa.list_(pa.int64())),
                    pa.array(places, pa.list_(_PLACE)),
                ],
                ["task", "number", "doc_id", "base", "entities", "places"],
            )
            number += n

    return run


def _bits(risky: DataFrame) -> bytes:
    """A bit for the hash of every term of ``risky``; the driver receives at most ``BITS`` numbers."""
    numbers = risky.select((F.crc32(F.col("term").cast("binary")) % BITS).alias("bit")).distinct().toArrow()
    bits = bytearray(BITS >> 3)
    for bit in numbers.column(0).to_pylist():
        bits[bit >> 3] |= 1 << (bit & 7)
    return bytes(bits) if numbers.num_rows else b""


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["term", "n"]
        )

    for batch in batches:
        for value in batch.column(0):
            counts.update({w.lower() for w in set(_TERM.findall(value.as_py() or ""))})
            if len(counts) >= COUNTED_WORDS:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def disclosing_terms(
    found: DataFrame,
    docs: DataFrame,
    text: str = "text",
    disclosure: float = DISCLOSURE,
    support: int = SUPPORT,
) -> DataFrame:
    """entity, term and whether the term occurs with that entity only, for pairs over the thresholds."""
    total = found.count()
    near = found.select(F.explode("near").alias("x"), "terms").select("x.*", "terms")
    met = near.select("entity", "around", F.explode("terms").alias("x"))
    met = met.select("entity", "x.term", F.slice("around", F.lit(1), F.least(F.size("around"), "x.n")).alias("around"))
    # The document itself counts once, with the first of its surroundings.
    met = met.select("entity", "term", F.posexplode("around").alias("at", "around"))
    pairs = met.groupBy("entity", "term", "around").agg(F.sum((F.col("at") == 0).cast("long")).alias("n"))
    pairs = pairs.groupBy("entity", "term").agg(F.sum("n").alias("df_pair"), F.count(F.lit(1)).alias("seen"))
    # Of documents without the entity there are none at best, and of those with it at least df_pair.
    best = F.col("seen") / (F.col("seen") + support)
    pairs = materialize(pairs.filter(_reaches(best, F.col("df_pair"), total, disclosure)), "pairs")
    entities = near.groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity"))
    wanted = pairs.select("term").distinct()
    words = map_batches(docs.select(text), "term string, n long", _count)
    words = words.groupBy("term").agg(F.sum("n").alias("df_term")).join(wanted, "term", "left_semi")
    joined = pairs.join(entities, "entity").join(words, "term")
    share = F.col("seen") / (F.col("seen") + F.col("df_term") - F.col("df_pair") + support)
    return joined.filter(_reaches(share, F.col("df_entity"), total, disclosure)).select(
        "entity", "term", (F.col("df_term") <= F.col("df_pair")).alias("only_here")
    )


def _reaches(share: Column, df_entity: Column, total: int, disclosure: float) -> Column:
    """Whether a term discloses: for ``disclosure`` in [0, 1] never more easily with a larger ``df_entity``."""
    information = F.log2(F.lit(float(max(total, 1))) / df_entity)
    return (information > 0) & (information + F.log2(share) >= information * disclosure)


def find(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    disclosure: float = DISCLOSURE,
    support: int = SUPPORT,
    everywhere: bool = False,
) -> DataFrame:
    """task, number (a row's place), doc_id, base and terms: arrays of spans in order of their start.

    Spans are structs of start, kind, end (code points, end exclusive); terms also say whether the
    term occurs with the entity only. A disclosing term is marked wherever it stands in documents that
    hold its entity, with ``everywhere`` in all documents.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = materialize(map_batches(rows, FOUND, _find), "personal-data")
    risky = materialize(disclosing_terms(found, rows, "text", disclosure, support), "disclosing")
    marked = materialize(map_batches(rows, MARKED, _mark(_bits(risky))), "marked")
    places = marked.select("task", "number", "entities", F.explode("places").alias("x"))
    if everywhere:
        flagged = risky.groupBy("term").agg(F.max("only_here").alias("only_here"))
        terms = places.select("task", "number", "x.*").join(flagged, "term")
    else:
        places = places.select("task", "number", F.explode("entities").alias("entity"), "x.*")
        terms = places.join(risky, ["entity", "term"])
    span = F.struct("start", F.lit(KINDS.index("term")).alias("kind"), "end", "only_here")
    terms = terms.groupBy("task", "number", "start", "end").agg(F.max("only_here").alias("only_here"))
    terms = terms.groupBy("task", "number").agg(F.sort_array(F.collect_list(span)).alias("terms"))
    empty = F.array().cast("array<struct<start: long, kind: int, end: long, only_here: boolean>>")
    marked = marked.drop("entities", "places").join(terms, ["task", "number"], "left")
    return marked.withColumn("terms", F.coalesce("terms", empty))


def listed(spans):
    """Spans as text: kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def report(found: DataFrame) -> DataFrame:
    """doc_id, the number of spans of each base kind, the digest of the base spans and all spans as text."""
    plain = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:4])],
        F.size("terms").cast("long").alias("n_term"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.sort_array(F.concat("base", plain))).alias("spans"),
    )


def _shape(word: str) -> str:
    return "Xxx" if word[:1].isupper() else "xxx"


def sanitise_text(text: str, spans: list[tuple[int, int, int, bool]]) -> str:
    """``text`` with entities named by their kind, and terms removed or reduced to a shape."""
    out, at = [], 0
    for start, kind, end, only_here in sorted(spans, key=lambda s: (s[0], -s[2], s[1])):
        if start >= at:
            label = f"<{KINDS[kind]}>" if kind < 4 else "" if only_here else _shape(text[start:end])
            out += [text[at:start], label]
            at = end
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the sanitised text; keys must be unique and not NULL."""
    spans = found.select(
        F.col("doc_id").alias("_key"),
        F.concat(
            F.transform(
                "base",
                lambda s: F.struct(
                    s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
                    F.lit(False).alias("only_here"),
                ),
            ),
            F.col("terms"),
        ).alias("spans"),
    )
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.join(spans, F.col("doc_id") == F.col("_key")).select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            texts = [sanitise_text(t or "", [tuple(x.values()) for x in s]) for t, s in columns]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_batches(rows, "doc_id long, text string", run)
