"""Toxicity by multiple-instance learning.

A document is a bag of sentences and is toxic if at least one of them is. A sentence's score is a
logistic one over its words, and the sentences of a document are combined by noisy-or,
1 - prod(1 - p). Labels exist for documents only, so the weights are fitted through the noisy-or;
what the model then gives for single sentences tells which ones offend.

A word counts by itself and by its first letters, so inflected and compounded forms share what
their stem has taught. Weights are never negative: words can make a sentence offend, but none can
excuse another, so one insult in a long sentence is enough. Language, source, key and label are never inputs of a score.

The model is fitted in one task on a sample of at most ``SAMPLE`` labelled rows (those with the
smallest hash of their key, so the sample is the same in every run) with at most ``SAMPLE_BYTES``
of text together, of which no text has more than an eighth; scoring reads every text.

Defined results: NULL, empty and wordless texts score 0; very long texts are read whole; rows with
a NULL label or key teach nothing; if a key has several labels, toxic wins; without any usable label
of both kinds every document scores 0; repeated rows score alike; other columns pass unchanged
through ``keep_clean`` and are ignored by ``score``.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tillmarts.llm import tokens
from tillmarts.llm.common import fresh_name, map_batches, ship_code
from tillmarts.storage import materialize

#: Most labelled rows, and most bytes of their texts, the model is fitted on.
SAMPLE, SAMPLE_BYTES = 12_000, 32 << 20
#: From this score on a document counts as toxic.
THRESHOLD = 0.3
#: From this score on a sentence is reported.
SENTENCE_THRESHOLD = 0.3
#: First letters that count as features of their own, and how many documents must have a feature.
PREFIXES, LEAST_DOCUMENTS = range(3, 9), 3
ROUNDS, RATE, SHRINK = 150, 0.15, 1e-5
#: Words a task remembers the weight of.
MEMO_WORDS = 100_000

_PIECE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


def sentences(text: str) -> Iterator[re.Match]:
    """What stands between ends of sentences and has at least one word character."""
    return (m for m in _PIECE.finditer(text) if _WORD.search(text, m.start(), m.end()))


def word_features(word: str) -> list[str]:
    return [word + "$", *[word[:n] for n in PREFIXES if n <= len(word)]]


@dataclass(frozen=True)
class Model:
    bias: float
    weights: dict[str, float]


class _WordWeights(dict):
    """A word's weight, worked out when it is first met."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.features = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= MEMO_WORDS:
            self.clear()
        weight = self[word] = sum(self.features.get(f, 0.0) for f in word_features(word))
        return weight


def _softplus(z: float) -> float:
    return z if z > 30 else math.log1p(math.exp(z))


class Scorer:
    def __init__(self, model: Model):
        self.bias, self.words = model.bias, _WordWeights(model.weights)

    def sentence(self, sentence: str) -> float:
        """The sentence's share of -log(1 - score of the document)."""
        words = set(_WORD.findall(sentence.lower()))
        return _softplus(self.bias + sum(map(self.words.__getitem__, words))) if words else 0.0

    def document(self, text: str | None) -> float:
        if not text or not self.words.features:
            return 0.0
        found = sentences(text)
        if any(map(self.words.__getitem__, set(_WORD.findall(text.lower())))):
            total = sum(self.sentence(m[0]) for m in found)
        else:
            total = sum(1 for _ in found) * _softplus(self.bias)
        return -math.expm1(-total)


def fit(texts: Iterable[str | None], labels: Sequence[int] | np.ndarray) -> Model:
    """Weights that make the noisy-or of the sentences agree with the documents' labels.

    Texts are read once and not held: what stays of them is four bytes per different word of a
    sentence. Labels are read after the texts, so both may come from one iterator.
    """
    vocabulary: dict[str, int] = {}
    places, sentence_sizes, doc_at, documents = array("i"), array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        met: set[int] = set()
        for sentence in sentences(text or ""):
            words = set(_WORD.findall(sentence[0].lower()))
            if words:
                ids = [vocabulary.setdefault(w, len(vocabulary)) for w in sorted(words)]
                places.extend(ids)
                sentence_sizes.append(len(ids))
                doc_at.append(d)
                met.update(ids)
        documents.extend([0] * (len(vocabulary) - len(documents)))
        for word in met:
            documents[word] += 1
    labels = np.asarray(labels, np.float64)
    if not places or labels.min() == labels.max():
        return Model(0.0, {})
    word_at, doc_of = np.frombuffer(places, np.int32), np.frombuffer(doc_at, np.int32)
    sentence_of = np.repeat(np.arange(len(doc_of), dtype=np.int32), np.frombuffer(sentence_sizes, np.int32))

    # Features in at least so many documents; words point to theirs.
    counts: Counter[str] = Counter()
    for word, n in zip(vocabulary, documents):
        for feature in word_features(word):
            counts[feature] += n
    features = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= LEAST_DOCUMENTS))}
    if not features:
        return Model(0.0, {})
    pairs = [(w, features[f]) for word, w in vocabulary.items() for f in word_features(word) if f in features]
    of_word, of_feature = np.array(pairs, np.int64).reshape(-1, 2).T

    prior = labels.mean()
    per_sentence = -math.log1p(-prior) * len(labels) / len(doc_of)
    bias = math.log(math.expm1(per_sentence)) if per_sentence < 30 else per_sentence
    theta = np.zeros(len(features) + 1)
    theta[-1] = bias
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, ROUNDS + 1):
        word_weight = np.bincount(of_word, theta[of_feature], len(vocabulary))
        z = theta[-1] + np.bincount(sentence_of, word_weight[word_at], len(doc_of))
        total = np.bincount(doc_of, np.logaddexp(0, z), len(labels))
        # d(-log likelihood)/d(total): 1 for clean documents, 1 - 1 / (1 - exp(-total)) for toxic ones.
        slope = 1 - labels / np.maximum(-np.expm1(-total), 1e-6)
        by_sentence = slope[doc_of] / (1 + np.exp(-np.clip(z, -500, 500)))
        by_word = np.bincount(word_at, by_sentence[sentence_of], len(vocabulary))
        gradient = np.append(np.bincount(of_feature, by_word[of_word], len(features)), by_sentence.sum())
        gradient = gradient / len(labels)
        gradient[:-1] += SHRINK
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        np.maximum(theta[:-1], 0, out=theta[:-1])
    kept = {f: float(theta[i]) for f, i in features.items() if abs(theta[i]) > 1e-3}
    return Model(float(theta[-1]), kept)


def _fit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens.release()  # a reused worker may hold what an earlier operator has learnt
    labels: list[int] = []

    def texts() -> Iterator[str | None]:
        for batch in batches:
            labels.extend(batch.column(1).to_pylist())
            for text in batch.column(0):
                yield text.as_py()

    model = fit(texts(), labels)
    names = [None, *model.weights]
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([model.bias, *model.weights.values()], pa.float64())], ["feature", "weight"]
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
) -> Model:
    """Fit on at most ``sample`` rows of ``labels`` (key, toxic) with at most ``sample_bytes`` of text, no
    text above an eighth of that; labels whose rows ``docs`` lacks teach nothing."""
    known = labels.filter(F.col(key).isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy(F.col(key).cast("long").alias("_key")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("_key"), "_key").limit(sample)
    # Bounded by ``sample`` rows of two numbers, so sending it to every task is safe.
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("text")).join(
        F.broadcast(chosen), "_key"
    )
    # Too long a text is left out before it travels.
    rows = rows.filter(F.coalesce(F.octet_length("text"), F.lit(0)) <= sample_bytes // 8)
    once = rows.groupBy("_key").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
    once = materialize(once.withColumn("_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")), "labelled")
    # At most ``sample`` rows of a key and a size.
    order = W.orderBy(F.xxhash64("_key"), "_key")
    within = once.select("_key", F.sum("_bytes").over(order).alias("_sum")).filter(F.col("_sum") <= sample_bytes)
    fitted_on = once.join(F.broadcast(within.select("_key")), "_key").select("_key", "text", "toxic")
    fitted_on = fitted_on.repartition(1).sortWithinPartitions("_key").select("text", "toxic")
    fitted = map_batches(fitted_on, "feature string, weight double", _fit_rows).collect()  # the model
    bias = next((row.weight for row in fitted if row.feature is None), 0.0)
    return Model(bias, {row.feature: row.weight for row in fitted if row.feature is not None})


def with_score(docs: DataFrame, model: Model, name: str, text: str = "text") -> DataFrame:
    """``docs`` with the score of the whole text in column ``name``."""
    ship_code(docs.sparkSession)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.release()
        scorer = Scorer(model)
        for batch in batches:
            scores = [scorer.document(t.as_py()) for t in batch.column(at)]
            columns = [*batch.columns, pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def offending(scorer: Scorer, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
    """A document's score and (begin, end, score) of its offending sentences.

    Those are the ones from ``SENTENCE_THRESHOLD`` on; where only several weaker ones together bring
    the document to ``THRESHOLD``, the one that scores most, the first of equals.
    """
    whole = scorer.document(text)
    if whole < min(THRESHOLD, SENTENCE_THRESHOLD):  # no sentence scores more than its document
        return whole, []
    scored = [(m.start(), m.end(), -math.expm1(-scorer.sentence(m[0]))) for m in sentences(text)]
    found = [x for x in scored if x[2] >= SENTENCE_THRESHOLD]
    if not found and whole >= THRESHOLD:
        found = [max(scored, key=lambda x: x[2])]
    return whole, found


def score_and_locate(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score, predicted (1 from ``THRESHOLD`` on) and located of every document.

    ``located`` names the offending sentences, begin:end in code points joined by commas.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            both = [offending(scorer, t.as_py()) for t in batch.column(1)]
            located = [",".join(f"{a}:{b}" for a, b, _ in found) for _, found in both]
            columns = [batch.column(0), pa.array([s for s, _ in both], pa.float64()), pa.array(located, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score", "located"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scored = map_batches(rows, "doc_id long, score double, located string", run)
    return scored.select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "located")


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, score and predicted (1 from ``THRESHOLD`` on) of every document."""
    return score_and_locate(docs, model, key, text).drop("located")


def keep_clean(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents that score below ``THRESHOLD``, with the columns they came with."""
    name = fresh_name(docs, "score")
    return with_score(docs, model, name, text).filter(F.col(name) < THRESHOLD).select(docs.columns)


def locate(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Offending sentences: doc_id, begin and end (code points) and the sentence's own score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            found: list[tuple] = []
            for doc, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                found += [(doc, *sentence) for sentence in offending(scorer, body.as_py())[1]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]
            columns = list(zip(*found)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "begin", "end", "score"]
            )

    rows = docs.select(F.col(key).cast("long"), F.col(text))
    return map_batches(rows, "doc_id long, begin long, end long, score double", run)
