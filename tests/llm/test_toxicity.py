import random
import re
import time

import numpy as np
import pytest

from tillmarts.llm import toxicity as T


def corpus(words, n, seed):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        sentences = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 12))) for _ in range(rng.randint(1, 15))]
        toxic = i % 4 == 0
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] += " " + rng.choice(["vilefoo", "vilebar", "nastyword"])
        texts.append(". ".join(sentences) + ".")
        labels.append(int(toxic))
    return texts, np.array(labels)


@pytest.fixture(scope="module")
def model(words):
    return T.fit(*corpus(words, 600, 1))


def test_held_out_documents(words, model):
    texts, labels = corpus(words, 300, 2)
    scores = np.array([T.Scorer(model).document(t) for t in texts])
    assert ((scores >= T.THRESHOLD) == labels).mean() > 0.97
    assert scores.min() >= 0 and scores.max() <= 1


def test_one_offending_sentence_is_enough_and_is_found(spark, words, model, documents):
    clean = ". ".join(" ".join(words[i : i + 8]) for i in range(0, 200, 8))
    text = clean + ". This is vilefoo here. " + clean
    scorer = T.Scorer(model)
    assert scorer.document(clean) < T.THRESHOLD <= scorer.document(text)
    found = T.locate(documents([(1, text, "en", "a"), (2, clean, "en", "a"), (None, None, "", "")]), model).collect()
    assert [(r.doc_id, text[r.begin : r.end].strip()) for r in found] == [(1, "This is vilefoo here")]


def test_other_forms_of_a_stem_count(model):
    assert T.Scorer(model).document("some vilefoos there") > T.Scorer(model).document("some plain there")


def test_quick_path_equals_the_sum_of_sentences(words, model):
    text = ". ".join(words[:40])
    scorer = T.Scorer(model)
    total = sum(scorer.sentence(m[0]) for m in T.sentences(text))
    assert scorer.document(text) == pytest.approx(-np.expm1(-total))


def test_gradient_fits_what_it_says():
    texts = ["a bad thing. b", "b. a", "bad", "a. b. a b"] * 5
    model = T.fit(texts, np.array([1, 0, 1, 0] * 5))
    score = T.Scorer(model).document
    assert min(score("bad"), score("a bad thing. b")) > 0.9 and max(score("b. a"), score("a. b. a b")) < 0.1


def test_scores_of_awkward_rows(spark, documents, awkward_rows, model):
    docs = documents(awkward_rows, extra=True)
    got = T.score(docs, model)
    assert got.columns == ["doc_id", "score", "predicted"] and got.count() == len(awkward_rows)
    by_id = {r.doc_id: r.score for r in got.filter("doc_id IN (3, 4, 5)").collect()}
    assert by_id == {3: 0.0, 4: 0.0, 5: 0.0}
    kept = T.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == got.filter("predicted = 0").count()


def test_training_takes_labels_with_nulls_repeats_and_conflicts(spark, documents, words):
    texts, labels = corpus(words, 200, 3)
    docs = documents([(i, t, "en", "a") for i, t in enumerate(texts)] + [(None, "x", "", ""), (900, None, "", "")], extra=True)
    rows = [(i, int(y)) for i, y in enumerate(labels)] + [(0, 0), (None, 1), (5, None), (900, 0), (9999, 1)]
    known = spark.createDataFrame(rows, "doc_id long, toxic int").selectExpr("*", "1 AS quality", "'x' AS text")
    model = T.train(docs, known)
    scores = {r.doc_id: r.predicted for r in T.score(docs, model).filter("doc_id < 900").collect()}
    assert np.mean([scores[i] == y for i, y in enumerate(labels)]) > 0.95
    assert T.train(docs, known, sample=50).weights != model.weights


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1), (2, 1)]])
def test_without_both_labels_everything_scores_zero(spark, documents, labels):
    docs = documents([(1, "a b", "", ""), (2, "c", "", "")])
    model = T.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert [r.score for r in T.score(docs, model).collect()] == [0.0, 0.0]
    assert T.score(documents([]), model).count() == 0 and T.locate(docs, model).count() == 0


def test_every_toxic_document_has_a_located_sentence(documents):
    """Three sentences of 0.15 to 0.2 make a toxic document; the worst of them is named."""
    weights = {"mildfoo$": 2.2, "mildbar$": 2.6}
    model = T.Model(-4.0, weights)
    text = "One mildfoo here. Then mildbar there. And mildbar again."
    scorer = T.Scorer(model)
    parts = [-np.expm1(-scorer.sentence(m[0])) for m in T.sentences(text)]
    assert max(parts) < T.SENTENCE_THRESHOLD and scorer.document(text) >= T.THRESHOLD
    docs = documents([(1, text, "en", "a"), (2, "One mildfoo here.", "en", "a"), (3, None, "en", "a")])
    found = T.locate(docs, model).collect()
    assert [(r.doc_id, text[r.begin : r.end].strip()) for r in found] == [(1, "Then mildbar there")]
    rows = {r.doc_id: r for r in T.score_and_locate(docs, model).collect()}
    assert rows[1].located == f"{found[0].begin}:{found[0].end}" and rows[2].located == rows[3].located == ""


def test_sentences_have_a_word_between_their_ends():
    rng = random.Random(3)
    before = re.compile(r"[^\w.!?\n]*\w[^.!?\n]*")  # what a sentence is, in one pattern
    for _ in range(300):
        text = "".join(rng.choice("ab é_-= .!?\n\t漢") for _ in range(rng.randint(0, 40)))
        assert [(m.start(), m.end()) for m in T.sentences(text)] == [m.span() for m in before.finditer(text)]


@pytest.mark.parametrize("filler", ["-", "= ", " ", "\t", "–", "-.", "a", "a "])
def test_long_texts_without_words_take_linear_time(model, filler):
    text = "Start here. " + filler * (1_000_000 // len(filler)) + " vilefoo end"
    started = time.process_time()
    score, found = T.offending(T.Scorer(model), text)
    assert score >= T.THRESHOLD and found and text[slice(*found[-1][:2])].rstrip().endswith("end")
    T.fit([text, "plain words"] * 2, np.array([1, 0, 1, 0]))
    assert time.process_time() - started < 10


def test_the_sample_is_bounded_in_bytes(spark, documents, words):
    texts, labels = corpus(words, 200, 3)
    docs = documents([(i, t, "en", "a") for i, t in enumerate(texts)] + [(500, "vilefoo " * 50_000, "en", "a")])
    known = spark.createDataFrame([(i, int(y)) for i, y in enumerate(labels)] + [(500, 0)], "doc_id long, toxic int")
    whole = T.train(docs, known, sample_bytes=8 * sum(map(len, texts)))
    assert whole == T.train(docs.filter("doc_id < 500"), known)  # the long text is passed over
    assert T.train(docs, known, sample_bytes=20_000) != whole
    assert T.train(docs, known, sample_bytes=10) == T.Model(0.0, {})
