"""Small documents with every awkward case, and extra columns whose names clash with internal ones."""

from __future__ import annotations

import random

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHES = (
    "digest", "keep_id", "kept", "shard", "slot", "size", "score", "copies", "target", "_key", "_gone", "_digest",
    "_score", "_name", "group", "sig", "label", "tokens", "task", "number", "ids", "base", "terms", "component_id",
)


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]


@pytest.fixture(scope="session")
def awkward_rows(words):
    rng = random.Random(7)
    long = " ".join(rng.choice(words) for _ in range(30_000))
    return [
        (1, "One two three four five six.", "en", "a"),
        (2, "one TWO three four five six.", "en", "a"),
        (2, "one TWO three four five six.", "en", "a"),
        (3, None, "en", "b"),
        (4, "", None, "b"),
        (5, " \n\t ", "en", None),
        (6, long, "en", "c"),
        (7, long, "en", "c"),
        (8, "x" * 200_000, "en", "c"),
        (None, "no key at all", "en", "a"),
        (None, None, None, None),
        (9, "Ünïcode ÄÖÜ, ёлка 漢字 \U0001f600 é́.", "de", "é"),
        (10, "two words", "en", "é"),
    ]


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text, lang, source) as documents; ``extra`` adds the clashing columns."""

    def make(rows, extra=False):
        full = [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]
        df = spark.createDataFrame(full, DOCUMENT).repartition(3)
        if extra:
            df = df.selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHES])
        return df

    return make
