import hashlib
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillmarts.llm import disclosure as D

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(map(int, str(2 * int(d)))) for i, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def brute(text):
    found = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                found.append((m.start(), k, m.end()))
    return sorted(found)


PARTS = st.sampled_from(
    ["a", "Z9", "@", ".", "-", "_", "%", "+", " ", "1", "25", "255", "256", "0", "(", ")", "4111111111111111", "x.y@b.c",
     "1.2.3.4", "+49 30 1234567", "é", "\n", "4242-4242-4242-4242", "..", "@@"]
)


@settings(max_examples=1500, deadline=None)
@given(st.lists(PARTS, max_size=25).map("".join))
def test_base_spans_equal_the_plain_patterns(text):
    assert D.base_spans(text) == brute(text)


@pytest.mark.parametrize("text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "a.b" * 100_000 + "@", "+1" + " " * 300_000, "@" * 300_000, "a@" * 150_000])
def test_long_runs_are_linear(text):
    assert isinstance(D.base_spans(text), list)


def report(documents, rows, **settings):
    found = D.find(documents(rows, extra=True), **settings)
    return found, D.report(found).collect()


def test_awkward_rows(documents, awkward_rows):
    rows = awkward_rows + [(50, "Mail a.b@c.de, 10.0.0.1 or +49 30 1234567; card 4111 1111 1111 1111.", "en", "a")] * 2
    _, got = report(documents, rows)
    assert len(got) == len(rows)
    want = Counter()
    for i, text, *_ in rows:
        spans = brute(text or "")
        listed = ",".join(f"{D.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        counts = Counter(k for _, k, _ in spans)
        want[(i, *[counts[k] for k in range(4)], hashlib.sha256(listed.encode()).hexdigest(), listed)] += 1
    assert Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in got) == want


def corpus():
    """A nickname that only goes with one address, a town that mostly does, words that go with all."""
    rows = [(i, f"word{i} said the usual things about day and night number {'abcdefghij'[i % 10]}", "en", "a") for i in range(400)]
    for i in range(6):
        other = "abcdefghijklmnop"[i]
        rows.append((1000 + i, f"the q{other * 3} zorro of Smallville wrote to jd@host.org about {other * 4} the usual things", "en", "a"))
    rows += [(2000 + i, "people from Smallville talk about the usual things", "en", "a") for i in range(2)]
    rows += [(3000 + i, "a copied text names Unicum beside cp@host.org once", "en", "a") for i in range(20)]
    return rows


def test_terms_that_disclose_are_found_and_common_ones_are_not(spark, documents):
    rows = corpus()
    found, got = report(documents, rows)
    texts = {i: t for i, t, *_ in rows}
    marked = Counter()
    for r in got:
        for span in filter(None, r.spans.split(",")):
            kind, a, b = span.split(":")
            if kind == "term":
                marked[texts[r.doc_id][int(a) : int(b)]] += 1
    assert marked["zorro"] == 6 and marked["Smallville"] == 6
    assert not {"the", "usual", "things", "about"} & set(marked)
    assert "Unicum" not in marked  # copies are one surrounding
    clean = {r.doc_id: r.text for r in D.sanitise(documents(rows), found).collect()}
    assert "jd@host" not in clean[1000] and "zorro" not in clean[1000] and "<email>" in clean[1000]
    # Generalised: the town occurs elsewhere as well.
    assert "Xxx" in clean[1000] and "Smallville" not in clean[1000]
    assert clean[3] == texts[3]


def test_thresholds_by_hand(spark, documents):
    from math import log2

    rows = corpus()
    docs = documents(rows).select("doc_id", "text")
    found = D.find(documents(rows))
    near = D.materialize(D.map_batches(docs, D.FOUND, D._find), "again")
    got = {(r.term, r.only_here) for r in D.disclosing_terms(near, docs).collect()}
    n = len(rows)
    want = set()
    vocabulary = Counter(w for _, t, *_ in rows for w in set(D._TERM.findall(t.lower())))
    for address, support in (("jd@host.org", 6), ("cp@host.org", 1)):
        within = [t for _, t, *_ in rows if address in t]
        pairs = Counter(w for t in within for w in {x for _, _, x, _, _ in D.surroundings(t, D.base_spans(t))})
        for w, df in pairs.items():
            seen = support if address.startswith("jd") and df == 6 else 1
            pmi, ic = log2(n * df / (vocabulary[w] * len(within))), log2(n / len(within))
            if seen >= D.SUPPORT and pmi >= D.DISCLOSURE * ic:
                want.add((w, vocabulary[w] == df))
    assert got == want and found.count() == n


def test_empty_table(documents):
    assert D.report(D.find(documents([]))).count() == 0


@pytest.mark.parametrize("n", [49, 50, 120])
def test_no_piece_of_an_entity_is_a_term_however_many_there_are(n):
    text = ", ".join(f"person{'abcdefghij'[i % 10]} writes from name{'klmnopqrst'[i // 10 % 10]}.surname@host.example" for i in range(n))
    spans = D.base_spans(text)
    terms = {(a, b) for _, _, _, a, b in D.surroundings(text, spans)}
    assert len(spans) == n and terms
    assert not any(a < e and s < b for a, b in terms for s, _, e in spans)


def term_marks(got, texts):
    marked = Counter()
    for r in got:
        for kind, a, b in (x.split(":") for x in filter(None, r.spans.split(","))):
            if kind == "term":
                marked[r.doc_id, texts[r.doc_id][int(a) : int(b)]] += 1
    return marked


def test_terms_count_and_are_marked_in_whole_documents(documents):
    """A nickname far from its address, again later in the document, and once without the address."""
    far = " ".join(["the usual things about day and night"] * 40)
    rows = [(i, f"word{i} said {far}", "en", "a") for i in range(300)]
    rows += [(1000 + i, f"{'abcdefgh'[i] * 4} jd@host.org {far} zorro {far} zorro", "en", "a") for i in range(8)]
    rows += [(2000, f"zorro {far}", "en", "a")]
    texts = {i: t for i, t, *_ in rows}
    _, got = report(documents, rows)
    assert {k: n for k, n in term_marks(got, texts).items() if k[1] == "zorro"} == {(1000 + i, "zorro"): 2 for i in range(8)}
    _, got = report(documents, rows, everywhere=True)
    marked = term_marks(got, texts)
    assert marked[2000, "zorro"] == 1 and all(marked[1000 + i, "zorro"] == 2 for i in range(8))
    assert not {"the", "usual", "night"} & {w for _, w in marked}


def test_an_entity_in_one_document_can_have_disclosing_terms(documents):
    """Once is enough in a large corpus; in a small one it takes several surroundings, of one document too."""
    many = [(i, "people said the usual things about day and night", "en", "a") for i in range(1500)]
    once = (5000, "the usual things about Unicum and jd@host.org", "en", "a")
    often = " ".join(f"zorro {'abcdefgh'[i] * 4} jd@host.org wrote {'klmnopqr'[i] * 4} the usual things about day and night" for i in range(8))
    for rows, want in (
        ([*many, once], {"Unicum": 1}),
        ([*many[:100], once], {}),
        ([*many[:100], (5000, often, "en", "a")], {"zorro": 8, "wrote": 8}),
        ([*many[:100], *[(5000 + i, once[1], "en", "a") for i in range(8)]], {}),
    ):
        texts = {i: t for i, t, *_ in rows}
        _, got = report(documents, rows)
        assert {w: n for (_, w), n in term_marks(got, texts).items()} == want


def test_short_words_and_words_with_digits_are_terms():
    text = "Li (user jd_1985b), 17 Elm, account 4711 0815: jd@host.org"
    terms = [text[a:b] for _, _, _, a, b in D.surroundings(text, D.base_spans(text))]
    assert terms == ["Li", "user", "jd_1985b", "17", "Elm", "account", "4711", "0815"]
