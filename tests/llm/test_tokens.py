import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillmarts.llm import packing as P
from tillmarts.llm import token_output as O
from tillmarts.llm import tokens

FILES = {"byte_bpe_50k.json": False, "word_bpe_49k.json": True}
ALPHABET = st.sampled_from(list(" \n\t\x0b\x1c\x85\xa0aAbé́'’.,-12²½<|endoftext>_漢\U0001f600İΣσ\0\r") + ["<|endoftext|>", "'s", "  ", "\n\n", "\u0958", "\u1161", "\u0301", "</w>", "\u0120"])


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = public_tokenizers.path(request.param)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    return tokens.Encoder(path, FILES[request.param]), plain


@settings(max_examples=400, deadline=None)
@given(st.lists(ALPHABET, max_size=40).map("".join))
def test_parts_encode_like_the_whole(both, text):
    encoder, plain = both
    assert list(np.frombuffer(encoder(text), "<u4")) == plain.encode(text, add_special_tokens=False).ids


def test_words_that_normalising_takes_apart_stay_apart(both):
    encoder, plain = both
    for text in ["b \u0958 c \u0958. d", "\u0958! \u0130 x", "a " * 50 + "\u0958"]:
        assert list(np.frombuffer(encoder(text), "<u4")) == plain.encode(text, add_special_tokens=False).ids


def test_the_memo_stays_bounded_and_right(both, monkeypatch, words):
    encoder, plain = both
    monkeypatch.setattr(tokens, "MEMO_PARTS", 30)
    monkeypatch.setattr(tokens, "MEMO_WORDS", 30)
    for i in range(40):
        text = f"{words[i]} {' '.join(words[i : i + 9])}, {'y' * 100}. {words[i]}!"
        assert list(np.frombuffer(encoder(text), "<u4")) == plain.encode(text, add_special_tokens=False).ids
        assert len(encoder.known) < 100


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 60).flatmap(lambda b: st.integers(0, (1 << b) - 1)) | st.just(0), max_size=700))
def test_words_round_trip(values):
    ids = np.array(values, np.uint64)
    packed = O.pack_words(ids)
    assert (O.unpack_words(packed, len(ids)) == ids).all()


def test_words_are_dense():
    assert len(O.pack_words(np.zeros(480, np.uint64))) == 2
    assert len(O.pack_words(np.full(120, 1, np.uint64))) == 2
    assert len(O.pack_words(np.full(30, (1 << 30) - 1, np.uint64))) == 15
    assert len(O.pack_words(np.full(3, 1 << 30, np.uint64))) == 3  # escapes
    with pytest.raises(ValueError):
        O.pack_words(np.array([1 << 60], np.uint64))


def ids_of(name, text, end):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    plain.encode_special_tokens = True
    return [*plain.encode(text or "", add_special_tokens=False).ids, end]


def test_written_blocks(spark, documents, awkward_rows, tmp_path, monkeypatch):
    path, name = str(tmp_path / "blocks"), "byte_bpe_50k.json"
    O.write_ids(documents(awkward_rows, extra=True), path, public_tokenizers.path(name), end_id=0)
    got = O.read_documents(spark, path).collect()
    want = Counter()
    for i, text, *_ in awkward_rows:
        ids = np.array(ids_of(name, text, 0), "<u4")
        want[(i, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
    keys = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    texts = {r.doc_id: r.ids for r in O.read_ids(spark, path).collect()}
    assert texts[9] == ids_of(name, awkward_rows[11][1], 0)


def test_no_documents(spark, documents, tmp_path):
    path = str(tmp_path / "blocks")
    O.write_ids(documents([]), path, public_tokenizers.path("byte_bpe_50k.json"))
    assert O.read_documents(spark, path).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_first_fit_decreasing(lengths):
    bins, offsets = P.first_fit_decreasing(np.array(lengths, np.int64), 64)
    room = []
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        at = next((b for b, r in enumerate(room) if r >= lengths[piece]), len(room))
        room += [64] * (at == len(room))
        assert (bins[piece], offsets[piece]) == (at, 64 - room[at])
        room[at] -= lengths[piece]


@pytest.mark.parametrize("group_pieces", [8192, 3])
def test_packed_sequences(spark, documents, awkward_rows, words, group_pieces):
    rows = awkward_rows + [(100 + i, " ".join(words[: 5 * i]), "en", "a") for i in range(30)]
    name = "word_bpe_49k.json"
    pieces = P.cut(documents(rows, extra=True), public_tokenizers.path(name), 1, True, with_ids=True)
    placed = P.pack(pieces, group_pieces=group_pieces)
    got = placed.collect()
    want = Counter()
    for i, text, *_ in rows:
        ids = ids_of(name, text, 1)
        for start in range(0, len(ids), 2048):
            body = np.array(ids[start : start + 2048], "<u4")
            want[(i, start, len(body), zlib.crc32(body.tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    filled = Counter()
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048
    whole = {r.sequence_id: (r.length, sum(map(len, r.ids)) // 4) for r in P.sequences(pieces, placed).collect()}
    assert whole == {s: (n, n) for s, n in filled.items()}


def test_nothing_to_pack(documents):
    pieces = P.cut(documents([]), public_tokenizers.path("word_bpe_49k.json"), 1, True)
    assert P.pack(pieces).count() == 0


def test_padding_is_small(spark):
    rng = np.random.default_rng(2)
    rows = [(0, i, i, 0, int(n), 0, int(n)) for i, n in enumerate(rng.integers(1, 2049, 6000))]
    placed = P.pack(spark.createDataFrame(rows, P.PIECE), group_pieces=2000)
    sequences = placed.select("sequence_id").distinct().count()
    assert sum(r[4] for r in rows) / (sequences * 2048) > 0.985
