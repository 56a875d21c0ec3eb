from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duesight.llm import piece_encoding as E
from duesight.llm.queries import QUERIES, tokenizer
from tests.llm.conftest import SMALL, texts_of

PATH = tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return E.PieceEncoder(PATH)


def same(own, library, text):
    ids = own.encode(text)
    want = [*library.encode(text), 2]
    assert ids == want, text
    assert own.decode(ids) == library.decode(want), text


def test_given_texts(own, library, documents):
    for _, text in texts_of(documents):
        same(own, library, text)


def test_mixtures_of_pieces(own, library):
    draw = random.Random(8)
    parts = [*" \n\t▁aé😀ﬁ\x00", "  ", "<0x0A>", "</s>", "ﷺ", "한국", "----", "　", "�"] + draw.sample(own.pieces[3:], 500)
    for _ in range(4000):
        same(own, library, "".join(draw.choice(parts) for _ in range(draw.randint(0, 9))))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=30))
def test_any_text(own, library, text):
    same(own, library, text)


def test_long_texts_without_blanks(own, library):
    draw = random.Random(9)
    for text in ("a" * 50_000, "ab" * 30_000, "".join(draw.choice("etaoin") for _ in range(60_000)), "=" * 3001 + "é" * 999, " " * 4097 + "x"):
        same(own, library, text)


def test_replayed_merges_agree_with_merging(own):
    draw = random.Random(10)
    made = [i for _, i in own.tree.values()]
    for _ in range(20_000):
        a, b = draw.choice(made), draw.choice(made)
        joined = own.pieces[a] + own.pieces[b]
        assert own._goes(a, b) == ([own.pieces[a], own.pieces[b]] == own.merge(joined))


def test_memory_of_any_size(own, library, documents, monkeypatch):
    monkeypatch.setattr(E, "CACHE", 5)
    for _, text in texts_of(documents)[:20]:
        same(own, library, text)


def test_rows(spark, library, awkward, empty):
    got = E.encode(awkward, lambda: E.PieceEncoder(PATH)).collect()
    want = []
    for doc_id, text in texts_of(awkward):
        ids = [*library.encode(text or ""), 2]
        want.append((doc_id, len(ids), " ".join(map(str, ids)), library.decode(ids)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert E.encode(empty, lambda: E.PieceEncoder(PATH)).collect() == []


def test_the_query(spark, library, documents):
    got = {r.doc_id: r for r in QUERIES["op10_piece_encoding"](spark, SMALL).collect()}
    for doc_id, text in texts_of(documents):
        ids = [*library.encode(text), 2]
        assert got[doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc_id].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
