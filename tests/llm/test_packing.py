from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from duesight.llm import packing as P
from duesight.llm.queries import tokenizer
from tests.llm.conftest import texts_of

PATH = tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def check(pieces, ids_of, window):
    """Every id lies in exactly one piece and every window is gapless; returns the padding."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_window[p.sequence_id].append(p)
    for doc, own in by_doc.items():
        ids = ids_of[doc]
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        assert sum(p.length for p in own) == len(ids) == own[0].doc_tokens
        for p in own:
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    for own in by_window.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        assert 0 < sum(p.length for p in own) <= window
    assert set(by_doc) == set(ids_of)
    return sum(window - sum(p.length for p in own) for own in by_window.values())


@pytest.mark.parametrize("window", [2048, 100])
def test_pieces(documents, whole, window):
    ids_of = {i: [*whole.encode(t, add_special_tokens=False).ids, 1] for i, t in texts_of(documents)}
    got = P.pack(documents, lambda: P.WordEncoder(PATH), window).collect()
    padding = check(got, ids_of, window)
    assert padding < window * documents.rdd.getNumPartitions()


def test_awkward_rows(awkward, empty, whole):
    docs = awkward.dropDuplicates(["doc_id"])
    ids_of = {i: [*whole.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts_of(docs)}
    check(P.pack(docs, lambda: P.WordEncoder(PATH)).collect(), ids_of, 2048)
    assert P.pack(awkward, lambda: P.WordEncoder(PATH)).count() >= awkward.count()
    assert P.pack(empty, lambda: P.WordEncoder(PATH)).collect() == []


TEXTS = st.lists(st.sampled_from(["Σας", "it's", "á", "́", " ", "\n", "\x1c", " ", "<|endoftext|>", "İx", "ß", "12", "!?", "ΑΣ", "e", "가", "'s", "\t", "　", "\x85"]) | st.text(max_size=4), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_words_one_by_one_give_the_same_ids(text):
    assert np.frombuffer(ENCODER(text), "<u4").tolist() == ENCODER.tokenizer.encode(text, add_special_tokens=False).ids


def plain_level(counts, size, window):
    best = None
    for level in range(window - size, -1, -1):
        if level and not counts[level]:
            continue
        after = counts.copy()
        if level:
            after[level] -= 1
        if level + size < window:
            after[level + size] += 1
        cost = int((after[1:window] ** 2).sum())
        if best is None or cost < best[0]:
            best = (cost, level)
    return best[1]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=120))
def test_the_level_has_the_smallest_sum_of_squares(sizes):
    packer = P.Packer(40)
    for i, size in enumerate(sizes):
        if size < 40:
            assert packer.level_for(size) == plain_level(packer.counts, size, 40)
        packer.add(i, b"\1\0\0\0" * size)
    packer.close()
    rows = packer.rows(0)
    assert rows.length.sum() == sum(sizes)
    fills = rows.groupby("sequence_id").length.sum()
    assert (fills < 40).sum() <= 1


LETTERS = st.text(st.characters(min_codepoint=32, max_codepoint=600), max_size=12)


@settings(max_examples=1500, deadline=None)
@given(st.lists(LETTERS, max_size=3).map(" ".join), st.sampled_from(["", ",", ".", ",.", "'s", "...", "###", "_", "<|", "$$$"]))
def test_latin_words(text, mark):
    assert np.frombuffer(ENCODER(text + mark), "<u4").tolist() == ENCODER.tokenizer.encode(text + mark, add_special_tokens=False).ids


ENCODER = P.WordEncoder(PATH)
