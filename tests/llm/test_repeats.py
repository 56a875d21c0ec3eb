"""Removal of repeated byte strings and word passages against plain versions."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from duesight.llm import recompression as W
from duesight.llm import repeats as R
from duesight.llm import suffix_dedup as S
from tests.llm.conftest import texts_of


def key(row):
    return (row[0] is not None, row[0] or 0)


def plain_bytes(rows, size):
    seen, out = {}, []
    for doc_id, text in sorted(rows, key=key):
        body = (text or "").encode()
        gone = bytearray(len(body))
        for p in range(len(body) - size + 1):
            if seen.setdefault(body[p : p + size], (doc_id, p)) != (doc_id, p):
                gone[p : p + size] = b"\1" * size
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(body), len(body) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def plain_words(rows, size):
    seen, out = {}, []
    for doc_id, text in sorted(rows, key=key):
        words = (text or "").encode().split()
        gone = bytearray(len(words))
        for p in range(len(words) - size + 1):
            if seen.setdefault(tuple(words[p : p + size]), doc_id) != doc_id:
                gone[p : p + size] = b"\1" * size
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def crafted(spark):
    """Shared passages in different surroundings, edits, copies, runs and periods; many with little vocabulary."""
    draw = random.Random(11)
    vocabulary = ["a", "b", "c", "the", "of", "ü", "x1"]
    passage = [" ".join(draw.choice(vocabulary) for _ in range(n)) for n in (49, 50, 51, 60, 130)]
    rare = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(n)) for n in (30, 50, 75, 200)]
    texts = ["a " * 400, "a " * 150, "a b " * 200, "a b c " * 70 + "x", "the " * 49, "z" * 99, "z" * 100, "z" * 101, "z" * 300, ""]
    for _ in range(160):
        parts = []
        for _ in range(draw.randint(1, 5)):
            parts.append(draw.choice([draw.choice(passage), draw.choice(rare), " ".join(f"v{draw.randrange(10**6)}" for _ in range(draw.randint(0, 40))), "the " * draw.randint(1, 90)]))
        text = " ".join(parts)
        if draw.random() < 0.3 and texts:
            words = draw.choice(texts).split(" ")
            words[draw.randrange(len(words))] = f"edit{draw.randrange(99)}"
            text = " ".join(words)
        texts.append(text)
    draw.shuffle(texts)
    return spark.createDataFrame([(i * 3, t) for i, t in enumerate(texts)], "doc_id long, text string")


@pytest.fixture(scope="module")
def crafted_docs(spark):
    return crafted(spark)


@pytest.mark.parametrize(("bucket", "batch"), [(50_000, 10_000), (7, 13)])
def test_bytes_of_crafted_texts(spark, crafted_docs, monkeypatch, bucket, batch):
    """Also with buckets so small that equal strings lie in several of them."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    monkeypatch.setattr(S, "CHUNK", 5 if batch < 100 else S.CHUNK)
    try:
        assert got(S.remove_repeats(crafted_docs, bucket=bucket)) == plain_bytes(texts_of(crafted_docs), 100)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize(("frequent", "chunk"), [(50, 1 << 20), (1, 300)])
def test_words_of_crafted_texts(crafted_docs, monkeypatch, frequent, chunk):
    monkeypatch.setattr(R, "FREQUENT", frequent)
    monkeypatch.setattr(R, "SAMPLE", 64 if frequent > 1 else 1)
    monkeypatch.setattr(R, "CHUNK", chunk)
    assert got(W.remove_repeats(crafted_docs)) == plain_words(texts_of(crafted_docs), 50)


def test_small_chunks_and_frequent_keys_of_bytes(crafted_docs, monkeypatch):
    monkeypatch.setattr(R, "FREQUENT", 1)
    monkeypatch.setattr(R, "SAMPLE", 1)
    monkeypatch.setattr(R, "CHUNK", 500)
    assert got(S.remove_repeats(crafted_docs)) == plain_bytes(texts_of(crafted_docs), 100)


def test_given_documents(documents):
    docs = documents.limit(120)
    assert got(S.remove_repeats(docs)) == plain_bytes(texts_of(docs), 100)
    assert got(W.remove_repeats(docs)) == plain_words(texts_of(docs), 50)


def test_awkward_rows(awkward, empty):
    docs = awkward.dropDuplicates(["doc_id"])
    assert got(S.remove_repeats(docs)) == plain_bytes(texts_of(docs), 100)
    assert got(W.remove_repeats(docs)) == plain_words(texts_of(docs), 50)
    again = got(W.remove_repeats(docs.union(docs)))
    assert again == sorted(got(W.remove_repeats(docs)) * 2, key=str)
    assert got(S.remove_repeats(docs.union(docs))) == sorted(got(S.remove_repeats(docs)) * 2, key=str)
    assert S.remove_repeats(empty).collect() == [] and W.remove_repeats(empty).collect() == []


def test_multikey_quicksort():
    draw = np.random.default_rng(3)
    for n in (0, 1, 5, 41, 3000):
        words = draw.integers(0, 4, (n, 5)).astype(np.uint64) << np.uint64(60)
        words[:, 4] |= draw.integers(0, 3, n).astype(np.uint64)
        order = S.multikey_quicksort(words)
        assert sorted(order.tolist()) == list(range(n))
        assert words[order].tolist() == sorted(words.tolist())


def test_symbols_agree_inside_equal_passages():
    """The reach of the rounds: symbols that start far enough from the ends of a common stretch are the same."""
    draw = random.Random(6)
    before, after, most = W.reach(W.ROUNDS)
    assert before + after + most <= W.WINDOW + 1
    for _ in range(400):
        letters = draw.choice([2, 3, 50])
        text = lambda n: [draw.randrange(letters) for _ in range(n)]
        common = text(draw.randint(50, 90)) if draw.random() < 0.7 else [1, 1, 2] * 25
        found = []
        for _ in range(2):
            left, right = text(draw.randint(0, 60)), text(draw.randint(0, 60))
            words = R.mixed_up(np.array(left + common + right, np.uint64) + np.uint64(5))
            names, starts = W.high_symbols(words, np.array([len(words)]), W.ROUNDS)
            starts = starts - len(left)
            inside = (starts >= before) & (starts + after <= len(common))
            found.append((names[inside].tolist(), starts[inside].tolist()))
        assert found[0] == found[1]
