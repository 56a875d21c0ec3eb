from __future__ import annotations

import zlib

import numpy as np

from duesight.llm import language_id as L
from tests.llm.conftest import SMALL, texts_of


def test_held_out_accuracy(spark, documents):
    held = L.held_out(documents.doc_id)
    model = L.fit(documents.filter(~held))
    rows = L.identify_with(documents.withColumn("held", held), model).collect()
    assert {r.doc_id for r in rows if r.held} == {r.doc_id for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    judged = [r for r in rows if r.held and r.lang and r.lang_pred != "und"]
    assert len(judged) > 20
    assert np.mean([r.lang == r.lang_pred for r in judged]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_equals_a_plain_version(spark, documents):
    """Word by word, without the memory of tokens."""
    model = L.fit(documents.filter(~L.held_out(documents.doc_id)))
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(documents, model).collect()}
    for doc_id, text in texts_of(documents)[:60]:
        total = sum((model.score_word(w) for t in text.split() for w in L.words_of(t)), np.zeros(len(model.languages)))
        best = int(np.argmax(total))
        assert got[doc_id][0] == model.languages[best]
        assert abs(got[doc_id][1] - 1 / np.exp(total - total[best]).sum()) < 1e-9


def test_unseen_words_back_off(spark):
    rows = [(i, "der hund und die katze schlafen", "de", "", 0) for i in range(8)] + [(100 + i, "the dog and the cat sleep", "en", "", 0) for i in range(8)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n long"))
    assert "schlafend" not in model.words
    scores = model.score_word("schlafend")
    assert model.languages[int(np.argmax(scores))] == "de"
    assert np.all(model.score_word("ωψ") < 0)


def test_awkward_rows(spark, awkward, empty):
    model = L.fit(awkward)
    got = {r.doc_id: r.lang_pred for r in L.identify(awkward, model).collect()}
    assert [got[i] for i in (1, 2, 3, 9)] == ["und"] * 4
    assert got[4] == "en"
    kept = L.identify_with(awkward, model)
    assert kept.columns == [c for c in awkward.columns if c != "_found"] and kept.count() == awkward.count()
    assert L.identify(empty, L.fit(empty)).count() == 0
    assert {r.lang_pred for r in L.identify(awkward, L.fit(empty)).collect()} == {"und"}


def test_cache_may_overflow(spark, documents, monkeypatch):
    model = L.fit(documents.filter(~L.held_out(documents.doc_id)))
    texts = [t for _, t in texts_of(documents)[:20]]
    large = [L.Predictor(model).predict(t) for t in texts]
    monkeypatch.setattr(L, "CACHE", 16)
    one = L.Predictor(model)
    for text, (lang, score) in zip(texts, large, strict=True):
        again = one.predict(text)
        assert again[0] == lang and abs(again[1] - score) < 1e-6


def test_many_and_rare_languages(spark):
    """300 languages with a few words each, one with a single document: each finds its own."""
    rows = [(i, " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{w}{'xyz'[k]}" for w in ("bo", "ca", "du") for k in range(3)), f"l{i:03d}") for i in range(300)]
    rows += [(1000 + k, "ein haufen von texten in einer sprache " * 3, "zz") for k in range(500)]
    docs = spark.createDataFrame([(str(i), t, lang, n) for i, t, lang in rows for n in range(1 if i % 2 else 2)], "doc_id string, text string, lang string, n int")
    model = L.fit(docs, L.FitBounds(docs_per_language=50))
    assert len(model.languages) == 301
    assert {w for _, t, lang in rows if lang != "zz" for w in t.split()} <= set(model.words)
    one = L.Predictor(model)
    assert one.room < L.CACHE
    for _, text, lang in rows[:301]:
        assert one.predict(text)[0] == lang
        assert np.allclose(one.scores[one.seen[text.split()[0]]], model.score_word(text.split()[0]))


def test_every_labelled_row_is_counted(spark):
    """4,000 rows of one language, each with a word of its own: the model knows and counts them all."""
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    docs = spark.createDataFrame([(i, f"shared {word(i)}", "en") for i in range(4000)] + [(9000, "anders", "de")], "doc_id long, text string, lang string")
    model = L.fit(docs)
    assert set(model.words) == {word(i) for i in range(4000)} | {"shared", "anders"}
    row = model.words["shared"]
    assert model.n[model.start[row] : model.start[row + 1]].tolist() == [4000]
    row = model.grams["<sha"]
    assert model.n[model.start[row] : model.start[row + 1]].tolist()[0] >= 4000
    assert model.words.find(["anders", "nowhere", "shared"]).tolist() == [model.words["anders"], -1, model.words["shared"]]


def test_words_of_equal_hash(monkeypatch):
    """Four known words and an unknown one share the first half of their hashes."""
    monkeypatch.setattr(L.xxhash, "xxh3_128_digest", lambda word: bytes(7) + bytes([len(word) > 3]) + word.encode().ljust(8))
    words = L.Words(L.pa.array(["bb", "aaa", "cc", "dd"]))
    found = words.find(["cc", "dd", "ee", "aaa", "bb", "zzzz"]).tolist()
    assert found[2] == found[5] == -1 and [words.texts[i].as_py() for i in (found[0], found[1], found[3], found[4])] == ["cc", "dd", "aaa", "bb"]


def test_the_query(spark):
    from duesight.llm.queries import QUERIES

    rows = QUERIES["op9_language_id"](spark, SMALL).collect()
    assert len(rows) == 200 and set(rows[0].asDict()) >= {"doc_id", "held_out", "lang_pred", "score"}
