"""Each stage against a brute-force version on what the stage before kept."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from duesight.llm import pii
from duesight.llm.queries import tokenizer
from duesight.llm.scratch import cut
from tests.llm import test_exact_dedup, test_packing, test_pii, test_simhash
from tests.llm.conftest import DOCS, SMALL, texts_of


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage returns, written and read again."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    extra = [(-1, None, None, None, None), (-2, "", "en", "s", 0), (-3, "12 34", "en", "s", 5), (-4, "write to x@y.org today, or call +1 (918) 555-2370 please", "en", "s", 55), (-4, "write to x@y.org today, or call +1 (918) 555-2370 please", "en", "s", 55)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def ids(docs):
    return sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_columns(kept):
    for docs in kept[1:-1]:
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language(kept):
    assert ids(kept[1]) == sorted(i for i, t in texts_of(kept[0]) if re.search(r"[^\W\d_]", t or ""))


def test_exact(kept):
    assert ids(kept[2]) == sorted({i for i, _, _, stays, _ in test_exact_dedup.brute(texts_of(kept[1])) if stays})


def test_near(kept):
    assert ids(kept[3]) == sorted(i for i, _, c in test_simhash.brute(texts_of(kept[2])) if i == c)


def test_private(kept):
    before, after = dict(texts_of(kept[3])), {r.doc_id: r for r in kept[4].collect()}
    assert set(before) == set(after)
    spans = {r.doc_id: r.spans for r in pii.find(kept[3]).select("doc_id", "spans").collect()}
    for i, text in before.items():
        chosen = [(s.start, s.k, s.kind, s.end) for s in spans[i]]
        assert set(test_pii.base_spans(text)) <= {(a, k - 1, kind, b) for a, k, kind, b in chosen}
        assert after[i].text == test_pii.masked(text, chosen)
        assert text == after[i].text or after[i].n_chars == len(after[i].text)
    assert "<email>" in after[-4].text and "<phone>" in after[-4].text


def test_packed(kept):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    ids_of = {i: [*whole.encode(t, add_special_tokens=False).ids, 1] for i, t in texts_of(kept[4])}
    test_packing.check(kept[5].collect(), ids_of, 2048)


def test_ids_that_repeat(spark):
    """Rows without id, or with the same id, are documents of their own unless their texts are equal."""
    one, two, three, four = (" ".join(w * n for n in range(1, 9)) for w in "abcd")
    rows = [(None, one), (None, two), (None, two), (None, three), (7, four), (7, three + "  "), (7, three), (9, four), (8, two.title()), (None, one.title())]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    exact = corpus_pipeline.exact(spark, docs, SMALL)
    assert sorted(texts_of(exact), key=str) == sorted([(None, one), (None, two), (7, four), (7, three + "  "), (8, two.title()), (None, one.title())], key=str)
    near = texts_of(corpus_pipeline.near(spark, exact, SMALL))
    assert len(near) == 4 and {(i, t.lower()) for i, t in near} == {(None, one), (8, two), (7, three + "  "), (7, four)}


def test_columns_of_any_name_are_handed_on(spark, awkward, empty):
    """Very long, empty and null texts, repeated rows, and columns with the names that stages use."""
    names = ["_key", "_key_", "_was", "_kept_id", "_kept_key", "_id", "_hash", "_spans", "key", "one"]
    docs = awkward.selectExpr("*", *[f"'x' AS `{name}`" for name in names])
    more = docs.columns[5:]
    nothing = empty.selectExpr("*", *[f"'x' AS `{name}`" for name in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = cut(stage(spark, docs, SMALL), name)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        assert out.filter(" or ".join(f"`{c}` is null or `{c}` != 'x'" for c in more)).count() == 0
        none = stage(spark, nothing, SMALL)
        assert none.columns == docs.columns and none.count() == 0
        docs = out
    assert {r.doc_id for r in docs.collect()} == {4, 5, 7, 10, None}
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, SMALL).count() > 5 and last(spark, nothing, SMALL).count() == 0


def test_run(spark, kept):
    pieces = corpus_pipeline.run(spark, SMALL)
    assert pieces.agg(F.sum("length")).first()[0] > 0
    assert pieces.columns == kept[5].columns
