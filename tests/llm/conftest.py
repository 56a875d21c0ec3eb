"""Tables with awkward rows, and the given tables at their smallest."""

from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"
LONG = "Lorem ipsum dolor sit amet, 12 34 a.b@c.de " * 3000
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and very long texts, ties, repeated rows, columns with names the operators use."""
    rows = [
        (1, None, "en", None, None), (2, "", None, "s", 0), (3, " \t\n", "en", "s", 3), (4, LONG, "en", "s", 1),
        (5, LONG + " end", None, None, 1), (6, "same text here", "en", "s", 1), (7, "same text  here", "en", "s", 1),
        (7, "same text  here", "en", "s", 1), (None, "no id", "de", "s", 1), (9, "12 !! 34", None, "s", 1),
        (10, "Größe ﬁn 😀 ▁ x\x00y", "de", "s", 1), (11, "sametexthere", "en", "s", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    for name in ("score", "lang_pred", "digest", "row", "fp", "kind", "start", "spans", "_found"):
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    return docs


@pytest.fixture(scope="session")
def empty(awkward):
    return awkward.filter("false")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
