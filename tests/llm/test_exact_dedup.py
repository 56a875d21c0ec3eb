from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from duesight.llm import exact_dedup as X
from duesight.llm.scratch import new_path
from tests.llm.conftest import texts_of


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[ \t-\r]", "", text or "")].append((doc_id, len(text or "")))
    out = []
    for body, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))[0]
        sha = hashlib.sha256(body.encode()).hexdigest()
        out += [(i, keep, len(members), i == keep, sha) for i, _ in members]
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_equals_brute_force(spark, documents, digest_bytes):
    """With digests of one byte most hits are false, and the comparison of texts has to part them."""
    assert rows_of(X.exact_dedup(documents, digest_bytes=digest_bytes)) == brute(texts_of(documents))


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_awkward_rows(awkward, digest_bytes):
    assert rows_of(X.exact_dedup(awkward, digest_bytes=digest_bytes)) == brute(texts_of(awkward))


@pytest.mark.parametrize("digest_bytes", [32, 1])
def test_ids_on_several_texts(spark, digest_bytes):
    """Each row meets its own text only, also if its id is null or stands on other texts."""
    rows = [(7, "text x"), (7, "text y"), (9, "text x"), (None, "text y"), (None, "text z"), (None, "text  z"), (7, "text  x"), (None, None)]
    rows += [(None, f"text {k}") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(X.exact_dedup(docs, digest_bytes=digest_bytes)) == brute(rows)


def test_empty_table(empty):
    assert X.exact_dedup(empty).collect() == []


def test_state_goes_on_with_later_files(spark, documents):
    """A second run of the stream takes only new files, and knows the keys of the first."""
    source, state = new_path(spark, "t"), new_path(spark, "s")
    first, second = documents.filter("doc_id % 2 = 0"), documents.filter("doc_id % 2 = 1")
    X.digest_rows(first).write.parquet(source)
    X.run_stream(spark, source, state)
    X.digest_rows(second).write.mode("append").parquet(source)
    X.run_stream(spark, source, state)
    got = {r.keep_id: r.group_size for r in X.read_state(spark, state).collect()}
    assert got == {keep: n for _, keep, n, kept, _ in brute(texts_of(documents)) if kept}


def test_no_python_in_the_plan(awkward):
    plan = X.exact_dedup(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
