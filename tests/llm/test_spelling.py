from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from duesight.llm import spelling as S
from tests.llm.conftest import texts_of


def edits(word, letters):
    """Every text one edit away that uses ``letters``."""
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1 :] for i in range(len(word)) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return out - {word}


def brute(counts, factor=5):
    letters = sorted({c for w in counts for c in w})
    near = {w: sorted(edits(w, letters) & counts.keys()) for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def count_plainly(texts, points, least, every):
    counts = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= points and n >= least}


@pytest.mark.parametrize("every", [None, 7])
def test_given_documents(spark, documents, every):
    counts = count_plainly(texts_of(documents), 6, 5, every)
    words = S.counted(documents, 6, 5, every)
    assert dict((r.word, r.n) for r in words.collect()) == counts
    assert rows_of(S.variants(words)) == brute(counts)


def test_awkward_rows(awkward):
    counts = count_plainly(texts_of(awkward), 2, 1, 3)
    words = S.counted(awkward, 2, 1, 3)
    assert dict((r.word, r.n) for r in words.collect()) == counts
    assert rows_of(S.variants(words)) == brute(counts)


def test_empty_table(empty):
    assert rows_of(S.variants(S.counted(empty))) == []


@pytest.mark.parametrize("hot", [S.HOT, 0])
def test_random_words(spark, hot):
    """Few letters, so that words have many near words and ties; ``hot=0`` divides every key again."""
    draw = random.Random(3)
    counts = {"".join(draw.choices("abß", k=draw.randint(2, 7))): draw.choice([1, 2, 10, 10, 50, 300]) for _ in range(500)}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(S.variants(words, hot=hot)) == brute(counts)


def test_edits_at_every_place(spark):
    """An edit at any place of an even or odd word is met."""
    for word in ("abcdefgh", "abcdefghi", "ab"):
        others = sorted(edits(word, "aüz"))
        pairs = S.near_pairs(spark.createDataFrame([(w,) for w in [word, *others]], "word string"))
        assert {r.b for r in pairs.filter(F.col("a") == word).collect()} == set(others)


def test_long_ways_lead_to_one_root(spark):
    ways = [("a" * k, 5**k) for k in range(2, 18)]
    found = S.variants(spark.createDataFrame(ways, "word string, n long"))
    assert {r.root for r in found.collect()} == {"a" * 17}


def test_a_hot_chunk_makes_no_square(spark):
    """Words that share a half and differ in the other by more than one edit hardly meet once their key is divided."""
    words = spark.range(4000).select(F.concat(F.lit("abcdefgh"), F.translate(F.lpad(F.col("id") * 9973 % 100_000_000, 8, "0"), "0123456789", "klmnopqrst")).alias("word"))
    grams = words.select("word", F.inline(S.grams(F.col("word"))))
    chunks = words.select("word", F.inline(S.chunks(F.col("word"))))
    again = S._again(chunks, S.chunks).withColumnRenamed("word", "a").join(S._again(grams, S.grams).withColumnRenamed("word", "b"), [*S._KEY, "size2", "anchor2", "part2"])
    assert again.count() < 4000 * 4000 / 20
    near = defaultdict(set)
    for r in S.near_pairs(words, hot=100).collect():
        near[r.a].add(r.b)
    alphabet, known = "abcdefghklmnopqrst", {r.word for r in words.collect()}
    for word in sorted(known)[::97]:
        assert near[word] == edits(word, alphabet) & known


def test_only_hot_keys_are_broadcast(spark, monkeypatch):
    """Whatever Spark takes the sizes of chunks, grams and words for: it knows neither their number nor what they take in memory."""
    plans, kept = [], S.cut
    monkeypatch.setattr(S, "cut", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df, name))
    words = spark.createDataFrame([(f"word{i:03d}{c}", i + 1) for i in range(300) for c in "ab"], "word string, n long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        found = S.variants(words, hot=2)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for plan in plans for line in plan.splitlines() if "Join " in line]
    assert any("SortMergeJoin" in line for line in joins)
    assert [line for line in joins if "Broadcast" in line and "LeftAnti" not in line and "LeftSemi" not in line] == []
