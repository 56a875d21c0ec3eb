"""Spelling variants: words one edit apart, found by asymmetric q-chunks, each led to its most frequent near word.

One side of the join gives two disjoint chunks of each word, its first and last half. The other side gives positional
grams of the same length. A single inserted, deleted or replaced code point leaves one of two disjoint chunks
whole and moves it by one place at most, so two near words meet in a chunk and a gram with equal letters whose
places differ by at most one. The shorter word gives the chunks and the longer one the grams (equal lengths: both,
and the lesser word's chunks count). Of all positional grams only those within shift one of a chunk's place are made,
as no other could join. What meets is verified by edit distance.

A chunk that very many words share would bring all of them together. Such hot keys are divided again by the same
rule: behind a shared chunk the rest of the two words is one edit apart, so two chunks of the rest meet
the grams of the other rest. Nothing is left out by that.

All of it runs on DataFrame functions. Memory: rows of single words. Spark takes chunks and grams to be as small as the
words they come from, and words as small as their compressed file, a tenth of their size in memory. So joins of tables
that grow with the words say that they are merged, and only hot keys are broadcast. Null texts hold no words, a null id
counts as empty in the slip rule, empty texts and empty tables give no words. Texts of any length are taken whole; a
row that is repeated counts again. Columns other than id and text are ignored, whatever their names. Of near words
with the same count, the first in code-point order is the form. Single letters share the empty chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duesight.llm.scratch import cut

LETTERS = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Meetings of chunks and grams under one key from which the key is divided again.
HOT = 1 << 12
_KEY = ["size", "anchor", "part"]


def runs_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (text) and ``run``: every maximal run of letters, A-Z in lower case."""
    found = F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(LETTERS), F.lit(0))
    return docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("doc_id"), F.explode(found).alias("run"))


def slipped(doc_id: Column, run: Column, every: int) -> Column:
    """The run, or the run without one of its code points if ``every`` divides its hash."""
    h = F.crc32(F.concat(doc_id, F.lit(":"), run).cast("binary"))
    place = (h % F.length(run)).cast("int")
    cut_out = F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.length(run)))
    return F.when(h % every == 0, cut_out).otherwise(run)


def counted(docs: DataFrame, least_points: int = 6, least_count: int = 5, slip_every: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of the words that are long and frequent enough."""
    runs = runs_of(docs, id_col, text_col).filter(F.length("run") >= least_points)
    word = slipped(F.col("doc_id"), F.col("run"), slip_every) if slip_every else F.col("run")
    words = runs.select(word.alias("word")).filter(F.length("word") >= least_points)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count)


def _without(text: Column, start: Column, length: Column) -> Column:
    """The text without ``length`` code points from ``start`` (from 0)."""
    return F.concat(F.substring(text, F.lit(1), start), F.substring(text, start + length + 1, F.length(text)))


def _half(size: Column) -> Column:
    return F.floor(size / 2).cast("int")


def chunks(text: Column) -> Column:
    """Two disjoint chunks: ``size`` of the text, place, letters, and the text without the chunk."""
    size = F.length(text)
    q = _half(size)
    return F.array(*[
        F.struct(size.alias("size"), at.alias("anchor"), F.substring(text, at + 1, q).alias("part"), _without(text, at, q).alias("rest"))
        for at in (F.lit(0), size - q)
    ])


def grams(text: Column) -> Column:
    """The positional grams within shift one of the chunks that a text as long, or one shorter, can have."""
    out = []
    for less in (0, 1):
        size = F.length(text) - less
        q = _half(size)
        for anchor in (F.lit(0), size - q):
            for shift in range(less + 1):
                at = anchor + shift
                out.append(F.struct(size.alias("size"), anchor.alias("anchor"), F.substring(text, at + 1, q).alias("part"), _without(text, at, q).alias("rest")))
    return F.array(*out)


def _again(rows: DataFrame, parts) -> DataFrame:
    """Rows of a hot key under the key and a part of the rest."""
    more = rows.select("word", *_KEY, F.explode(parts(F.col("rest"))).alias("p"))
    return more.select("word", *_KEY, F.col("p.size").alias("size2"), F.col("p.anchor").alias("anchor2"), F.col("p.part").alias("part2"))


def near_pairs(words: DataFrame, hot: int = HOT) -> DataFrame:
    """``a, b``: pairs of words of column ``word`` that differ by one edit, both ways round."""
    words = words.select("word").distinct()
    of_chunks = words.select("word", F.inline(chunks(F.col("word"))))
    of_grams = words.select("word", F.inline(grams(F.col("word"))))
    load = of_chunks.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("x")).join(of_grams.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("y")).hint("merge"), _KEY)
    heavy = cut(load.filter(F.col("x") * F.col("y") > hot).select(*_KEY), "spelling-hot")

    def verified(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
        met = left.withColumnRenamed("word", "a").join(right.withColumnRenamed("word", "b").hint("merge"), key)
        one_way = (F.length("a") < F.length("b")) | (F.col("a") < F.col("b"))
        return met.filter(one_way & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")

    found = verified(of_chunks.join(heavy, _KEY, "left_anti"), of_grams.join(heavy, _KEY, "left_anti"), _KEY)
    if not heavy.isEmpty():
        key = [*_KEY, "size2", "anchor2", "part2"]
        found = found.unionByName(verified(_again(of_chunks.join(heavy, _KEY, "left_semi"), chunks), _again(of_grams.join(heavy, _KEY, "left_semi"), grams), key))
    found = cut(found.distinct(), "spelling-pairs")
    return found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of every word with a form: the last word that forms lead to. Counts grow along forms, so no way
    leads back; each round doubles the steps taken."""
    now = cut(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        later = now.join(ahead.hint("merge"), "root", "left")
        later = cut(later.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        now = later.select("word", "root")
        if later.filter("moved").isEmpty():
            return now


def variants(words: DataFrame, factor: int = 5, hot: int = HOT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``words`` (``word, n``, each word once).

    ``form`` is the near word with the largest count if it has ``factor`` times the word's count, else null.
    """
    words = cut(words.select("word", "n"), "spelling-words")
    near = near_pairs(words, hot).join(words.select(F.col("word").alias("b"), F.col("n").alias("m")).hint("merge"), "b")
    best = F.min(F.struct((-F.col("m")).alias("minus"), F.col("b").alias("form")))
    of_word = near.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    enough = -F.col("best.minus") >= factor * F.col("n")
    rows = cut(
        words.join(of_word.hint("merge"), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.form")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"),
        ),
        "spelling-forms",
    )
    with_root = rows.join(roots(rows.filter("form is not null")).hint("merge"), "word", "left")
    return with_root.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
