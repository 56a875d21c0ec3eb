"""One key with a third of all rows: its rows are spread, and nothing grows with the square of the group."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from duesight.llm import exact_dedup, recompression, simhash, suffix_dedup

N = 3000


@contextlib.contextmanager
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def hot_copies(spark):
    """A third are copies of one text, a third near copies that differ in one word, a third are alone."""
    words = " ".join(f"w{i}" for i in range(120))
    text = F.when(F.col("id") % 3 == 0, words).when(F.col("id") % 3 == 1, F.concat(F.lit(words + " x"), "id")).otherwise(
        F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(60)), lambda i: F.concat(F.lit("u"), F.col("id") * 100 + i)))
    )
    return spark.range(N).select(F.col("id").alias("doc_id"), text.alias("text"))


def test_hot_groups(spark):
    docs = hot_copies(spark)
    with no_broadcast(spark):
        exact = exact_dedup.exact_dedup(docs)
        assert exact.filter("kept").count() == 1 + 2 * N // 3
        assert exact.filter("doc_id % 3 = 0").agg(F.min("group_size"), F.max("keep_id")).first()[:] == (N // 3, 0)
        near = simhash.near_duplicates(docs, shard=50)
        assert near.filter("doc_id % 3 = 0 and component_id != 0").count() == 0
        bytes_ = suffix_dedup.remove_repeats(docs, bucket=200)
        assert bytes_.filter("doc_id % 3 = 0 and doc_id > 0 and n_removed != n_bytes").count() == 0
        assert bytes_.filter("doc_id % 3 = 2 and n_removed > 0").count() == 0
        words = recompression.remove_repeats(docs)
        assert words.filter("doc_id % 3 = 1 and n_removed != 120").count() == 0
        assert words.filter("doc_id % 3 = 2 and n_removed > 0 or doc_id = 0 and n_removed > 0").count() == 0


def test_spanning_links_only(spark):
    """A ball of close fingerprints gives fewer links than nodes for each shard, not one for each pair."""
    n = 1 << 10
    links = simhash.near_links(spark.range(n).select(F.col("id").alias("fp")), 3)
    assert links.count() < 4 * n  # a shard for each of the four blocks
