"""The corpus pipeline: language ID, exact dedup, near dedup, PII, packing, each written as Parquet in between.

Every stage takes the documents that the one before kept and returns documents; the last returns packed pieces.
Tokenizing, fingerprints, trained trees and state stores have no SQL, so the pipeline is held against a
brute-force version in its tests.

Null and empty texts have no language and go in the first stage, as do texts without a letter; later stages take them as
empty. Texts of any length are read whole. Rows without id, or with the same id, are documents of their own unless
their texts are equal; of rows that repeat an id and a text one stays, the one with the longest text, then the greatest columns.
Ties go to the smallest id. Columns that stages don't know are handed on as they are, whatever their names, but for the last
stage, whose pieces have columns of their own. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duesight.llm import exact_dedup, language_id, packing, pii, queries, simhash
from duesight.llm.scratch import cut, free


def _only(docs: DataFrame, key: str, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` for each ``_kept_id, _kept_key`` in ``kept``: the longest text. An id, null too, may stand on many
    texts; the column ``key`` says which of them is meant, and is dropped.

    Ids and keys that repeat are found in narrow rows; only their documents are compared, all others pass as they are.
    """
    same = docs["doc_id"].eqNullSafe(kept["_kept_id"]) & (docs[key] == kept["_kept_key"])
    found = docs.join(kept, same, "left_semi")
    counts = docs.groupBy("doc_id", key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = cut(counts.select(F.col("doc_id").alias("_kept_id"), F.col(key).alias("_kept_key")), "repeated-rows")
    if again.isEmpty():
        return found.drop(key)
    repeats = found["doc_id"].eqNullSafe(again["_kept_id"]) & (found[key] == again["_kept_key"])
    once = found.join(again, repeats, "left_anti").drop(key)
    row = F.struct(F.length("text").alias("n"), F.struct(*[c for c in docs.columns if c != key]).alias("row"))
    one = found.join(again, repeats, "left_semi").groupBy("doc_id", key).agg(F.max(row).alias("one"))
    return once.unionByName(one.select("one.row.*"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found; those without letters go."""
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    found = language_id.prediction(spark, model, F.col("text"))
    return docs.filter(found["lang_pred"] != language_id.UNKNOWN)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts."""
    key = free(docs, "_key")
    keyed = docs.withColumn(key, F.sha2(exact_dedup.normalised(F.col("text")).cast("binary"), 256))
    kept = exact_dedup.exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_key"))
    return _only(keyed, key, kept.distinct())


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; one without id if none has one."""
    key = free(docs, "_key")
    keyed = docs.withColumn(key, F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256))
    kept = simhash.representatives(keyed.select("doc_id", "text", F.col(key).alias("key")), "key")
    return _only(keyed, key, kept.select(F.col("doc_id").alias("_kept_id"), F.col("key").alias("_kept_key")))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked and ``n_chars`` counted anew where the text has changed."""
    was = free(docs, "_was")
    out = pii.redact(docs.withColumn(was, F.length("text")), pii.find(docs.select("doc_id", "text")))
    return out.withColumn("n_chars", F.when(F.length("text") == F.col(was), F.col("n_chars")).otherwise(F.length("text").cast("long"))).drop(was)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token windows."""
    path = queries.tokenizer("word_bpe_49k.json")
    return packing.pack(docs, lambda: packing.WordEncoder(path))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("private", private),
    ("packed", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
