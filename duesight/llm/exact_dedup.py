"""Exact deduplication: a stateful stream whose keyed state never expires and lies on disk.

The state (RocksDB) retains, for each digest of a normalised text, the stable identifier of the copy that stays,
its length, its content locator (source file) and the number of copies. Digests alone decide nothing: the full
bytes of all texts that hit the same key are compared, and a key with different texts is split by text.

Only DataFrame operations run. Null texts count as empty, and all empty texts are copies of one another. Of equal
texts the longest original stays, then the smallest id; a null id stays only if no other can. Rows that repeat an
id with an equal text share its verdict.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duesight.llm.scratch import cut, new_path

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": _ROCKSDB,
    # All stores of an executor share one bounded piece of memory.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "96",
    # A store is closed when its part of the batch is done: many parts don't keep many stores open.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    # A store takes the disk it fills, not whole preallocated files.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.minBatchesToRetain": "2",
    "spark.sql.streaming.metricsEnabled": "false",
}
DIGEST_ROW = "doc_id long, digest binary, sha binary, n_points long, locator string"


def normalised(text: Column) -> Column:
    """The text without blanks, tabs and line ends."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32) -> DataFrame:
    """One narrow row for each document. ``docs`` may be a stream."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256)).alias("sha"),
        F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_points"),
        F.input_file_name().alias("locator"),
    ).select("doc_id", F.substring("sha", 1, digest_bytes).alias("digest"), "sha", "n_points", "locator")


def keyed_state(rows: DataFrame) -> DataFrame:
    """What the stream keeps of each digest. No watermark: a key never expires."""
    order = F.struct("n_points", (-F.col("doc_id")).alias("minus_id"), "locator")
    return rows.groupBy("digest").agg(F.max(order).alias("best"), F.count(F.lit(1)).alias("copies"))


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def run_stream(spark: SparkSession, source: str, state: str, bytes_per_batch: int = 64 << 30) -> None:
    """Take the digest rows that lie in ``source`` and are not in ``state`` yet. A later call goes on from there."""
    with _set(spark, _SETTINGS):
        stream = spark.readStream.schema(DIGEST_ROW).option("maxBytesPerTrigger", str(bytes_per_batch)).parquet(source)
        query = (
            keyed_state(stream).writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", state).trigger(availableNow=True).start()
        )
        query.awaitTermination()


def read_state(spark: SparkSession, state: str) -> DataFrame:
    """``digest, keep_id, locator, group_size`` of every key, read from the stream's state store."""
    with _set(spark, _SETTINGS):
        table = spark.read.format("statestore").load(state)
        fields = table.schema["value"].dataType.names
        best, copies = (F.col(f"value.`{name}`") for name in fields)
        rows = table.select(F.col("key.digest").alias("digest"), best.alias("best"), copies.alias("group_size"))
        return cut(rows.select("digest", (-F.col("best.minus_id")).alias("keep_id"), F.col("best.locator").alias("locator"), "group_size"), "dedup-classes")


def _with_class(rows: DataFrame, classes: DataFrame, large: Column) -> DataFrame:
    """The rows with the class of their digest, those without one left out. A ``large`` class has over a ten-thousandth
    of all rows and goes to every executor, so that its rows need not meet in one task; there are fewer than ten
    thousand such classes at any size."""
    hot = F.broadcast(classes.filter(large))
    of_hot = rows.join(hot, "digest")
    others = rows.join(F.broadcast(classes.filter(large).select("digest")), "digest", "left_anti")
    return of_hot.unionByName(others.join(classes.filter(~large), "digest"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 32) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row. ``digest_bytes`` under 32 is for tests."""
    spark = docs.sparkSession
    source, state = new_path(spark, "dedup-digests"), new_path(spark, "dedup-state")
    digest_rows(docs, id_col, text_col, digest_bytes).write.parquet(source)
    rows = spark.read.schema(DIGEST_ROW).parquet(source)
    if rows.isEmpty():
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.lit("").alias("text_sha256"))
    run_stream(spark, source, state)
    classes = read_state(spark, state)
    large = F.col("group_size") * 10_000 > rows.count()
    parts = ["doc_id", "sha", "keep_id", "group_size"]
    members = _with_class(rows, classes.drop("locator"), large)

    # Hits are compared byte for byte: the least and the greatest text of a key are the same text. Both are
    # combined on the map side, so a group of any size moves two texts for each task. A text finds its key by its own
    # digest, as an id may be null or stand on several texts.
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_points"), normalised(F.col(text_col)).alias("body"))
    shas = given.withColumn("sha", F.unhex(F.sha2(F.col("body").cast("binary"), 256)))
    texts = shas.withColumn("digest", F.substring("sha", 1, digest_bytes))
    hits = cut(classes.filter("group_size > 1").select("digest", "group_size"), "dedup-hits").hint("shuffle_hash")  # texts aren't sorted
    hit_texts = _with_class(texts.select("digest", "body"), hits, large)
    bad = cut(
        hit_texts.groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high"))
        .filter(F.col("low") != F.col("high")).select("digest"),
        "dedup-collisions",
    )
    if not bad.isEmpty():
        # Other texts under one digest: those keys are grouped by the whole digest-independent text instead.
        whole = texts.join(bad, "digest", "left_semi")
        per_text = whole.groupBy("digest", "body").agg(F.max(F.struct("n_points", (-F.col("doc_id")).alias("minus_id"))).alias("best"), F.count(F.lit(1)).alias("group_size"))
        split = whole.join(per_text, ["digest", "body"]).withColumn("keep_id", -F.col("best.minus_id")).select(*parts)
        members = members.join(bad, "digest", "left_anti").select(*parts).unionByName(split)
    return members.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
