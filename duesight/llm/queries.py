"""The queries of the operators over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duesight.llm import exact_dedup, hard_negatives, html_extraction, language_id, neighbours, packing, piece_encoding, pii, recompression, simhash, spelling, suffix_dedup, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(rows, rows.filter("vec_id % 20 = 0"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[pii.number(kind).alias(f"n_{kind}") for kind in pii.KINDS], F.sha2(pii.as_text(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.as_text(F.col("spans")).alias("spans"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extraction.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("word_bpe_49k.json")
    return packing.pack(table(spark, sf_dir, "documents"), lambda: packing.WordEncoder(path))


def op8_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompression.remove_repeats(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out(F.col("doc_id"))
    found = language_id.identify(docs, language_id.fit(docs.filter(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op10_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer("piece_bpe_32k.model")
    rows = piece_encoding.encode(table(spark, sf_dir, "documents"), lambda: piece_encoding.shared(path))
    return rows.select("doc_id", "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.counted(table(spark, sf_dir, "documents"), least_points=6, least_count=5, slip_every=199)
    return spelling.variants(words, factor=5)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages have no capture time: one counts as captured as many seconds after 2020 began as its id says, modulo 10^9."""
    archives = warc.write(table(spark, sf_dir, "pages"), F.timestamp_seconds(1_577_836_800 + F.pmod("page_id", F.lit(10**9))))
    index = warc.merged_index(warc.read(spark, archives))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "capture", "position")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(moved, lambda usable: usable.filter("vec_id % 100 = 0"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_neighbours,
        op2_pii,
        op3_html_extraction,
        op4_suffix_dedup,
        op5_simhash,
        op6_exact_dedup,
        op7_packing,
        op8_recompression,
        op9_language_id,
        op10_piece_encoding,
        op11_spelling,
        op12_warc,
        op13_hard_negatives,
    )
}

_BLANKS = r"[ \t\n\v\f\r]"

#: The digits of the UTF-8 bytes stand for the bytes, two for each: 100 bytes are 200 digits.
_BYTES_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS body FROM documents),
n AS (SELECT doc_id, body, length(body) // 2 AS n_bytes FROM d),
starts AS (SELECT doc_id, p, substring(body, 2 * p + 1, 200) AS part
           FROM (SELECT doc_id, body, unnest(range(0, n_bytes - 99)) AS p FROM n)),
ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY part ORDER BY doc_id, p) AS k FROM starts),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 100)) AS pos FROM ranked WHERE k > 1),
spans AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (pos <> before + 1 OR before IS NULL) AS n_spans
          FROM (SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM gone) GROUP BY doc_id),
each AS (SELECT doc_id, pos, substring(body, 2 * pos + 1, 2) AS byte
         FROM (SELECT doc_id, body, unnest(range(0, n_bytes)) AS pos FROM n)),
kept AS (SELECT doc_id, string_agg(byte, '' ORDER BY pos) AS body
         FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT n.doc_id, n.n_bytes::BIGINT AS n_bytes, coalesce(s.n_removed, 0)::BIGINT AS n_removed,
       coalesce(s.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.body, ''))) AS kept_sha256
FROM n LEFT JOIN spans s USING (doc_id) LEFT JOIN kept k USING (doc_id)"""

_WORDS_SQL = rf"""
WITH n AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_BLANKS}+'), lambda w: w <> '') AS words FROM documents),
starts AS (SELECT doc_id, p, array_to_string(words[p : p + 49], ' ') AS part
           FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS p FROM n)),
owners AS (SELECT part, min(doc_id) AS owner FROM starts GROUP BY part),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS pos FROM starts JOIN owners USING (part) WHERE doc_id > owner),
each AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM n),
kept AS (SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY pos) AS body
         FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT n.doc_id, len(n.words)::BIGINT AS n_words, (len(n.words) - coalesce(k.n_kept, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM n LEFT JOIN kept k USING (doc_id)"""

#: CRC-32 over the bytes, from a table that its polynomial gives; near words share what is left when one code point
#: goes: at the same place (replaced), or the word itself (deleted, inserted).
_SPELLING_SQL = r"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)),
per_doc AS (SELECT doc_id, run, count(*) AS m FROM runs GROUP BY ALL),
octets AS (SELECT doc_id, run, m, hex(encode(doc_id || ':' || run)) AS x FROM per_doc WHERE length(run) > 5),
hashed AS (SELECT doc_id, run, m, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(1, length(x), 2), lambda p: (instr('0123456789ABCDEF', x[p]) - 1) * 16 + instr('0123456789ABCDEF', x[p + 1]) - 1)),
    lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]))) AS h FROM octets, crc),
slips AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, m FROM hashed),
words AS (SELECT word, sum(m)::BIGINT AS n FROM slips WHERE length(word) >= 6 GROUP BY word HAVING sum(m) >= 5),
less AS (SELECT word, n, p, left(word, p) || substring(word, p + 2) AS part
  FROM (SELECT word, n, unnest(range(0, length(word))) AS p FROM words)),
near AS (SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.part = b.part AND a.p = b.p AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.part = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.part = b.word),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS form, max(n) AS form_n FROM near GROUP BY word),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
    CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
steps(word, here) AS (SELECT word, word FROM formed UNION ALL SELECT s.word, f.form FROM steps s JOIN formed f ON s.here = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT s.word, s.here AS root FROM steps s JOIN formed f ON s.here = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e ON f.word = e.word"""

_WARC_SQL = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS body, regexp_replace(regexp_replace(
    regexp_replace(coalesce(url, ''), '[\x00-\x20\x7F]', '%20', 'g'), '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '#.*$', '') AS bare FROM pages),
h AS (SELECT *, regexp_extract(bare, '^[^/?]*') AS place FROM p),
k AS (SELECT page_id, url, strlen(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest,
    array_to_string(list_reverse(string_split(regexp_replace(regexp_replace(lower(place), '^.*@|:[0-9]*$', '', 'g'), '^www\.', ''), '.')), ',')
      || ')' || substring(bare, length(place) + 1) AS url_key FROM h),
o AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS owner FROM k)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> owner THEN owner END AS refers_to, url_key,
  row_number() OVER (PARTITION BY url_key ORDER BY page_id % 1000000000, page_id) AS capture,
  row_number() OVER (ORDER BY url_key, page_id % 1000000000, page_id) AS position
FROM o"""

_NEGATIVES_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM (SELECT * FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.vec, b.vec)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER best)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 10"""

ORACLE_SQL = {
    "op13_hard_negatives": _NEGATIVES_SQL,
    "op12_warc": _WARC_SQL,
    "op11_spelling": _SPELLING_SQL,
    "op6_exact_dedup": rf"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '{_BLANKS}', '', 'g') AS body
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
       count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id
         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS kept,
       sha256(body) AS text_sha256
FROM n""",
    "op4_suffix_dedup": _BYTES_SQL,
    "op8_recompression": _WORDS_SQL,
}
