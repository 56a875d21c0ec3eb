"""WARC archives of pages, and the index of all captures in them, merged from sorted runs.

``write`` stores each page as a WARC/1.1 record. Pages with equal payloads of some length are stored once: the
one with the smallest id as ``response``, the others as ``revisit`` records that refer to it. Every write task leaves one
archive with its records in the order of URL key, time and id. ``read`` takes the records out of the archives and
checks their lengths and digests; damage stops the read.

``merged_index`` makes the index of all archives by an external merge. Each archive gives one run, sorted like its
records, with the place of each record in the file. Sampled splitters cut the runs into ranges of keys, and ranges
into blocks. For each range one task merges its runs with a loser tree. Blocks arrive in the order of their first
keys and are opened when the merge reaches them, so a task holds those blocks that overlap, at most about one for each
run, however long the runs are. A URL with very many captures is split over ranges by time and id. The index is in
global order, and the captures of a URL key follow one another as its history.

Archives are gzip files unless they are asked for plain; the places in the index are those in the unpacked file. The records
are told apart by a header with a random name of the archives, which no payload can know; only
archives of ``write`` can be read. Files are written and read by Spark itself, so they may lie in any store.

Null urls are an empty key and give no target; a null payload is empty; a null date is the start of 1970. White space
and control characters in a url are written as ``%20``. Payloads of any length are written whole. A row without id
never owns a payload: it revisits the smallest id, or is a response if no row with its payload has an id. Rows
that repeat an id with the same payload share its verdict, each with a record of its own. Equal keys of different
records follow in the order of their archives. Empty tables give empty archives. Columns other than the named ones are ignored.
"""

from __future__ import annotations

import pickle
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duesight.llm.scratch import cut, new_path

LEAST_SHARED = 100
#: Payload bytes of an archive, captures of a range, sampled keys of a range, captures of a block.
ARCHIVE_BYTES, RANGE, SAMPLE, BLOCK = 256 << 20, 2_000_000, 20, 2048

_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ORDER = ["url_key", "captured", "page_id", "payload_digest", "url"]


@dataclass(frozen=True)
class Archives:
    folder: str
    name: str

    @property
    def mark(self) -> str:
        """What every record starts with."""
        return f"WARC/1.1\r\nWARC-Archive: {self.name}\r\n"


def url_key(url: Column) -> Column:
    """Host labels from the last to the first, a bracket, the path: ``com,example)/a?b``. No scheme, user, port, ``www.``
    or fragment."""
    clean = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7F]", "%20")
    bare = F.regexp_replace(F.regexp_replace(clean, r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), "#.*$", "")
    place = F.regexp_extract(bare, "^[^/?]*", 0)
    host = F.regexp_replace(F.regexp_replace(F.lower(place), r"^.*@|:[0-9]*$", ""), r"^www\.", "")
    path = F.substring(bare, F.length(place) + 1, F.length(bare))
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)


def _captures(pages: DataFrame, id_col: str, url_col: str, payload_col: str, date: Column) -> DataFrame:
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.col(url_col), r"[\x00-\x20\x7F]", "%20").alias("url"),
        url_key(F.col(url_col)).alias("url_key"),
        F.date_format(F.coalesce(date, F.timestamp_seconds(F.lit(0))), "yyyyMMddHHmmss").alias("captured"),
        payload.alias("payload"),
    )
    return rows.select("*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2(F.col("payload").cast("binary"), 256).alias("payload_digest"))


def _record(name: str) -> Column:
    """The record's text but for the two line ends that close it."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes"), F.lit(_END))
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    day = F.date_format(F.to_timestamp("captured", "yyyyMMddHHmmss"), "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def field(key: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{key}: "), value, F.lit("\r\n")), F.lit(""))

    return F.concat(
        F.lit(Archives("", name).mark),
        field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:capture:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        field("WARC-Date", day),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        field("WARC-Refers-To", F.concat(F.lit("<urn:capture:"), F.col("refers_to").cast("string"), F.lit(">"))),
        field("WARC-Profile", F.when(revisit, _PROFILE)),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(_END),
        block,
    )


def write(pages: DataFrame, date: Column, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_shared: int = LEAST_SHARED, archive_bytes: int = ARCHIVE_BYTES, compression: str = "gzip") -> Archives:
    """Archives of all rows in a new shared folder. Payloads are moved once, by digest or, in large groups, by row."""
    spark = pages.sparkSession
    rows = _captures(pages, id_col, url_col, payload_col, date)
    narrow = cut(rows.select("page_id", "payload_bytes", "payload_digest"), "warc-digests")
    shared = narrow.filter(F.col("payload_bytes") >= least_shared).groupBy("payload_digest")
    owners = cut(shared.agg(F.min("page_id").alias("owner"), F.count(F.lit(1)).alias("n")).filter("n > 1 and owner is not null"), "warc-owners")
    total = narrow.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("payload_bytes"), F.lit(0)).alias("bytes")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total.bytes) // archive_bytes))
    # Fewer than ten thousand payloads have over a ten-thousandth of all rows: their owners go to every task.
    large = F.col("n") * 10_000 > total.n
    hot = F.broadcast(owners.filter(large).select("payload_digest", F.col("owner").alias("hot_owner")))
    by_row = F.concat_ws(" ", F.lit("row"), F.xxhash64("page_id", "url", "captured").cast("string"))
    placed = rows.join(hot, "payload_digest", "left").withColumn("place", F.when(F.col("hot_owner").isNull(), F.col("payload_digest")).otherwise(by_row))
    others = owners.filter(~large).select(F.col("payload_digest").alias("place"), "owner").repartition(parts, "place").hint("shuffle_hash")
    joined = placed.repartition(parts, "place").join(others, "place", "left").withColumn("owner", F.coalesce("hot_owner", "owner"))
    judged = joined.withColumn("refers_to", F.when((F.col("payload_bytes") >= least_shared) & ~F.col("owner").eqNullSafe(F.col("page_id")), F.col("owner")))
    archives = Archives(new_path(spark, "warc"), f"<urn:uuid:{uuid.uuid4()}>")
    records = judged.sortWithinPartitions(*_ORDER).select(_record(archives.name).alias("value"))
    records.write.option("lineSep", _END).text(archives.folder, compression=compression)
    return archives


def read(spark: SparkSession, archives: Archives) -> DataFrame:
    """All records: ``archive, page_id, record_type, refers_to, url, url_key, captured, payload`` (null in revisits),
    ``payload_bytes, payload_digest`` and ``length`` (bytes of the record). Of revisits, bytes and digest are those the
    record's headers give for the whole payload."""
    pieces = spark.read.option("lineSep", archives.mark).text(archives.folder).filter("value != ''")
    header = pieces.select(F.substring_index(F.input_file_name(), "/", -1).alias("archive"), F.substring_index("value", _END, 1).alias("header"), "value")
    blocks = header.select("archive", "header", F.octet_length("value").alias("piece"), F.substring(F.col("value"), F.length("header") + 5, F.length("value")).alias("block"))
    split = blocks.select("*", F.substring_index("block", _END, 1).alias("http"))
    parts = split.select("*", F.substring(F.col("block"), F.length("http") + 5, F.length("block") - F.length("http") - 8).alias("body"))

    def field(key: str, of: str = "header") -> Column:
        found = F.regexp_extract(F.col(of), rf"(?:^|\r\n){key}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    def number(key: str) -> Column:
        return F.regexp_extract(field(key), "<urn:capture:(-?[0-9]+)>", 1)

    url = field("WARC-Target-URI")
    rows = parts.select(
        "archive", "body", "piece",
        (F.octet_length("header") + 4 + field("Content-Length").cast("long") + 4).alias("said"),
        F.nullif(number("WARC-Record-ID"), F.lit("")).cast("long").alias("page_id"),
        field("WARC-Type").alias("record_type"),
        F.nullif(number("WARC-Refers-To"), F.lit("")).cast("long").alias("refers_to"),
        url.alias("url"), url_key(url).alias("url_key"),
        F.regexp_replace(field("WARC-Date"), "[^0-9]", "").alias("captured"),
        field("Content-Length", "http").cast("long").alias("payload_bytes"),
        F.regexp_extract(field("WARC-Payload-Digest"), "sha256:(.*)", 1).alias("payload_digest"),
    )
    stored = F.col("record_type") == "response"
    whole = (F.col("said") == F.col("piece")) & (~stored | (F.octet_length("body") == F.col("payload_bytes")))
    digest = F.sha2(F.col("body").cast("binary"), 256)
    same = ~stored | (digest == F.col("payload_digest"))
    checked = F.when(F.coalesce(whole & same, F.lit(False)), F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("damaged record in "), F.col("archive"))))
    return rows.select(
        "archive", "page_id", "record_type", "refers_to", "url", "url_key", "captured", F.when(stored, F.col("body")).alias("payload"),
        "payload_bytes", checked.alias("payload_digest"), (F.col("piece") + len(archives.mark)).cast("long").alias("length"),
    )


class LoserTree:
    """The least of the keys of k runs. Inner places hold the run that lost there, so that the next key of the winner
    is compared once on each level. Equal keys go to the run that stands first."""

    END = "\U0010ffff" * 2

    def __init__(self, keys: list[str]):
        self.keys, k = keys, len(keys)
        self.losers = [0] * k
        won = [0] * k + list(range(k))
        for node in range(k - 1, 0, -1):
            a, b = won[2 * node], won[2 * node + 1]
            won[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.winner = won[1] if k > 1 else 0

    def _before(self, a: int, b: int) -> bool:
        return (self.keys[a], a) < (self.keys[b], b)

    def replace(self, key: str) -> None:
        """The winner's next key, or ``END``."""
        run = self.winner
        self.keys[run] = key
        node = (run + len(self.keys)) // 2
        while node:
            if self._before(self.losers[node], run):
                run, self.losers[node] = self.losers[node], run
            node //= 2
        self.winner = run


def merge_blocks(blocks: Iterator[tuple[str, int, list[tuple]]]) -> Iterator[tuple]:
    """Rows of all runs in order. ``blocks``: first key, run and rows, in the order of first keys; a row starts with its key."""
    rows: list[list[tuple]] = []
    at: list[int] = []
    owners: list[int] = []
    tree = LoserTree([])

    def until(limit: str) -> Iterator[tuple]:
        while tree.keys and tree.keys[tree.winner] < limit:
            run = tree.winner
            yield rows[run][at[run]]
            at[run] += 1
            tree.replace(rows[run][at[run]][0] if at[run] < len(rows[run]) else LoserTree.END)

    for first, run, more in blocks:
        yield from until(first)
        if run in owners and at[owners.index(run)] < len(rows[owners.index(run)]):
            place = owners.index(run)
            rows[place] = rows[place][at[place] :] + more
            at[place] = 0
            continue
        live = [i for i in range(len(rows)) if at[i] < len(rows[i])]
        entries = sorted([(owners[i], rows[i][at[i] :]) for i in live] + [(run, more)], key=lambda e: e[0])
        owners, rows = [e[0] for e in entries], [e[1] for e in entries]
        at = [0] * len(rows)
        tree = LoserTree([r[0][0] for r in rows])
    yield from until(LoserTree.END)


_ENTRY = "url_key string, captured string, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, archive string, offset long, length long"
_FIELDS = [f.split()[0] for f in _ENTRY.split(", ")]
_BLOCK = pa.schema([("range", pa.int32()), ("first", pa.string()), ("run", pa.int64()), ("number", pa.int32()), ("rows", pa.binary())])
_MERGED = pa.schema(
    [("range", pa.int32()), ("seq", pa.int64()), ("capture", pa.int64())]
    + [(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in _ENTRY.split(", ")]
)


def _blocks(splitters: list[str], size: int):
    """Runs cut into blocks that lie in one range each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = 0
        for batch in batches:
            given = batch.to_pydict()
            keys, runs = given["key"], given["run"]
            rows = list(zip(keys, *(given[f] for f in _FIELDS), strict=True))
            out, low = [], 0
            while low < len(rows):
                part = bisect_right(splitters, keys[low])
                end = bisect_right(runs, 0, low, min(len(rows), low + size), key=lambda r, own=runs[low]: int(r != own))
                if part < len(splitters):
                    end = bisect_left(keys, splitters[part], low, end)
                out.append((part, keys[low], runs[low], number, pickle.dumps(rows[low:end])))
                number += 1
                low = end
            yield from _table(out, _BLOCK)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each range in order, with their number in the range and in the range's captures of the URL key."""
    rows = (row for batch in batches for row in zip(*batch.to_pydict().values(), strict=True))
    ahead = next(rows, None)

    def of_part(part: int) -> Iterator[tuple[str, int, list[tuple]]]:
        nonlocal ahead
        while ahead is not None and ahead[0] == part:
            _, first, run, _, body = ahead
            ahead = next(rows, None)
            yield first, run, pickle.loads(body)

    while ahead is not None:
        part, out, key, capture = ahead[0], [], None, 0
        for seq, row in enumerate(merge_blocks(of_part(part))):
            capture = capture + 1 if row[1] == key else 1
            key = row[1]
            out.append((part, seq, capture, *row[1:]))
            if len(out) == 4096:
                yield from _table(out, _MERGED)
                out = []
        yield from _table(out, _MERGED)


def _table(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _key() -> Column:
    """Text that sorts like URL key, time and id; blanks sort before all that a URL key holds."""
    number = F.lpad((F.col("page_id").cast("decimal(20,0)") + F.lit(Decimal(2**63)).cast("decimal(20,0)")).cast("string"), 20, "0")
    return F.concat_ws(" ", "url_key", "captured", F.coalesce(number, F.lit("")))


def merged_index(records: DataFrame, range_rows: int = RANGE, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """One row for each record, ``position`` being its place in the order of URL key, time and id, and ``capture`` its place
    among the captures of its URL key (both from 1), with the record's place in its archive."""
    spark = records.sparkSession
    narrow = cut(records.drop("payload").withColumn("key", _key()), "warc-captures")
    in_file = Window.partitionBy("archive").orderBy(*_ORDER)
    before = F.sum("length").over(in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("length")
    # Files hold their records in this order, so the lengths before a record give its place.
    runs = narrow.withColumn("offset", before).withColumn("run", F.xxhash64("archive"))
    n = narrow.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // range_rows))
    every = max(1, n // (ranges * sample))
    keys = sorted(r.key for r in narrow.filter(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(every)) == 0).select("key").collect())
    splitters = sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []
    blocks = runs.select("run", "key", *_FIELDS).mapInArrow(_blocks(splitters, block), "range int, first string, run long, number int, rows binary")
    dealt = blocks.repartition(ranges, "range").sortWithinPartitions("range", "first", "run", "number")
    merged = cut(dealt.mapInArrow(_merge, f"range int, seq long, capture long, {_ENTRY}"), "warc-index")

    # A range goes on where the one before it ended: one row for each range comes to the driver.
    ends = merged.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("seq", "url_key")).alias("first"), F.max(F.struct("seq", "url_key", "capture")).alias("last"))
    past, of_key, carried = 0, (None, 0), []
    for part in sorted(ends.collect(), key=lambda r: r.range):
        earlier = of_key[1] if part.first.url_key == of_key[0] else 0
        carried.append((part.range, past, part.first.url_key, earlier))
        alone = part.last.url_key == part.first.url_key
        of_key = (part.last.url_key, part.last.capture + (earlier if alone else 0))
        past += part.n
    known = F.broadcast(spark.createDataFrame(carried, "range int, past long, first_key string, earlier long"))
    goes_on = F.when(F.col("url_key") == F.col("first_key"), F.col("earlier")).otherwise(0)
    return merged.join(known, "range").select((F.col("past") + F.col("seq") + 1).alias("position"), (F.col("capture") + goes_on).alias("capture"), *_FIELDS)
