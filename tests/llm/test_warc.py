from __future__ import annotations

import gzip
import hashlib
import random
from collections import defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from duesight.llm import warc as W
from tests.llm.conftest import SMALL

SCHEMA = "page_id long, url string, html string"


def seconds(step=1):
    return F.timestamp_seconds(1_577_836_800 + F.pmod("page_id", F.lit(10**9)) * step)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, repeated rows, long payloads, payloads that look like records, urls that need care."""
    page = "<p>" + "x" * 97
    fake = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nHello\r\n\r\nWARC/1.1\r\nWARC-Archive: <urn:uuid:"
    rows = [
        (1, "http://a.com/x", page), (2, "http://A.com:80/x#top", page), (3, "https://u@www.a.com/x", page), (3, "https://u@www.a.com/x", page),
        (4, None, None), (5, "", ""), (6, "http://b.org", page[:-1]), (7, "http://b.org", page[:-1]), (None, "http://c.de/?q=1", page), (None, None, "y" * 200),
        (8, "http://a.com/evil\r\nWARC-Type: revisit", fake), (9, "a b\tc", "Ünï\x00 😀" * 30), (10, "http://b.org/long", "long " * 200_000),
        (11, "http://b.org/end", "ends with W"), (12, "http://b.org/end", "\r\n\r\n\r\n"), (2**60 + 1, "http://z.z/", page), (-5, "http://z.z/", "z" * 100), (13, "http://z.z/", "z" * 100),
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    for name in ("payload", "archive", "captured", "key", "place", "owner", "offset", "run"):
        table = table.withColumn(name, F.lit("x"))
    return table, rows


def expected(rows):
    owners = defaultdict(list)
    for page_id, _, html in rows:
        if page_id is not None:
            owners[html or ""].append(page_id)
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        owner = min(owners[html or ""], default=None) if len(body) >= 100 else None
        refers = owner if owner != page_id else None
        out.append((page_id, len(body), hashlib.sha256(body).hexdigest(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def plain(index):
    return sorted((tuple(r) for r in index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


@pytest.mark.parametrize("block", [2, W.BLOCK])
def test_round_trip_of_odd_rows(spark, odd, block):
    table, rows = odd
    archives = W.write(table, seconds())
    records = W.read(spark, archives)
    stored = {(r.page_id, r.payload) for r in records.filter("record_type = 'response'").collect()}
    assert stored <= {(i, html or "") for i, _, html in rows}
    index = W.merged_index(records, range_rows=3, sample=10, block=block)
    assert plain(index) == expected(rows)


@pytest.mark.parametrize(("compression", "opened"), [("gzip", gzip.open), ("none", open)])
def test_history_and_places(spark, odd, compression, opened):
    """Global order, history of each key, and records found in the files at the places of the index."""
    table, rows = odd
    archives = W.write(table, seconds(), compression=compression)
    index = W.merged_index(W.read(spark, archives), range_rows=2, sample=5, block=1).orderBy("position").collect()
    assert [r.position for r in index] == list(range(1, len(rows) + 1))
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in index]
    assert keys == sorted(keys)
    seen = defaultdict(int)
    for r in index:
        seen[r.url_key] += 1
        assert r.capture == seen[r.url_key]
    assert seen["com,a)/x"] == 4
    texts = {i: html for i, _, html in rows}
    for r in index:
        with opened(Path(archives.folder) / r.archive, "rb") as file:
            file.seek(r.offset)
            body = file.read(r.length)
        assert body.startswith(archives.mark.encode()) and body.endswith(b"\r\n\r\n")
        if r.page_id is not None:
            assert f"<urn:capture:{r.page_id}>".encode() in body
            if r.record_type == "response":
                assert body[: -len(b"\r\n\r\n")].endswith((texts[r.page_id] or "").encode())


def test_empty_table(spark, odd):
    assert plain(W.merged_index(W.read(spark, W.write(odd[0].filter("false"), seconds())))) == []


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    assert plain(W.merged_index(W.read(spark, W.write(pages, seconds())))) == expected(rows)


def test_damage_stops_the_read(spark, odd):
    archives = W.write(odd[0], seconds(), compression="none")
    for file in Path(archives.folder).glob("part-*"):
        file.write_bytes(file.read_bytes().replace(b"<p>xxx", b"<p>yxx"))
    for file in Path(archives.folder).glob(".*.crc"):
        file.unlink()
    with pytest.raises(Exception, match="damaged record"):
        W.read(spark, archives).select("payload_digest").collect()


def test_hot_payload_and_hot_url(spark):
    """A third of all rows share a payload and a URL: the URL's captures are split over ranges."""
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"),
        F.when(F.col("id") % 3 == 0, "http://hot.com/").otherwise(F.concat(F.lit("http://h"), F.col("id") % 50, F.lit(".com/"))).alias("url"),
        F.when(F.col("id") % 3 == 0, "h" * 150).otherwise(F.concat(F.lit("page " * 30), F.col("id"))).alias("html"),
    )
    index = W.merged_index(W.read(spark, W.write(pages, seconds(7))), range_rows=300, block=50)
    hot = index.filter("url_key = 'com,hot)/'")
    assert hot.agg(F.max("capture"), F.countDistinct("capture")).first()[:] == (1000, 1000)
    assert index.filter("refers_to = 0").count() == 999 and index.filter("record_type = 'revisit'").count() == 999


def test_loser_tree():
    draw = random.Random(5)
    for k in (1, 2, 3, 7, 16):
        runs = [sorted(f"{draw.randrange(60):03d}" for _ in range(draw.randrange(1, 30))) for _ in range(k)]
        tree, at, out = W.LoserTree([r[0] for r in runs]), [0] * k, []
        while tree.keys[tree.winner] != W.LoserTree.END:
            run = tree.winner
            out.append((runs[run][at[run]], run))
            at[run] += 1
            tree.replace(runs[run][at[run]] if at[run] < len(runs[run]) else W.LoserTree.END)
        assert out == sorted((key, i) for i, r in enumerate(runs) for key in r)


def test_merge_opens_blocks_when_it_reaches_them():
    draw = random.Random(6)
    runs = [sorted(f"{draw.randrange(500):03d}" for _ in range(200)) for _ in range(9)]
    blocks = sorted((run[k], i, k, [(key, i) for key in run[k : k + 10]]) for i, run in enumerate(runs) for k in range(0, 200, 10))
    taken = []

    def arriving():
        for first, run, _, rows in blocks:
            taken.append(run)
            yield first, run, rows

    merged = W.merge_blocks(arriving())
    head = [next(merged) for _ in range(200)]
    assert len(taken) < 60
    assert [r[0] for r in [*head, *merged]] == sorted(key for run in runs for key in run)
