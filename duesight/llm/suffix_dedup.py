"""Removal of repeated byte strings, with suffixes sorted in range-partitioned buckets.

A text is its UTF-8 bytes. Every string of 100 bytes has an anchor that its content alone decides (see ``repeats``):
the position of its least hashed 8 bytes among the first 72, so that the 29 bytes from there on lie in the string. Only
suffixes at anchors whose 29 leading bytes come up in different surroundings have to be sorted. They are dealt by
sampled splitters over their leading bytes into buckets. A bucket sorts the suffixes of all the strings its
anchors stand for, leading bytes by leading bytes, by multikey quicksort, eight bytes a step, and compares neighbours: all but the first of equal strings
are repeats. A bucket's first and last leading bytes may go on in the next bucket; the first of their strings are
compared across the boundaries by 128-bit hashes.

Null texts are empty. A null id counts as smaller than any other. Rows with one id are one document if their texts are
equal; different texts under one id share what is removed. Every row is reported. Texts of any length are read whole, empty tables
give no rows, and columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesight.llm import repeats as R
from duesight.llm.runs import starts_of, whole_runs

SIZE = 100
LEAD = 29
GRAM = 8
#: Anchors of a bucket, most buckets (the driver gets a sample of the leading bytes for each), anchors sorted at a time.
BUCKET, MOST_BUCKETS, CHUNK = 50_000, 10_000, 4000
_SMALL = 40


def _order(flat: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.full(len(flat), np.iinfo(np.uint64).max)
    if len(flat) >= GRAM:
        grams = flat[: len(flat) - GRAM + 1].copy()
        for k in range(1, GRAM):
            grams *= np.uint64(0x9E3779B97F4A7C15)
            grams += flat[k : k + len(grams)]
        out[: len(grams)] = R.mixed_up(grams) >> np.uint64(1)
    return out


def _bytes(body: bytes) -> np.ndarray:
    return np.frombuffer(body, np.uint8)


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """Order of the rows of ``words`` (unsigned numbers, the first the most significant)."""
    order = np.arange(len(words))
    plain = np.ascontiguousarray(words.astype(">u8")).view(f"S{8 * words.shape[1]}").ravel() if len(words) else None
    todo = [(0, len(words), 0)]
    while todo:
        low, high, depth = todo.pop()
        if high - low < 2 or depth == words.shape[1]:
            continue
        own = order[low:high]
        if high - low <= _SMALL:
            order[low:high] = own[np.argsort(plain[own], kind="stable")]
            continue
        column = words[own, depth]
        pivot = np.partition(column[:: max(1, len(column) // 9)], 4)[4]
        less, more = column < pivot, column > pivot
        same = own[~(less | more)]
        a, b = low + np.count_nonzero(less), high - np.count_nonzero(more)
        order[low:a], order[a:b], order[b:high] = own[less], same, own[more]
        todo += [(low, a, depth), (a, b, depth + 1), (b, high, depth)]
    return order


SUFFIX = "lead binary, text binary, doc_id long, low long, at long"
#: A repeated string that starts at p; with a name, a string that may go on in another bucket.
FOUND = "doc_id long, p long, name binary"


def suffixes(docs: DataFrame, anchors: DataFrame, size: int, lead: int) -> DataFrame:
    """For each anchor: its leading bytes, and the bytes that its strings cover."""

    def make(doc_id: int, body: bytes, own: np.ndarray) -> list[tuple]:
        fit = own[own[:, 1] + size <= len(body)]
        return [(body[at : at + lead], body[low : high + size], doc_id, low, at) for low, high, at in fit.tolist()]

    places = anchors.select("doc_id", F.col("low").alias("a"), F.col("high").alias("b"), F.col("at").alias("c"))
    return R.beside(docs, places, make, SUFFIX, all_docs=False)


def _sorted_strings(frame: pd.DataFrame, size: int, edges: set[bytes]) -> Iterator[pd.DataFrame]:
    """``FOUND`` for anchors that include all of the bucket with the same leading bytes."""
    views = [np.lib.stride_tricks.sliding_window_view(np.frombuffer(t, np.uint8), size) for t in frame.text]
    numbers = np.array([len(v) for v in views])
    owner = np.repeat(np.arange(len(frame)), numbers)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(numbers) - numbers, numbers) + frame.low.to_numpy()[owner]
    raw = np.zeros((len(owner), -(-size // 8) * 8), np.uint8)
    np.concatenate(views, out=raw[:, :size])
    words = raw.view(">u8").astype(np.uint64)
    order = multikey_quicksort(words)
    equal = (words[order[1:]] == words[order[:-1]]).all(axis=1)
    group = np.cumsum(np.concatenate([[True], ~equal])) - 1
    doc = frame.doc_id.to_numpy()[owner]
    by = np.lexsort((place[order], doc[order], group))
    group, order = group[by], order[by]
    new = np.concatenate([[True], group[1:] != group[:-1]])
    lead = order[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    again = np.zeros(len(owner), bool)
    again[order] = (doc[order] > doc[lead]) | (place[order] > place[lead])
    yield pd.DataFrame({"doc_id": doc[again], "p": place[again], "name": None})
    on_edge = frame.lead.isin(edges).to_numpy()[owner]
    first = np.flatnonzero(~again & on_edge)
    names = [xxhash.xxh128_digest(raw[i, :size].tobytes()) for i in first]
    yield pd.DataFrame({"doc_id": doc[first], "p": place[first], "name": names})


def _bucket(size: int):
    """Repeated strings of one bucket, and the first of the strings under its first and last leading bytes.

    Only one batch and one run of equal leading bytes is in memory, whatever the size of the bucket.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, held = None, None
        for frame in whole_runs(batches, ["lead"]):
            cuts = starts_of(frame, ["lead"])
            steps = [0, *[int(c) for i, c in enumerate(cuts[1:-1], 1) if c // CHUNK != cuts[i - 1] // CHUNK], len(frame)]
            for a, b in zip(steps[:-1], steps[1:], strict=True):
                first = first or frame.lead.iat[0]
                if held is not None:
                    yield from _sorted_strings(held, size, {first})
                held = frame.iloc[a:b].reset_index(drop=True)
        if held is not None:
            yield from _sorted_strings(held, size, {first, held.lead.iat[-1]})

    return run


def repeated_strings(table: DataFrame, size: int, bucket: int) -> DataFrame:
    """``doc_id, p``: starts in ``table`` (of ``suffixes``) whose string stands at an earlier place, too."""
    parts = max(1, min(MOST_BUCKETS, -(-table.count() // bucket)))
    dealt = table.repartitionByRange(parts, "lead", "doc_id", "at").sortWithinPartitions("lead")
    found = R.cut(dealt.mapInPandas(_bucket(size), FOUND), "strings")
    open_ends = found.filter("name is not null")
    owners = open_ends.groupBy("name").agg(F.min(F.struct("doc_id", "p")).alias("owner"))
    across = open_ends.join(owners, "name").filter(F.struct("doc_id", "p") > F.col("owner"))
    return found.filter("name is null").select("doc_id", "p").unionByName(across.select("doc_id", "p"))


def remove_repeats(docs: DataFrame, size: int = SIZE, lead: int = LEAD, bucket: int = BUCKET, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans`` and ``kept_sha256`` of the bytes that stay, of every row."""
    given = R.bodies(docs, id_col, text_col)
    found = R.marks(R.anchor_rows(given, _bytes, _order, R.Windows(size, 0, lead), by_document=False), by_document=False)
    table = R.cut(suffixes(given, found.filter("not sure"), size, lead), "suffixes")
    strings = repeated_strings(table, size, bucket)
    gone = found.filter("sure").select("doc_id", F.col("low").alias("a"), (F.col("high") + size).alias("b")).unionByName(strings.select("doc_id", F.col("p").alias("a"), (F.col("p") + size).alias("b")))

    def make(doc_id: int, body: bytes, own: np.ndarray) -> list[tuple]:
        out = R.covered(len(body), own)
        kept = np.frombuffer(body, np.uint8)[~out].tobytes() if len(own) else body
        return [(doc_id, len(body), len(body) - len(kept), R.spans(out), hashlib.sha256(kept).hexdigest())]

    return R.named(R.beside(given, gone, make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", all_docs=True))
