"""What the removal of long repeats shares: anchors of windows, classes of anchors, marks and the final cut.

A window is a fixed number of consecutive tokens of one document. Its anchor is chosen from its content alone, so
equal windows have the same anchor at the same place; windows that follow each other mostly share one, and
one row for each anchor stands for all its windows. Anchors with the same *key* (the content around the anchor
that lies in all its windows) and the same *context* (everything their windows cover) form a class, whose
windows are equal one by one: all but the first are repeats. Keys with several classes are *mixed*: some
of their windows may be equal and others not, and their first anchors go on to be compared window by window.

Copies are combined inside each batch before the shuffle. Keys that a sample of the documents shows to be frequent
are dealt over many parts by their context; the sample decides about nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesight.llm.runs import whole_runs
from duesight.llm.scratch import cut

NO_ID = -(1 << 63)  # stands for a null id, which comes first
_MASK = np.uint64(0xFFFFFFFF)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
#: Tokens worked on at a time (a longer document is one chunk).
CHUNK = 1 << 20
#: One document of so many is looked at for frequent keys; keys seen so often there are dealt over so many parts.
SAMPLE, FREQUENT, PARTS, MOST_FREQUENT = 64, 50, 64, 20_000


def mixed_up(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Sums:
    """Hashes of any stretch of spread tokens, from prefix sums modulo 2**64."""

    def __init__(self, tokens: np.ndarray, which: int):
        n = len(tokens) + 1
        if which not in _powers or len(_powers[which][0]) < n:
            base = _BASES[which]
            up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            _powers[which] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        up, self.down = _powers[which]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(tokens * up[: n - 1], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.down[a]


@dataclass(frozen=True)
class Windows:
    """``size`` tokens; an anchor at i depends on the tokens from i - before up to i + after, all in the window."""

    size: int
    before: int
    after: int


@dataclass
class Anchors:
    at: np.ndarray
    low: np.ndarray  # first and last start of the windows that have this anchor
    high: np.ndarray


def anchors_of(order: np.ndarray, ends: np.ndarray, w: Windows) -> Anchors:
    """For documents that lie one behind the other and end at ``ends``: the least ``order`` in each window's zone,
    the rightmost of equals. Positions with the greatest value are none."""
    n, zone = len(order), w.size - w.before - w.after + 1
    none = np.zeros(0, np.int64)
    if n < w.size:
        return Anchors(none, none, none)
    low = (order & ~_MASK) | (_MASK - np.arange(n, dtype=np.uint64))
    span = 1
    while 2 * span <= zone:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < zone:
        low = np.minimum(low[: len(low) - (zone - span)], low[zone - span :])
    # low[i] is the least in [i, i + zone); window p has the zone from p + before.
    starts = np.arange(n - w.size + 1)
    at = (_MASK - (low[w.before : w.before + len(starts)] & _MASK)).astype(np.int64)
    begin = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(n + 1, np.int64)
    whole = ends - begin >= w.size
    np.add.at(inside, begin[whole], 1)
    np.add.at(inside, ends[whole] - w.size + 1, -1)
    starts = starts[np.cumsum(inside)[: len(starts)] > 0]
    at = at[starts]
    if not len(starts):
        return Anchors(none, none, none)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    return Anchors(at[new], starts[new], starts[np.append(new[1:], len(starts)) - 1])


#: Tokens of a text (bytes, or 64-bit names that get spread), and the order of anchors for the tokens of several texts that end at the given places.
Tokens = Callable[[bytes], np.ndarray]
Order = Callable[[np.ndarray, np.ndarray], np.ndarray]

ROW = "key long, salt int, ctx long, doc_id long, at long, low long, high long, sure boolean"


def _chunks(ids, bodies, tokens: Tokens, w: Windows) -> Iterator[tuple[list[int], list[int], list[np.ndarray]]]:
    """Documents in chunks. A long one is cut into blocks that overlap, so that each window lies in one block."""
    names, places, parts, n = [], [], [], 0
    for doc_id, body in zip(ids, bodies, strict=True):
        every = tokens(body)
        for place in range(0, max(len(every) - w.size + 1, 0), CHUNK):
            one = every[place : place + CHUNK + w.size - 1]
            if n and n + len(one) > CHUNK + w.size:
                yield names, places, parts
                names, places, parts, n = [], [], [], 0
            names.append(doc_id)
            places.append(place)
            parts.append(one)
            n += len(one)
    if n:
        yield names, places, parts


_SPREAD = mixed_up(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _rows(ids, bodies, tokens: Tokens, order: Order, w: Windows) -> pd.DataFrame:
    frames = []
    for names, places, parts in _chunks(ids, bodies, tokens, w):
        flat, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        flat = _SPREAD[flat] if flat.dtype == np.uint8 else mixed_up(flat)
        a = anchors_of(order(flat, ends), ends, w)
        one, two = Sums(flat, 0), Sums(flat, 1)
        key = mixed_up(one.of(a.at - w.before, a.at + w.after))
        ctx = mixed_up(two.of(a.low, a.high + w.size) + ((a.at - a.low).astype(np.uint64) << np.uint64(32)) + (a.high - a.low).astype(np.uint64))
        doc = np.searchsorted(ends, a.low, side="right")
        first = (np.concatenate([[0], ends[:-1]]) - np.array(places))[doc]
        frames.append(pd.DataFrame({"key": key.view(np.int64), "ctx": ctx.view(np.int64), "doc_id": np.array(names)[doc], "at": a.at - first, "low": a.low - first, "high": a.high - first}))
    if not frames:
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("key", "ctx", "doc_id", "at", "low", "high")})
    return pd.concat(frames, ignore_index=True)


def _repeats(frame: pd.DataFrame, by_document: bool) -> np.ndarray:
    """Rows, sorted by key, ctx, doc_id and at, that have an equal before them that counts."""
    key, ctx, doc, at = (frame[c].to_numpy() for c in ("key", "ctx", "doc_id", "at"))
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1])]) if len(key) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    return doc > doc[lead] if by_document else (doc > doc[lead]) | (at > at[lead])


def anchor_rows(docs: DataFrame, tokens: Tokens, order: Order, w: Windows, by_document: bool) -> DataFrame:
    """One row for each anchor of ``doc_id, body``; repeats inside a batch are ``sure`` at once."""
    frequent: set[int] = set()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hot = np.array(sorted(frequent), dtype=np.int64)
        for batch in batches:
            rows = _rows(batch.doc_id.to_numpy(), batch.body, tokens, order, w)
            rows = rows.sort_values(["key", "ctx", "doc_id", "at"], ignore_index=True)
            rows["sure"] = _repeats(rows, by_document)
            spread = rows.sure.to_numpy() | np.isin(rows.key.to_numpy(), hot)
            part = mixed_up(np.where(rows.sure, rows.doc_id + 7 * rows["at"], rows.ctx).astype(np.int64).view(np.uint64)) % np.uint64(PARTS)
            yield rows.assign(salt=np.where(spread, part.astype(np.int64) + 1, 0))[[x.split()[0] for x in ROW.split(", ")]]

    sample = docs.filter(F.pmod(F.xxhash64(F.lit("frequent"), "doc_id"), F.lit(SAMPLE)) == 0).mapInPandas(run, ROW)
    counts = sample.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= FREQUENT)
    frequent.update(r.key for r in counts.orderBy(F.desc("n")).limit(MOST_FREQUENT).collect())
    return docs.mapInPandas(run, ROW)


MARK = "doc_id long, at long, low long, high long, sure boolean"


def marks(rows: DataFrame, by_document: bool) -> DataFrame:
    """``sure``: the windows from low to high are repeats. Otherwise: a first anchor of a mixed key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(batches, ["key", "salt"]):
            known = frame.sure.to_numpy()
            out = [frame[known]]
            frame = frame[~known].sort_values(["key", "salt", "ctx", "doc_id", "at"], ignore_index=True)
            if len(frame):
                again = _repeats(frame, by_document)
                out.append(frame[again].assign(sure=True))
                firsts = frame[~again]
                # Classes of a key that is dealt over several parts may have others elsewhere.
                many = firsts.groupby(["key", "salt"]).ctx.transform("nunique").to_numpy() > 1
                out.append(firsts[many | (firsts.salt.to_numpy() > 0)])
            yield pd.concat(out)[["doc_id", "at", "low", "high", "sure"]]

    dealt = rows.repartition("key", "salt").sortWithinPartitions("key", "salt")
    return cut(dealt.mapInPandas(run, MARK), "marks")


# --- documents and what belongs to them, side by side ---

PAIRED = "doc_id long, a long, b long, c long, body binary"


def bodies(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, body``: the UTF-8 bytes of every row; a null text is empty, a null id is ``NO_ID``."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body")
    )


def beside(docs: DataFrame, stretches: DataFrame, make: Callable[[int, bytes, np.ndarray], list[tuple]], schema: str, all_docs: bool) -> DataFrame:
    """Rows that ``make(doc_id, body, stretches)`` gives for each document with its ``doc_id, a, b, c`` rows.

    The bodies travel compressed. Documents without stretches are left out unless ``all_docs``.
    """

    def squeeze(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch.doc_id, "a": -1, "b": -1, "c": -1, "body": [tool.compress(b) for b in batch.body]})

    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = zstandard.ZstdDecompressor()
        for frame in whole_runs(batches, ["doc_id"]):
            out: list[tuple] = []
            ids, whole, ab = frame.doc_id.to_numpy(), frame.body.notna().to_numpy(), frame[["a", "b", "c"]].to_numpy()
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                own = ab[x:y][~whole[x:y]]
                if len(own) or all_docs:
                    for body in frame.body.iloc[x:y][whole[x:y]]:
                        out += make(int(ids[x]), tool.decompress(body), own)
            yield pd.DataFrame(out, columns=names)

    packed = docs.mapInPandas(squeeze, PAIRED).unionByName(stretches.select("doc_id", "a", "b", "c" if "c" in stretches.columns else F.lit(0).cast("long").alias("c"), F.lit(None).cast("binary").alias("body")))
    return packed.repartition("doc_id").sortWithinPartitions("doc_id").mapInPandas(run, schema)


def covered(n: int, stretches: np.ndarray) -> np.ndarray:
    """Which of n tokens lie in a stretch [a, b)."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.minimum(stretches[:, 0], n), 1)
    np.add.at(change, np.minimum(stretches[:, 1], n), -1)
    return np.cumsum(change)[:n] > 0


def spans(gone: np.ndarray) -> int:
    """Maximal runs of true values."""
    return int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(gone[0]) if len(gone) else 0


def named(rows: DataFrame) -> DataFrame:
    """The null id again."""
    return rows.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
