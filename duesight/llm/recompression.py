"""Removal of long repeated passages of words, found by recompression.

Every document is a string of word symbols. Rounds rename it: a run of equal symbols and then a pair of neighbours,
of which the first falls in the left and the second in the right half of the alphabet, become one symbol. A name is
a hash of what it stands for, so that all tasks of a Spark job give equal runs and pairs the same name without a
shared dictionary; the halves are drawn anew in each round by a hash of the name. What is renamed depends on the
neighbouring symbols only, and runs beyond a bound are left alone: so the symbols of equal passages agree except
within a known distance of their ends. Every window of 50 words holds high-level symbols that are its own
content's alone. One of them, the least by a hash, is its anchor (see ``repeats``).

Shared symbols reveal repeats: anchors with equal surroundings meet in Spark. Those whose windows are all equal
are settled there. The windows of the others are compared one by one by 128-bit hashes.

Null texts have no words. A null id counts as smaller than any other. Rows with one id are one document if their texts
are equal; different texts under one id share what is removed. Every row is reported. Texts of any length are read whole, empty
tables give no rows, and columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duesight.llm import repeats as R

WINDOW = 50
ROUNDS = 2


def reach(rounds: int) -> tuple[int, int, int]:
    """Words before and after a symbol's start that decide about it, and the most words of a symbol."""
    before, after, most = 0, 1, 1
    for _ in range(rounds):
        run = max(2, most)
        before, after, most = before + run + most, after + run + most, run
        before, after, most = before + most, after + most, 2 * most
    return before, after, most


def rename(symbols: np.ndarray, starts: np.ndarray, document: np.ndarray, weights: np.ndarray, bound: int, salt: int) -> tuple[np.ndarray, ...]:
    """One round over the symbols of several documents: runs of at most ``bound`` words, then pairs."""
    if not len(symbols):
        return symbols, starts, document, weights
    lead = np.concatenate([[True], (symbols[1:] != symbols[:-1]) | (document[1:] != document[:-1])])
    first = np.flatnonzero(lead)
    length = np.diff(np.append(first, len(symbols)))
    short = (length > 1) & (length * weights[first] <= bound)
    # Of a short run the first symbol stays and takes the name of the run.
    symbols, weights = symbols.copy(), weights.copy()
    at = first[short]
    symbols[at] = R.mixed_up(symbols[at] + np.uint64(salt) + length[short].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    weights[at] *= length[short]
    inside = np.repeat(short, length) & ~lead
    symbols, starts, document, weights = (x[~inside] for x in (symbols, starts, document, weights))
    # Left symbols take a right neighbour; no symbol is both.
    left = (R.mixed_up(symbols ^ np.uint64(salt * 2 + 1)) >> np.uint64(63)) == 0
    pair = np.flatnonzero(left[:-1] & ~left[1:] & (document[1:] == document[:-1]))
    symbols, weights = symbols.copy(), weights.copy()
    symbols[pair] = R.mixed_up(symbols[pair] * np.uint64(0x9FB21C651E98DF25) + R.mixed_up(symbols[pair + 1]) + np.uint64(salt))
    weights[pair] += weights[pair + 1]
    stays = np.ones(len(symbols), bool)
    stays[pair + 1] = False
    return symbols[stays], starts[stays], document[stays], weights[stays]


def high_symbols(words: np.ndarray, ends: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Names and first words of the symbols after the last round."""
    document = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
    state = words, np.arange(len(words)), document, np.ones(len(words), np.int64)
    most = 1
    for k in range(rounds):
        state = rename(*state, max(2, most), k + 1)
        most = 2 * max(2, most)
    return state[0], state[1]


def _order(rounds: int) -> R.Order:
    def order(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        names, starts = high_symbols(words, ends, rounds)
        out = np.full(len(words), np.iinfo(np.uint64).max)
        out[starts] = R.mixed_up(names) >> np.uint64(1)
        return out

    return order


def _words(body: bytes) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    found = body.split()
    return np.fromiter((digest(w) for w in found), np.uint64, len(found))


def window_rows(docs: DataFrame, anchors: DataFrame, size: int) -> DataFrame:
    """``h1, h2, doc_id, p`` of all windows of the given anchors."""

    def make(doc_id: int, body: bytes, own: np.ndarray) -> list[tuple]:
        words = R.mixed_up(_words(body))
        starts = np.unique(np.concatenate([np.arange(a, b + 1) for a, b, _ in own]))
        starts = starts[starts + size <= len(words)]
        one, two = (R.Sums(words, k).of(starts, starts + size).view(np.int64).tolist() for k in (0, 1))
        return [(x, y, doc_id, p) for x, y, p in zip(one, two, starts.tolist(), strict=True)]

    return R.beside(docs, anchors.select("doc_id", F.col("low").alias("a"), F.col("high").alias("b")), make, "h1 long, h2 long, doc_id long, p long", all_docs=False)


def remove_repeats(docs: DataFrame, size: int = WINDOW, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed`` and ``kept_sha256`` of the words that stay, of every row."""
    before, after, _ = reach(rounds)
    given = R.bodies(docs, id_col, text_col)
    found = R.marks(R.anchor_rows(given, _words, _order(rounds), R.Windows(size, before, after), by_document=True), by_document=True)
    windows = R.cut(window_rows(given, found.filter("not sure"), size), "windows")
    owners = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("owner"))
    again = windows.join(owners, ["h1", "h2"]).filter("doc_id > owner")
    gone = found.filter("sure").select("doc_id", F.col("low").alias("a"), (F.col("high") + size).alias("b")).unionByName(again.select("doc_id", F.col("p").alias("a"), (F.col("p") + size).alias("b")))

    def make(doc_id: int, body: bytes, own: np.ndarray) -> list[tuple]:
        words = body.split()
        out = R.covered(len(words), own)
        kept = [w for w, x in zip(words, out.tolist(), strict=True) if not x] if len(own) else words
        return [(doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())]

    return R.named(R.beside(given, gone, make, "doc_id long, n_words long, n_removed long, kept_sha256 string", all_docs=True))
