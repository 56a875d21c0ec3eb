"""Packing documents into token windows by the sum-of-squares rule.

Every task packs its own rows online. A document's full windows stand alone; what is left of it goes to the fill level
that makes the sum of the squared counts of partially filled windows smallest. The counts lie in an array by
level. At the end of a task the windows that are still open are closed by cutting: the emptiest give up
their pieces to fill the fullest, so one window of a task at most stays partly filled.

No shuffle: sequence ids are made of the task's partition and the window's number in it. Null and empty texts are
one piece that holds the end id. Rows that repeat are packed each on its own. Texts of any length are cut over windows,
empty tables give no pieces, and columns other than id and text are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 2048
END_ID = 1
#: Words of each of two generations whose ids a worker remembers.
CACHE = 400_000
PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


#: How byte-level pre-tokenizers write the bytes that are no printable Latin-1 characters.
#: Latin letters but the dotted capital I, and ASCII signs but the apostrophe behind them.
_LATIN = re.compile("([A-Za-zÀ-ÖØ-öø-\u012f\u0131-\u024f]+)([!-&(-/:-@\\[-`{-~]*)").fullmatch
_BYTES = {b: 256 + n for n, b in enumerate([*range(33), *range(127, 161), 173])}


class WordEncoder:
    """Ids of texts as little-endian 32-bit bytes; the ids of words between blanks are remembered.

    Made for tokenizers that lower-case, split letters from other characters and drop white space (the blank, tab and
    line feed part words for any of them). Of a new word of Latin letters and signs behind them, the letters go to the
    tokenizer's model directly; the signs and any other word go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.seen: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.written = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _new(self, word: str) -> bytes:
        latin = _LATIN(word)
        if latin is None:
            return self._whole(word)
        letters, signs = latin.groups()
        low = letters.lower()
        found = self.seen.get(low)
        if found is None:
            text = low if low.isascii() else low.encode().decode("latin-1").translate(_BYTES)
            written = self.written
            found = b"".join([written[t.id] for t in self.model.tokenize(text)])
        if not signs:
            return found
        tail = self.marks.get(signs)
        if tail is None:
            if len(self.marks) > CACHE:
                self.marks.clear()
            tail = self.marks[signs] = self._whole(signs)
        return found + tail

    def __call__(self, text: str | None) -> bytes:
        words = (text or "").replace("\n", " ").replace("\t", " ").split(" ")
        if len(self.seen) > CACHE:
            self.older, self.seen = self.seen, {"": b""}
        seen, older = self.seen, self.older
        for word in set(words).difference(seen):
            found = older.get(word)
            seen[word] = self._new(word) if found is None else found
        return b"".join(map(seen.__getitem__, words))


class Packer:
    """Sum-of-squares packing of pieces ``(doc, start, ids, doc_tokens)``; ids are bytes, four for each."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)  # partially filled windows by level
        self.open: list[list[list]] = [[] for _ in range(window + 1)]  # their pieces
        self.done: list[list] = []

    def level_for(self, size: int) -> int:
        """The level (0: a new window) whose choice makes the sum of squares smallest; the fullest of equals."""
        to = self.window - size
        change = 2 * self.counts[size : self.window + 1] + 1  # a level gains a window
        change[to] = 0  # a full window is no longer counted
        change[1:] += 1 - 2 * self.counts[1 : to + 1]  # its old level loses it
        change[1:][self.counts[1 : to + 1] == 0] = np.iinfo(np.int64).max
        return to - int(np.argmin(change[::-1]))

    def place(self, piece: tuple) -> None:
        size = len(piece[2]) // 4
        level = self.level_for(size)
        if level:
            pieces = self.open[level].pop()
            self.counts[level] -= 1
        else:
            pieces = []
        pieces.append(piece)
        self._put(pieces, level + size)

    def _put(self, pieces: list, level: int) -> None:
        if level == self.window:
            self.done.append(pieces)
        else:
            self.open[level].append(pieces)
            self.counts[level] += 1

    def add(self, doc, ids: bytes) -> None:
        n, step = len(ids) // 4, 4 * self.window
        whole = len(ids) - len(ids) % step
        for at in range(0, whole, step):
            self.done.append([(doc, at // 4, ids[at : at + step], n)])
        if whole < len(ids):
            self.place((doc, whole // 4, ids[whole:], n))

    def close(self) -> None:
        """Fill the fullest open windows with what the emptiest hold."""
        left = [[level, pieces] for level in range(self.window - 1, 0, -1) for pieces in self.open[level]]
        first, last = 0, len(left) - 1
        while first < last:
            gap = self.window - left[first][0]
            doc, start, ids, n = left[last][1].pop()
            take = min(gap, len(ids) // 4)
            left[first][1].append((doc, start, ids[: 4 * take], n))
            left[first][0] += take
            left[last][0] -= take
            if 4 * take < len(ids):
                left[last][1].append((doc, start + take, ids[4 * take :], n))
            first += left[first][0] == self.window
            last -= not left[last][1]
        self.done += [pieces for _, pieces in left if pieces]
        self.open = [[] for _ in self.open]
        self.counts[:] = 0

    def rows(self, first: int) -> pd.DataFrame:
        """The finished windows, numbered from ``first``; they are forgotten here."""
        out = []
        for i, pieces in enumerate(self.done):
            offset = 0
            for doc, start, ids, n in pieces:
                size = len(ids) // 4
                out.append((doc, start, size, zlib.crc32(ids), n, first + i, offset))
                offset += size
        self.done = []
        frame = pd.DataFrame(out, columns=[x.split()[0] for x in PIECE.split(", ")])
        return frame.astype({"doc_id": "Int64"})


def pack(docs: DataFrame, encoder: Callable[[], Callable[[str | None], bytes]], window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece, see ``PIECE``. ``encoder`` makes, in each worker, the function from text to ids."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, packer = encoder(), Packer(window)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.doc_id.astype("Int64")
            for doc, text in zip(ids.tolist(), batch.text, strict=True):
                packer.add(doc, encode(text) + end)
            n = len(packer.done)
            yield packer.rows(number)
            number += n
        packer.close()
        yield packer.rows(number)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, PIECE)
