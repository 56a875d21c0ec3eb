"""Exact merge-type encoding with a SentencePiece vocabulary, by backtracking.

An Aho-Corasick automaton finds the longest piece at each position. A sequence of pieces is the result of the
merges if every two neighbours are what merging makes of their joined text; so the encoder walks from the left,
takes the longest piece that goes with the one before, falls back to shorter ones, and marks positions from
which nothing goes on in a bit field that it never enters again. The compatibility of two pieces is found once, by
merging their joined text again.

Merges never pass the start of a blank run when no piece holds a blank behind other characters, so the ids
of such segments are remembered. Without that property a text is one segment. Characters outside the vocabulary are
encoded as bytes. Null texts count as empty and give the end id alone. Rows that repeat are encoded each on its own.
Texts of any length are read whole, empty tables give no rows, and columns other than id and text are ignored.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = "▁"
_WORD_AND_SIGNS = re.compile(r"(\w+)(\W+)").fullmatch
#: Segments of each of two generations, and pairs, that a worker remembers.
CACHE = 250_000


class Merger:
    """Merging by score: the best pair first, the leftmost of equals."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores

    def __call__(self, text: str, stop: int = 1) -> list[str]:
        """Merge until nothing merges, or ``stop`` parts are left."""
        parts: list[str | None] = list(text)
        left = len(parts)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts) and (score := self.scores.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-score, i, parts[i], parts[j]))

        for i in range(len(parts)):
            offer(i)
        while heap and left > stop:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if parts[i] != a or j >= len(parts) or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = a + b, None, after[j]
            left -= 1
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]


class PieceEncoder:
    """Ids of texts for a model file of merge type with byte fallback, and texts of ids."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        skip = {i for i in every if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.end, self.pieces = model.eos_id(), [model.id_to_piece(i) for i in every]
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: bytes([b]) for b, i in enumerate(self.bytes)}
        self.hidden = skip - set(self.bytes)
        self.odd = skip | set(self.bytes)
        self.ids = {self.pieces[i]: i for i in every if i not in skip}
        self.merge = Merger({p: model.get_score(i) for p, i in self.ids.items() if len(p) > 1})
        # Pieces that merging never makes are no candidates.
        made = {p for p in self.ids if len(p) == 1 or self.merge(p) == [p]}
        self.tree = ahocorasick.Automaton()
        for piece in made:
            self.tree.add_word(piece, (len(piece), self.ids[piece]))
        self.tree.make_automaton()
        self.sizes = [len(p) for p in self.pieces]
        self.width = len(self.pieces).bit_length()  # two ids make one small number
        #: The longest piece that a piece begins with, -1 if there is none.
        self.shorter = [-1] * len(self.pieces)
        for p in made:
            self.shorter[self.ids[p]] = next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in made), -1)
        # Order of the merges; pieces with equal scores are merged in the order of their places.
        order = {s: k for k, s in enumerate(sorted({model.get_score(self.ids[p]) for p in made if len(p) > 1}, reverse=True))}
        self.rank = [-1] * len(self.pieces)
        self.halves: list[tuple[int, int]] = [(-1, -1)] * len(self.pieces)
        self.joined: dict[int, int] = {}
        for p in made:
            i = self.ids[p]
            if len(p) > 1:
                self.rank[i] = order[model.get_score(i)]
                self.halves[i] = tuple(self.ids[x] for x in self.merge(p, stop=2))
            for n in range(1, len(p)):
                if p[:n] in made and p[n:] in made:
                    self.joined[self.ids[p[:n]] << self.width | self.ids[p[n:]]] = self.rank[i]
        #: Pairs of characters that stand side by side in some piece.
        self.inside = {p[n : n + 2] for p in self.ids for n in range(len(p) - 1)}
        self.ends: dict[str, tuple[str, str]] = {}
        self.apart = not any(BLANK in p.lstrip(BLANK) for p in self.ids)
        self.pairs: dict[int, bool] = {}
        self.seen: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.strange: dict[str, str] = {}
        self.added = "" if model.encode("a", out_type=str)[0] == "a" else BLANK
        chars = "".join(re.escape(p) for p in self.ids if len(p) == 1)
        self.runs = re.compile(f"([{chars}]+)|([^{chars}])", re.DOTALL)
        self.known = re.compile(f"[{chars}]+", re.DOTALL).fullmatch

    def goes(self, a: int, b: int) -> bool:
        """Whether merging the joined text of two pieces ends in exactly these two.

        The merges that made the pieces are replayed from the last one back: at every stage the symbols that meet
        at the border must not be merged before the next merge on either side.
        """
        if len(self.pairs) > CACHE:
            self.pairs.clear()
        known = self.pairs[a << self.width | b] = self._goes(a, b)
        return known

    def _goes(self, a: int, b: int) -> bool:
        rank, halves, joined, width = self.rank, self.halves, self.joined, self.width
        until = 1 << 40  # merges of a lower rank come before the state that is looked at ends
        while True:
            merged = joined.get(a << width | b)
            if merged is not None and merged < until:
                return False
            if rank[a] < 0 and rank[b] < 0:
                return True
            # Of equal ranks the left merge comes first, so the right one is the later one and undone first.
            if rank[a] > rank[b]:
                until = rank[a]  # the merge in a lies left of the border and wins a tie
                a = halves[a][1]
            else:
                until = rank[b] + 1  # the border lies left of the merge in b and wins a tie
                b = halves[b][0]

    def pieces_of(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are in the vocabulary."""
        n = len(text)
        longest = [-1] * (n + 1)
        for last, (size, i) in self.tree.iter(text):
            longest[last - size + 1] = i  # matches come by their ends: of one start, the longest is last
        dead: bytearray | None = None
        out: list[int] = []
        at, piece, last, sizes, width, known = 0, longest[0], -1, self.sizes, self.width, self.pairs.get
        while at < n:
            if piece < 0:
                # Nothing goes on from here: shorten the piece before.
                dead = dead or bytearray(n // 8 + 1)
                dead[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                last = out[-1] if out else -1
                at -= sizes[piece]
                piece = self.shorter[piece]
                continue
            stop = at + sizes[piece]
            fits = last < 0 or known(last << width | piece)
            if fits is None:
                fits = self.goes(last, piece)
            if fits and (dead is None or not dead[stop >> 3] >> (stop & 7) & 1):
                out.append(piece)
                at, last, piece = stop, piece, longest[stop]
            else:
                piece = self.shorter[piece]
        return out

    def segment(self, text: str) -> list[int]:
        if self.known(text):
            return self.pieces_of(text)
        out: list[int] = []
        for known, char in self.runs.findall(text):
            out += self.pieces_of(known) if known else [self.bytes[b] for b in char.encode()]
        return out

    def written(self, text: str) -> tuple[str, str]:
        """Decimal ids, a blank behind each, and the text that they decode to.

        A segment's own text is what it decodes to nearly always; where it isn't, that is remembered in ``strange``.
        """
        if not text:
            return "", ""
        marked = self.added.replace(BLANK, " ") + text.replace(BLANK, " ")
        if self.apart and self.added and "  " not in marked and BLANK not in text:
            words = text.split(" ")  # without their marks
        else:
            whole = marked.replace(" ", BLANK)
            words = re.findall(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+", whole) if self.apart else [whole]
        if len(self.strange) > CACHE:
            self.older, self.seen, self.strange = {}, {}, {}
        elif len(self.seen) > CACHE:
            self.older, self.seen = self.seen, {}
        seen, older = self.seen, self.older
        for word in set(words).difference(seen):
            found = older.get(word)
            seen[word] = self._new(word) if found is None else found
        ids = "".join(map(seen.__getitem__, words))
        if self.strange and not self.strange.keys().isdisjoint(words):
            marked = "".join([self.strange.get(w) or self._segment_of(w).replace(BLANK, " ") for w in words])
        return ids, marked

    def _segment_of(self, word: str) -> str:
        """A word with its mark. Marked segments keep theirs; without an added blank, the first one has none."""
        return word if not self.added or word.startswith(BLANK) else BLANK + word

    def _new(self, word: str) -> str:
        segment = self._segment_of(word)
        parts = _WORD_AND_SIGNS(word) if segment is not word else None
        if parts is not None and parts[1][-1] + parts[2][0] not in self.inside:
            # No piece holds these two characters side by side: merging never passes between them.
            letters, signs = parts.groups()
            tail = self.ends.get(signs)
            if tail is None:
                if len(self.ends) > CACHE:
                    self.ends.clear()
                tail = self.ends[signs] = self._made(signs)
            stem = self.seen.get(letters)
            if stem is not None and letters not in self.strange:
                stem = stem, " " + letters
            else:
                stem = self._made(BLANK + letters)
            ids, text = stem[0] + tail[0], stem[1] + tail[1]
        else:
            ids, text = self._made(segment)
        if text != segment.replace(BLANK, " "):
            self.strange[word] = text
        return ids

    def _made(self, segment: str) -> tuple[str, str]:
        ids = self.segment(segment)
        return "".join([f"{i} " for i in ids]), self._text(ids)

    def encode(self, text: str | None) -> list[int]:
        """All ids, the end id last."""
        return [int(i) for i in self.written(text or "")[0].split()] + [self.end]

    def _text(self, ids: list[int]) -> str:
        if self.odd.isdisjoint(ids):
            return "".join(map(self.pieces.__getitem__, ids)).replace(BLANK, " ")
        out, pending = [], b""
        for i in ids:
            if i in self.byte_of:
                pending += self.byte_of[i]
                continue
            if pending:
                out.append(_utf8(pending))
                pending = b""
            if i not in self.hidden:
                out.append(self.pieces[i].replace(BLANK, " "))
        if pending:
            out.append(_utf8(pending))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids: bytes are read as UTF-8, control ids have none, the added blank goes."""
        return self.without_added(self._text(ids))

    def without_added(self, text: str) -> str:
        return text[1:] if self.added and text.startswith(" ") else text


def _utf8(raw: bytes) -> str:
    """UTF-8 with one replacement character for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(raw):
        for n in range(1, 5):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@lru_cache(maxsize=2)
def shared(path: str) -> PieceEncoder:
    """The encoder of a worker process: its tables are made once, and its memory serves all tasks of the worker."""
    return PieceEncoder(path)


def encode(docs: DataFrame, encoder: Callable[[], PieceEncoder], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (decimal ids joined by one blank) and ``decoded`` text of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = encoder()
        for batch in batches:
            numbers, written, decoded = [], [], []
            for text in batch.text:
                ids, plain = one.written(text or "")
                numbers.append(ids.count(" ") + 1)
                written.append(ids + str(one.end))
                decoded.append(one.without_added(plain))
            yield pd.DataFrame({"doc_id": batch.doc_id, "n_tokens": numbers, "ids": written, "decoded": decoded})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, "doc_id long, n_tokens long, ids string, decoded string")
