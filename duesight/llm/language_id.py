"""Language identification: word-first backoff.

A word seen in training scores its log frequency in each language. An unseen word scores, at each of its
positions, the longest character n-gram that training has seen there, from ``MAX_GRAM`` characters down to one.

The model is fitted on every labelled row with Spark counting, and holds every word, n-gram and language of them. Words are
counted in the texts, n-grams in the words. It keeps counts of the languages that a token was seen in; all other languages
share one value for each level, so its size is that of the vocabulary: about 26 bytes a word, which every
worker holds. Prediction reads every whole text.
Null texts and texts without letters get ``und`` and score 0. Rows that repeat are predicted each on its own.
Equal scores go to the language that sorts first. Without any training row every text is ``und``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duesight.llm.scratch import cut

UNKNOWN = "und"
MAX_GRAM = 4
_LETTERS = re.compile(r"[^\W\d_]+")
#: Words remembered by one worker, and numbers it remembers for them (one for each word and language); emptied when full.
CACHE, CACHED_SCORES = 200_000, 2_000_000
#: Tokens a task counts before it hands the counts on.
COUNTED = 200_000
#: Log frequency of a position for which no n-gram is known.
NOTHING = -12.0


@dataclass(frozen=True)
class FitBounds:
    """What bounds the training rows: nothing, unless a caller wants it."""

    docs_per_language: int | None = None  # expected number, chosen by a hash of the id; None: every row


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def grams_of(word: str) -> Iterator[str]:
    """All n-grams of a word between its end marks."""
    marked = f"<{word}>"
    for n in range(1, MAX_GRAM + 1):
        for i in range(len(marked) - n + 1):
            yield marked[i : i + n]


class Words(Mapping):
    """Known words and their rows, in the order of a hash of 128 bits, whose second half confirms a hit. A dict takes several times
    the memory. The words themselves stay with the driver."""

    def __init__(self, texts: pa.Array):
        hashes = np.concatenate([self._hashed(texts[i : i + COUNTED].to_pylist()) for i in range(0, len(texts), COUNTED)] or [self._hashed([])])
        order = np.lexsort((hashes[:, 1], hashes[:, 0]))
        #: The row each of ``texts`` has got.
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = np.arange(len(order))
        self.hashes, self.checks, self.texts = hashes[order, 0], hashes[order, 1], texts.take(pa.array(order))

    def __getstate__(self) -> dict:
        return {"hashes": self.hashes, "checks": self.checks}

    @staticmethod
    def _hashed(words: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), dtype=np.uint64).reshape(-1, 2)

    def find(self, words: list[str]) -> np.ndarray:
        """The row of each word, -1 if it is unknown."""
        hashes, rows = self._hashed(words), np.full(len(words), -1, dtype=np.int64)
        at, left = np.searchsorted(self.hashes, hashes[:, 0]), np.arange(len(words))
        while len(left := left[at[left] < len(self.hashes)]) and len(left := left[self.hashes[at[left]] == hashes[left, 0]]):
            same = self.checks[at[left]] == hashes[left, 1]
            rows[left[same]] = at[left[same]]
            left = left[~same]
            at[left] += 1
        return rows

    def __getitem__(self, word: str) -> int:
        row = int(self.find([word])[0])
        if row < 0:
            raise KeyError(word)
        return row

    def __iter__(self) -> Iterator[str]:
        return (word.as_py() for word in self.texts)

    def __len__(self) -> int:
        return len(self.hashes)


class Model:
    """Log frequencies by language.

    Row r of a word or n-gram has the level ``level[r]`` (0: words, else the length of the n-gram), whose
    ``base`` is the value of a token that a language has not seen. Languages that have seen it add more, by their counts
    ``n``, stored one after another from ``start[r]`` to ``start[r + 1]``. The last row is for neither.
    """

    def __init__(self, languages: list[str], words: pa.Table, grams: pa.Table):
        """words, grams: columns token, lang, n; each combination once."""
        self.languages = sorted(languages)
        at = {lang: i for i, lang in enumerate(self.languages)}

        def coded(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
            codes = column.combine_chunks().dictionary_encode()
            return codes.indices.to_numpy(), codes.dictionary

        word_codes, texts = coded(words["token"])
        gram_codes, marked = coded(grams["token"])
        self.words = Words(texts)
        self.grams = {gram: i for i, gram in enumerate(marked.to_pylist(), len(texts))}
        self.nothing = len(texts) + len(marked)
        row = np.concatenate([self.words.place[word_codes], gram_codes + len(texts)]).astype(np.int64)
        counts = pa.concat_tables([words.select(["lang", "n"]), grams.select(["lang", "n"])])
        lang_codes, tongues = coded(counts["lang"])
        lang = np.array([at[x] for x in tongues.to_pylist()], dtype=np.min_scalar_type(len(at)))[lang_codes]
        n = counts["n"].to_numpy()
        self.level = np.zeros(self.nothing + 1, dtype=np.int8)
        self.level[len(texts) :] = [*map(len, self.grams), MAX_GRAM + 1]
        # Add-half smoothing within each level: all words, or the n-grams of one length.
        self.base = np.full((MAX_GRAM + 2, len(at)), NOTHING)
        for level in range(MAX_GRAM + 1):
            size = np.count_nonzero(self.level == level)
            if size:
                own = self.level[row] == level
                self.base[level] = np.log(0.5) - np.log(np.bincount(lang[own], n[own], len(at)) + 0.5 * size)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=self.nothing + 1))])
        self.start = self.start.astype(np.min_scalar_type(self.start[-1]))
        order = np.lexsort((lang, row))
        self.lang = lang[order]
        self.n = n[order].astype(np.min_scalar_type(n.max(initial=0)))

    def more(self, at: np.ndarray | slice) -> np.ndarray:
        """What the counts there add to the base value."""
        return np.log((self.n[at].astype(np.float64) + 0.5) / 0.5)

    def rows_of(self, word: str) -> list[int]:
        """The row of a known word; of an unseen one, at each position, of the longest known n-gram."""
        known = self.words.get(word)
        if known is not None:
            return [known]
        marked = f"<{word}>"
        return [self.back_off(marked[i : i + MAX_GRAM]) for i in range(len(marked))]

    def back_off(self, gram: str) -> int:
        for n in range(len(gram), 0, -1):
            row = self.grams.get(gram[:n])
            if row is not None:
                return row
        return self.nothing

    def score_word(self, word: str) -> np.ndarray:
        """The mean over the rows of a word, plainly."""
        rows = self.rows_of(word)
        total = self.base[self.level[rows]].sum(axis=0)
        for r in rows:
            part = slice(self.start[r], self.start[r + 1])
            total[self.lang[part]] += self.more(part)
        return total / len(rows)

    def means(self, rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The means of many words at once; ``sizes`` says how many of ``rows`` each word has."""
        starts = np.cumsum(sizes) - sizes
        total = np.add.reduceat(self.base[self.level[rows]], starts, axis=0)
        first = self.start[rows].astype(np.int64)
        held = self.start[rows + 1].astype(np.int64) - first
        entry = np.arange(held.sum()) + np.repeat(first - (np.cumsum(held) - held), held)
        word = np.repeat(np.repeat(np.arange(len(sizes)), sizes), held)
        width = len(self.languages)
        total += np.bincount(word * width + self.lang[entry], self.more(entry), total.size).reshape(total.shape)
        return total / sizes[:, None]


class Predictor:
    """Predicts text by text and remembers the scores of raw tokens."""

    def __init__(self, model: Model):
        self.model = model
        self.seen: dict[str, int] = {}
        self.grams: dict[str, int] = {}
        self.room = max(16, min(CACHE, CACHED_SCORES // max(1, len(model.languages))))
        self.scores = np.zeros((self.room, len(model.languages)))
        self.letters = np.zeros(self.room, dtype=np.int64)

    def _add(self, tokens: list[str]) -> None:
        """Score new tokens: means over the rows of each word, added up by token."""
        model, grams = self.model, self.grams
        if len(grams) > CACHE:
            grams.clear()
        words, owner = [], []
        first = len(self.seen)
        for k, token in enumerate(tokens, first):
            self.seen[token] = k
            self.scores[k], self.letters[k] = 0, 0
            low = token.lower()
            own = [low] if low.isalpha() else _LETTERS.findall(low)
            words += own
            owner += [k] * len(own)
        rows, sizes = [], []
        for word, known in zip(words, model.words.find(words).tolist(), strict=True):
            if known >= 0:
                rows.append(known)
                sizes.append(1)
                continue
            marked = f"<{word}>"
            for i in range(len(marked)):
                gram = marked[i : i + MAX_GRAM]
                row = grams.get(gram)
                if row is None:
                    row = grams[gram] = model.back_off(gram)
                rows.append(row)
            sizes.append(len(marked))
        if owner:
            np.add.at(self.scores, owner, model.means(np.array(rows), np.array(sizes)))
            np.add.at(self.letters, owner, 1)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.model.languages:
            return UNKNOWN, 0.0
        total, n = 0, 0
        tokens = text.split()
        half = self.room // 2
        for start in range(0, len(tokens), half):  # a long text may hold more words than the memory
            part = tokens[start : start + half]
            if len(self.seen) > half:
                self.seen.clear()
            if new := set(part).difference(self.seen):
                self._add(sorted(new))
            at = list(map(self.seen.__getitem__, part))
            total, n = total + self.scores[at].sum(axis=0), n + int(self.letters[at].sum())
        if not n:
            return UNKNOWN, 0.0
        best = int(np.argmax(total))
        return self.model.languages[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum())


def held_out(doc_id: Column) -> Column:
    """Documents that take no part in training: crc32 of the id as text is 2 modulo 4. A null id counts as empty."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def _counted(frames: Iterator[pd.DataFrame], counts_of) -> Iterator[pd.DataFrame]:
    """``token, lang, n``: ``counts_of`` adds each row's tokens to the counter of its language."""
    by_lang: dict[str, Counter[str]] = {}

    def handed_on() -> Iterator[pd.DataFrame]:
        for lang, counter in by_lang.items():
            if counter:
                yield pd.DataFrame({"token": list(counter.keys()), "lang": lang, "n": list(counter.values())})
        by_lang.clear()

    for frame in frames:
        for row in frame.itertuples(index=False):
            counts_of(by_lang.setdefault(row.lang, Counter()), row)
            if sum(map(len, by_lang.values())) > COUNTED:
                yield from handed_on()
    yield from handed_on()


def _count_words(counter: Counter[str], row) -> None:
    counter.update(words_of(row.text))


def _count_grams(counter: Counter[str], row) -> None:
    for gram in grams_of(row.token):
        counter[gram] += row.n


def fit(labelled: DataFrame, bounds: FitBounds = FitBounds(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on the rows that have a text and a language: all of them, or a hashed sample if the caller bounds them."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    if bounds.docs_per_language is not None:
        shares = sizes.select("lang", (F.lit(float(bounds.docs_per_language)) / F.col("n")).alias("share"))
        drawn = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30)) < F.col("share") * (1 << 30)
        # One row for each language, as in the model, which goes to every task as well.
        rows = rows.join(F.broadcast(shares), "lang").filter(drawn)

    def added_up(parts: DataFrame) -> DataFrame:
        return parts.groupBy("token", "lang").agg(F.sum("n").alias("n"))

    kind = "token string, lang string, n long"
    words = cut(added_up(rows.select("lang", "text").mapInPandas(lambda frames: _counted(frames, _count_words), kind)), "language-words")
    grams = added_up(words.mapInPandas(lambda frames: _counted(frames, _count_grams), kind))
    # As columns, not as row objects, which would take many times the memory of the driver.
    return Model([r.lang for r in sizes.select("lang").collect()], words.toArrow(), grams.toArrow())


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row. The score is the share of the best language among all."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = Predictor(shared.value)
        for batch in batches:
            found = [one.predict(text) for text in batch.text]
            yield pd.DataFrame({"doc_id": batch.doc_id, "lang_pred": [x[0] for x in found], "score": [x[1] for x in found]})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(predict, "doc_id long, lang_pred string, score double")


def prediction(spark: SparkSession, model: Model, text: Column) -> Column:
    """``lang_pred`` and ``score`` of a text, as a struct."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        one = Predictor(shared.value)
        for batch in batches:
            yield pd.DataFrame([one.predict(text) for text in batch], columns=["lang_pred", "score"])

    return predict(text)


def identify_with(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns, and ``lang_pred`` and ``score``, which replace columns of those names."""
    found = docs.withColumn("_found", prediction(docs.sparkSession, model, F.col(text_col)))
    return found.withColumns({"lang_pred": F.col("_found.lang_pred"), "score": F.col("_found.score")}).drop("_found")
