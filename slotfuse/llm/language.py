"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's
likelihood in a language is summed over all its segmentations by the forward algorithm
(`pieces`), a text's is the product over its words, and the language with the greatest
likelihood is predicted; the score is its share in the sum over all languages.

The probabilities are learnt by expectation and maximisation: Spark counts the words of
each language over all training rows, every round sums the expected counts of the pieces
over all of those words, and only the model itself, of fixed size, reaches the driver.

Words are runs of letters in small letters. A worker keeps the likelihoods of words that
it has seen; texts are never shuffled, only words and their counts are in training.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotfuse.llm.common import ship_package, staged
from slotfuse.llm.pieces import START, Trie, expected_counts, load_pieces, log_likelihoods

UNDETERMINED = "und"
MOST_LANGUAGES = 1000  # a table of languages is a few dozen; beyond, the column is none
ROUNDS = 2
ADDED = 0.1  # to every piece's expected count
TRAINING_BYTES = 32  # longer words are cut for training only
KNOWN_BYTES = 64 << 20  # of a worker's table of likelihoods
SLICE_BYTES = 1 << 20  # of texts that are cut into words at a time
FLUSH_WORDS = 1 << 17

# Letters stay as they are and all other ASCII becomes a blank; beyond ASCII see `letter_runs`.
LETTER_BYTES = bytes(b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def raw_words(text: str) -> Iterator[list[bytes]]:
    """Words of a text in small letters, perhaps with other signs beyond ASCII; in slices."""
    data = text.lower().encode("utf-8", "surrogatepass").translate(LETTER_BYTES)
    at = 0
    while at < len(data):
        end = at + SLICE_BYTES
        if end < len(data):
            end = data.find(b" ", end)
            end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def letter_runs(word: bytes) -> list[bytes]:
    """The runs of letters in a raw word, with the mark of a word's beginning."""
    if word.isascii():
        return [START + word]
    runs = groupby(word.decode("utf-8", "replace"), str.isalpha)
    return [START + "".join(run).encode() for letters, run in runs if letters]


@dataclass(frozen=True)
class Model:
    """languages in order of code point; chances: a row for each piece, a column for each."""

    languages: list[str]
    trie: Trie
    chances: np.ndarray


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over all rows of (lang, text): words as they are trained on."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

    def emit(seen: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in seen.items():
            runs: Counter = Counter()
            for word, n in counter.items():
                for run in letter_runs(word):
                    for at in range(0, len(run), TRAINING_BYTES):
                        runs[run[at:at + TRAINING_BYTES]] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(runs), pa.string()), pa.array(list(runs), pa.binary()), pa.array(list(runs.values()), pa.int64())],
                schema=schema,
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                counter = seen.setdefault(lang.as_py(), Counter())
                for some in raw_words(text.as_py()):
                    held -= len(counter)
                    counter.update(some)
                    held += len(counter)
                    if held > FLUSH_WORDS:
                        yield from emit(seen)
                        seen, held = {}, 0
                        counter = seen.setdefault(lang.as_py(), Counter())
        yield from emit(seen)

    texts = docs.where("text is not null and lang is not null").select("lang", "text")
    return texts.mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, path: str, rounds: int = ROUNDS, added: float = ADDED) -> Model:
    """A model of the languages in `docs` (lang, text) over the vocabulary at `path`.

    Rows without text or language teach nothing. The driver holds the model, that is one
    number for each piece and language; more than `MOST_LANGUAGES` languages are an error.
    """
    spark = docs.sparkSession
    ship_package(spark)
    words = staged(word_counts(docs), "language-words")
    languages = sorted(r["lang"] for r in words.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    trie = Trie(load_pieces(path))
    size = len(trie.pieces)
    chances = np.full((size, len(languages)), 1 / size)
    for _ in range(rounds if languages else 0):
        expected = _expected(words, Model(languages, trie, chances)) + added
        chances = expected / expected.sum(axis=0)
    return Model(languages, trie, chances)


def _expected(words: DataFrame, model: Model) -> np.ndarray:
    shared = words.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("lang", pa.int32()), ("piece", pa.int32()), ("n", pa.float64())])

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = shared.value
        place = {lang: i for i, lang in enumerate(now.languages)}
        total = np.zeros(now.chances.shape)
        for batch in batches:
            column = np.array([place[lang] for lang in batch.column(0).to_pylist()])
            spelled, counts = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            for lang in np.unique(column):
                mine = np.flatnonzero(column == lang)
                total[:, lang] += expected_counts(now.trie, [spelled[i] for i in mine], counts[mine], now.chances[:, lang])
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int32()), pa.array(piece, pa.int32()), pa.array(total[piece, lang])], schema=schema
        )

    summed = words.mapInArrow(expect, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(model.chances.shape)
    out[summed["piece"].to_numpy(), summed["lang"].to_numpy()] = summed["n"].to_numpy()
    return out


class Known:
    """A worker's table of the likelihoods of words; it is emptied when it is full."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.most = max(SLICE_BYTES, KNOWN_BYTES // (8 * max(1, len(model.languages))))
        self.rows: dict[bytes, int] = {}
        self.table = np.zeros((0, len(model.languages) + 1))  # the last column: has a letter

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.rows]
        if len(self.rows) + len(new) > self.most:
            self.rows, self.table, new = {}, self.table[:0], list(words)
        if not new:
            return
        runs = [letter_runs(w) for w in new]
        owner = np.repeat(np.arange(len(new)), [len(r) for r in runs])
        each = log_likelihoods(self.model.trie, [r for some in runs for r in some], self.model.chances)
        add = np.zeros((len(new), self.table.shape[1]))
        np.add.at(add, owner, np.hstack([each, np.ones((len(each), 1))]))
        first = len(self.rows)
        self.rows.update(zip(new, range(first, first + len(new))))
        if first + len(new) > len(self.table):
            grown = np.zeros((max(2 * len(self.table), first + len(new)), self.table.shape[1]))
            grown[:first] = self.table[:first]
            self.table = grown
        self.table[first:first + len(new)] = add

    def sums(self, texts: list[str]) -> np.ndarray:
        """For each text the sum of its words' rows."""
        out = np.zeros((len(texts), self.table.shape[1]))
        waiting: list[tuple[int, list[bytes]]] = []
        held = 0

        def settle() -> None:
            self.learn({w for _, some in waiting for w in some})
            for i, some in waiting:
                rows = np.fromiter(map(self.rows.__getitem__, some), np.int64, len(some))
                out[i] += self.table[rows].sum(axis=0)

        for i, text in enumerate(texts):
            for some in raw_words(text):
                waiting.append((i, some))
                held += sum(map(len, some)) + len(some)
                if held >= SLICE_BYTES:
                    settle()
                    waiting, held = [], 0
        settle()
        return out


# A worker's table, by model; it outlives batches and tasks.
_KNOWN: dict[str, Known] = {}


def _judge(texts: list[str], mark: str, shared) -> tuple[np.ndarray, np.ndarray]:
    if mark not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[mark] = Known(shared.value)
    known = _KNOWN[mark]
    found = known.sums(texts)
    logs, letters = found[:, :-1], found[:, -1] > 0
    names = np.array([*known.model.languages, UNDETERMINED], dtype=object)
    if not logs.shape[1]:
        return np.repeat(names[-1:], len(logs)), np.zeros(len(logs))
    share = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
    best = np.where(letters, logs.argmax(axis=1), len(names) - 1)
    return names[best], np.where(letters, share, 0.0).round(6)


def predict(docs: DataFrame, model: Model, keep: tuple[str | Column, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` of every row, with lang_pred and score, from the text alone.

    score is the predicted language's share in the likelihoods of all, rounded to six
    places; equal shares go to the language first by code point. Texts that are NULL or
    have no letter, and all texts if no language was learnt, are `und` with score 0. Every
    word of a text counts, however long it is. Repeated rows are judged alike, other columns
    are not read, an empty table gives an empty table.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    mark = uuid.uuid4().hex

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            best, share = _judge(list(texts), mark, shared)
            yield pd.DataFrame({"lang_pred": best, "score": share})

    judged = docs.select(*keep, judge(F.coalesce(F.col("text"), F.lit(""))).alias("judged_language"))
    return judged.select("*", "judged_language.*").drop("judged_language")


def held_out(doc_id: str = "doc_id", parts: int = 4, part: int = 2) -> Column:
    """Whether the id's CRC-32 leaves `part` on division by `parts`; a NULL id does not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learnt from the rows not held out.

    Rows without an id are judged, but nothing is learnt from them.
    """
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out()), path)
    return predict(docs, model, ("doc_id", held_out().alias("held_out")))
