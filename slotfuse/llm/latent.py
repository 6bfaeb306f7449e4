"""Latent semantic space of TF-IDF passages by a distributed randomised SVD."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS_AT_ONCE = 2048  # of passages that are multiplied together
ROWS_AT_ONCE = 4096
GRAIN = 2.0**-20  # to which a task's sums are rounded
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACED = bytes(0x20 if chr(b) in PUNCTUATION else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def plain_words(text: str | bytes) -> list[bytes]:
    """A-Z lowered, ASCII punctuation taken as blank, cut at ASCII white space."""
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    return data.translate(_SPACED).split()


def word_ids(tokens: Sequence[bytes], vocabulary: dict[bytes, int]) -> np.ndarray:
    """Vocabulary ids; words outside get the id after the last."""
    get, outside = vocabulary.get, len(vocabulary)
    return np.array([get(w, outside) for w in tokens], dtype=np.int64)


def passage_rows(ids: np.ndarray, length: int) -> list[np.ndarray]:
    return [ids[i:i + length] for i in range(0, len(ids), length)]


def _add_cross(out: np.ndarray, rows: list[np.ndarray], idf: np.ndarray, q: np.ndarray, scale: float = 1.0) -> None:
    """Add the part A'(A q) of some TF-IDF rows, each scaled to length one."""
    for row in rows:
        ids, counts = np.unique(row[row < len(idf)], return_counts=True)
        if len(ids):
            weight = counts * idf[ids]
            weight /= np.linalg.norm(weight)
            out[ids] += np.outer(scale * weight, weight @ q[ids])


def add_passages(out: np.ndarray, texts: list[np.ndarray], length: int, idf: np.ndarray, q: np.ndarray) -> None:
    """Add A'(A q) of all passages of some texts, as `_add_cross` does row by row.

    The rows are multiplied as one small dense matrix, of the words that occur in them.
    """
    blocks = [-(-len(ids) // length) for ids in texts]
    first = np.cumsum([0, *blocks])
    ids = np.concatenate(texts)
    rows = np.concatenate([at + np.arange(len(t)) // length for at, t in zip(first, texts)])
    known = ids < len(idf)
    ids, rows = ids[known], rows[known]
    if not len(ids):
        return
    place = np.zeros(len(idf), np.int64)
    place[ids] = 1
    words = np.flatnonzero(place)
    place[words] = np.arange(len(words))
    size = (int(first[-1]), len(words))
    a = np.bincount(rows * len(words) + place[ids], weights=idf[ids], minlength=size[0] * size[1]).reshape(size)
    a /= np.maximum(np.linalg.norm(a, axis=1, keepdims=True), 1e-300)
    a = a.astype(q.dtype)
    out[words] += a.T @ (a @ q[words])


def corpus_product(
    docs: DataFrame, vocabulary: dict[bytes, int], idf: np.ndarray, q: np.ndarray, passage: int, parts: int
) -> np.ndarray:
    """A'(A q) over the passages of all texts of `docs`.

    Every task hands on one row for each word it has met; the rows are shuffled by word and
    added in `parts` tasks, so the driver gets one matrix of words by dimensions, however
    many texts there are. A task's sums are rounded to `GRAIN`, so that adding them up is
    exact and does not depend on the order they come in.
    """
    q_shape = q.shape
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, idf, q))
    schema = pa.schema([("word", pa.int32()), ("part", pa.binary())])

    def rows_of(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        met = np.flatnonzero(total.any(axis=1))
        for i in range(0, len(met), ROWS_AT_ONCE):
            some = met[i:i + ROWS_AT_ONCE]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([total[w].tobytes() for w in some], pa.binary())], schema=schema)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, weights, now = shared.value
        total, some, size = np.zeros(now.shape), [], 0
        longest = passage * max(1, WORDS_AT_ONCE // passage)
        for batch in batches:
            for text in batch.column(0):
                for ids in passage_rows(word_ids(plain_words(text.as_py()), words), longest):
                    some.append(ids)
                    size += len(ids)
                    if size >= WORDS_AT_ONCE:
                        add_passages(total, some, passage, weights, now)
                        some, size = [], 0
        if some:
            add_passages(total, some, passage, weights, now)
        yield from rows_of(np.round(total / GRAIN) * GRAIN)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(q_shape)
        for batch in batches:
            for word, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[word] += np.frombuffer(part.as_buffer())
        yield from rows_of(total)

    texts = docs.where("text is not null").select(F.col("text").cast("binary").alias("text"))
    partial = texts.mapInArrow(multiply, "word int, part binary").repartition(parts, "word")
    summed = partial.mapInArrow(add, "word int, part binary").toArrow()
    shared.destroy()
    out = np.zeros(q.shape)
    for word, part in zip(summed["word"].to_pylist(), summed["part"]):
        out[word] = np.frombuffer(part.as_buffer())
    return out


def randomised_svd(
    docs: DataFrame, items: list[np.ndarray], vocabulary: dict[bytes, int], idf: np.ndarray, dimensions: int,
    passage: int, rounds: int = 0, item_weight: float = 10.0, seed: int = 11, weight: float = 1.0, parts: int = 12,
    precision: type = np.float64,
) -> tuple[np.ndarray, np.ndarray]:
    """Singular values and right singular vectors (words by dimensions) of passages of `docs` and `items`.

    All texts are multiplied with the basis, in `rounds` rounds and once more; a passage
    counts `weight` times, an item `item_weight` times, and texts are multiplied in
    `precision`. The last product alone gives a space that is good to search in: with
    A'A q = y, A'A is taken as y (q'y)^-1 y' (Nystrom), whose decomposition is that of a
    matrix as narrow as the basis.
    """
    rank = min(dimensions, len(vocabulary))
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(vocabulary), rank)))[0]

    def product(q: np.ndarray) -> np.ndarray:
        """A'(A q) over all rows."""
        total = weight * corpus_product(docs, vocabulary, idf, q.astype(precision), passage, parts)
        _add_cross(total, items, idf, q, item_weight)
        return total

    for _ in range(rounds):
        basis = np.linalg.qr(product(basis))[0]
    met = product(basis)
    small = basis.T @ met
    squares, turn = np.linalg.eigh((small + small.T) / 2)
    inverse = np.where(squares > 1e-10 * max(squares[-1], 1e-300), 1 / np.sqrt(np.maximum(squares, 1e-300)), 0)
    vectors, values, _ = np.linalg.svd((met @ turn) * inverse, full_matrices=False)
    return values, vectors
